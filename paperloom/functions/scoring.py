"""Similarity of a structured citation and a candidate record, on the scale 0 to 1."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

RECORD = (
    "struct<title:string,author:array<string>,journal:string,journal_volume:string,journal_page:string,year:int,"
    "content:string>"
)


def norm(text: str | None) -> str:
    """Lower case ASCII without blanks at the ends; empty for null."""
    flat = unicodedata.normalize("NFKD", (text or "").replace("–", "-").replace("ø", "o").replace("ß", "ss"))
    return flat.encode("ascii", "ignore").decode().lower().strip()


def ratio(a: str, b: str) -> int:
    """Likeness of two strings from 0 to 100, as the standard library tells it; of two empty ones 0."""
    return round(100 * SequenceMatcher(None, a, b).ratio()) if a and b else 0


def _number(text: str | None) -> str | None:
    m = re.search(r"\d+", str(text or ""))
    return m[0].lstrip("0") or "0" if m else None


def numeric_weight(candidate: object, query: object) -> tuple[float, float]:
    """(weight, score) of the first numbers: equal or not, and half a weight where one is missing."""
    a, b = _number(candidate), _number(query)
    return (0.5, 0.0) if a is None or b is None else (1.0, float(a == b))


def _best_content(a: str | None, b: str | None) -> float:
    if not a or not b:
        return 0.0
    return max(ratio(x, y) for x in b.split("|") for y in a.split("|")) / 100


def similarity(candidate: dict, query: dict) -> float:
    """The score of a candidate for a query (S13); a field counts only if the query has it.

    Titles decide where both are there. Otherwise authors, numbers and venues are weighed by a
    generalised Jaccard index, provided that two facts at least support the match; else the
    likeness of the contents is the score.
    """
    weight: dict[str, float] = {}
    score: dict[str, float] = {}
    for name, key in (("volume", "journal_volume"), ("page", "journal_page"), ("year", "year")):
        if query.get(key):
            weight[name], score[name] = numeric_weight(candidate.get(key), query[key])
    q_author, c_author = _some(query.get("author")), _some(candidate.get("author"))
    if "year" in score and score["year"] < 1 and candidate.get("year") and query.get("year"):
        gap = int(candidate["year"]) - int(query["year"])
        bare = not q_author and not query.get("title")
        score["year"] = float(gap == 0 if bare else gap > -2)
    if query.get("title"):
        weight["title"], score["title"] = 1.0, ratio(norm(candidate.get("title")), norm(query["title"])) / 100
    c_journal = norm(candidate.get("journal"))
    if query.get("journal"):
        venues = [c_journal, *c_journal.split(",")]
        weight["venue"], score["venue"] = 1.0, max(ratio(v, norm(query["journal"])) for v in venues) / 100
    if query.get("journal_volume"):
        volume = norm(query["journal_volume"])
        weight["volume_title"] = 1.0
        score["volume_title"] = max(ratio(norm(candidate.get("journal_volume")), volume), ratio(c_journal, volume)) / 100
    if q_author:
        weight["author"] = float(bool(c_author))
        each = [max((ratio(norm(c), norm(q)) for c in c_author), default=0) for q in q_author]
        score["author"] = sum(each) / len(each) / 100 if c_author else 0.0
    escape = _best_content(candidate.get("content"), query.get("content"))
    if score.get("title", 0) >= 0.98:
        return 1.0
    if query.get("title") and candidate.get("title"):
        short, long = sorted((query["title"].lower(), candidate["title"].lower()), key=len)
        return float(long.startswith(short) or long.endswith(short))
    if q_author and c_author and score["author"] < 0.5:
        return escape
    if not q_author and not query.get("title") and not all(query.get(k) for k in ("journal", "journal_volume", "journal_page")):
        return escape
    facts = {
        "year": lambda v: v > 0 and weight["year"] > 0, "volume": lambda v: v == 1 and weight["volume"] > 0,
        "page": lambda v: v == 1 and weight["page"] > 0, "title": lambda v: v > 0.9, "venue": lambda v: v > 0.6,
        "volume_title": lambda v: v > 0.6, "author": lambda v: v > 0.9,
    }
    if sum(facts[k](v) for k, v in score.items()) < 2:
        return escape
    most = sum(max(weight[k], score[k]) for k in weight)
    return sum(min(weight[k], score[k]) for k in weight) / most if most else 1.0


def _some(values: Sequence[str] | None) -> list[str]:
    return [v for v in (values if values is not None else []) if v]


def _clean(value: object) -> object:
    return None if isinstance(value, float) and value != value else value


@F.pandas_udf(DoubleType())
def similarity_udf(candidate: pd.DataFrame, query: pd.DataFrame) -> pd.Series:
    """Scores of pairs of record structs (:data:`RECORD`), in Arrow batches."""
    pairs = zip(candidate.to_dict("records"), query.to_dict("records"), strict=True)
    return pd.Series([similarity({k: _clean(v) for k, v in c.items()}, {k: _clean(v) for k, v in q.items()}) for c, q in pairs])


@F.pandas_udf(IntegerType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Likeness of two text columns from 0 to 100."""
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a, b, strict=True)])
