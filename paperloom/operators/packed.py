"""Several values packed in one field: a quote-aware finite-state tokenizer.

The tokenizer walks a field once, tracks quoting, escapes and nesting depth, and emits the
stretches between delimiters that stand outside quotes and brackets, with their ordinals.
:func:`citations` sits on top of it for bibliography entries, where a delimiter counts only
if a complete citation ends before it and another begins after it.

Defined results
---------------
* Null, empty and blank fields have no items; empty items are left out and take no position.
* An unclosed quote or bracket opens nothing: it is ordinary text.
* Repeated rows give repeated items; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import count

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Closing sign of each opening sign that shields delimiters (fixed values).
BRACKETS = {"(": ")", "[": "]", "{": "}"}
QUOTES = {"“": "”", "«": "»", "„": "“"}


@dataclass(frozen=True)
class Dialect:
    """What separates items, and what shields separators."""

    delimiters: str = ";|\n•"
    spaced: str = "/"  # delimiters only between blanks
    quote: str = '"'
    escape: str = "\\"
    nesting: bool = True


@dataclass(frozen=True)
class Run:
    """Labels that part items by themselves: how the first is written, and the values that follow in order."""

    opener: str
    closer: str
    values: Iterator[str]


def spans(text: str, d: Dialect = Dialect(), run: Run | None = None) -> list[tuple[int, int, int]]:
    """Stretches between delimiters outside quotes and brackets: (start, end, start of the next). Linear in the text.

    With ``run`` the labels of it, in their order and after a blank or delimiter, part items instead.
    """
    out: list[tuple[int, int, int]] = []
    closers: list[str] = []
    begin = i = 0
    n = len(text)
    fresh = True  # nothing but blanks since the last delimiter
    pairs = _pairs(text) if d.nesting else {}
    closes = _Closing(text, d.quote)
    label = _next_label(run)
    while i < n:
        c = text[i]
        if c == d.escape and i + 1 < n and text[i + 1] in d.quote + d.delimiters:
            i += 2
            fresh = False
            continue
        if label and not closers and c == label[0] and i and (text[i - 1].isspace() or text[i - 1] in ";,|") and _labelled(text, i, label):
            out.append((begin, i, i))
            begin, fresh, i = i, False, i + len(label)
            label = _next_label(run)
            continue
        if closers and c == closers[-1]:
            if c == d.quote and text[i + 1 : i + 2] == c:
                i += 2  # a doubled quote stands for one
                continue
            closers.pop()
        elif c == d.quote and c not in closers:
            before = text[i - 1] if i else " "
            if (fresh or before.isspace() or before in "([") and closes.after(i):
                closers.append(c)
        elif not (closers and closers[-1] == d.quote) and c in QUOTES and text.rfind(QUOTES[c]) > i:
            closers.append(QUOTES[c])
        elif not (closers and closers[-1] == d.quote) and c in BRACKETS and i in pairs:
            closers.append(BRACKETS[c])
        elif run is None and not closers and (
            c in d.delimiters
            or (c in d.spaced and text[i - 1 : i].isspace() and text[i + 1 : i + 2].isspace())
            or (c == "," and _between_quoted(text, begin, i, d.quote))
        ):
            out.append((begin, i, i + 1))
            begin, fresh = i + 1, True
            i += 1
            continue
        if not c.isspace():
            fresh = False
        i += 1
    out.append((begin, n, n))
    return out


def _next_label(run: Run | None) -> str:
    value = next(run.values, "") if run else ""
    return run.opener + value + run.closer if value else ""


_TEXT_AFTER = regex.compile(r"\s+(?=\S)")


def _labelled(text: str, at: int, label: str) -> bool:
    return text.startswith(label, at) and _TEXT_AFTER.match(text, at + len(label)) is not None


class _Closing:
    """Which quotes are closed: by the next quote that is not doubled, if a blank, a delimiter or the end follows it."""

    def __init__(self, text: str, quote: str) -> None:
        self.text, self.quote = text, quote
        self.end: dict[int, int] = {}  # of the run of quotes that a place lies in
        self.odd: list[int] = []  # ends of the runs of odd length
        for m in regex.finditer(f"{regex.escape(quote)}+", text):
            self.end |= dict.fromkeys(range(m.start(), m.end()), m.end())
            if (m.end() - m.start()) % 2:
                self.odd.append(m.end())

    def after(self, at: int) -> bool:
        rest = self.end.get(at + 1, at + 1) - (at + 1)
        if rest % 2:
            stop = at + 1 + rest
        else:
            k = bisect_right(self.odd, at + 1 + rest)
            if k == len(self.odd):
                return False
            stop = self.odd[k]
        return stop == len(self.text) or self.text[stop].isspace() or self.text[stop] in ";|/•,.)]"


def _between_quoted(text: str, begin: int, at: int, quote: str) -> bool:
    """Whether the comma at ``at`` stands between two items of which each is quoted as a whole."""
    nxt = _NOT_BLANK.search(text, at + 1)
    if not nxt or nxt[0] != quote:
        return False
    left = text[begin:at].strip()
    return len(left) > 1 and left[0] == left[-1] == quote


_NOT_BLANK = regex.compile(r"\S")


def _pairs(text: str) -> dict[int, int]:
    """The places of brackets that close within their line, each with that of its closing sign."""
    out: dict[int, int] = {}
    held: dict[str, list[int]] = {c: [] for c in BRACKETS}
    openers = {closer: opener for opener, closer in BRACKETS.items()}
    for i, c in enumerate(text):
        if c in held:
            held[c].append(i)
        elif c in openers and held[openers[c]]:
            out[held[openers[c]].pop()] = i
        elif c == "\n":
            for stack in held.values():
                stack.clear()
    return out


def unquote(item: str, quote: str = '"') -> str:
    """An item without the quotes around the whole of it; doubled quotes inside then stand for one."""
    if len(item) >= 2 and item[0] == item[-1] == quote and regex.fullmatch(f'(?:[^{quote}]|{quote}{quote})*', item[1:-1]):
        return item[1:-1].replace(quote * 2, quote).strip()
    return item


#: Labels of items: bullets, numbers, letters and small roman numbers, bracketed or with a sign after.
LABEL = regex.compile(
    r"\s*(?:[•·▪◦‣*–—-]\s+|[•·▪◦‣]\s*|\[\d+\][.:]?\s*|[\[(](?:\d{1,3}|[a-z]|[ivxlc]+)[\])][.:]?\s*|(?:\d{1,3}|[a-z]|[ivx]{1,5})[.)]\s+)",
)
YEAR = regex.compile(r"(?<![\d.:])(?:1[89]|20)\d\d(?![\d])(?!\s*[-–]\s*\d)|\bin press\b|\bn\.\s?d\.", regex.I)
_WORD = r"(?:\p{Lu}|O['’]|\\['\"`^~=.uvHckr]\{?\p{L})[\p{L}\p{M}'’\\\"`^~{}-]*"
_PART = r"(?:(?:de|del|der|den|di|da|du|la|le|van|von|ter|ten|dos|bin|al|el)\s+)*"
_INIT = r"(?:\p{Lu}\.[\s~-]?\s*)"
#: The first signs of a citation: an author in either order, a collaboration, or initials.
AUTHOR = regex.compile(
    rf"(?:{_INIT}+\s*{_PART}{_WORD}"
    rf"|{_PART}{_WORD}(?:\s+{_WORD}){{0,2}},\s*(?:{_INIT}|{_WORD})"
    rf"|\(?(?:The\s+)?{_WORD}(?:\s+{_WORD}){{0,3}}\s+(?:[Cc]ollaboration\b|Coll(?:ab)?\.)"
    rf"|(?:The\s+)?[Cc]ollaboration\s+{_WORD}"
    rf"|{_WORD}\s+{_INIT}*{_PART}{_WORD}\s*(?:,|and\b|\(|et al))"
)


#: A label at the start of a field, in one of the forms that can also part items by itself.
RUN_LABEL = regex.compile(r"\s*([\[(]?)((?<=\[)\d+|\d{1,3}|[A-Za-z]|[ivx]{1,5})([\])]|(?<=\d)\.)[.:]?\s+(?=\S)")


def _roman(n: int) -> str:
    signs = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))
    out = ""
    for value, sign in signs:
        out += sign * (n // value)
        n %= value
    return out


def label_run(raw: str) -> Run | None:
    """The labels after the first, in their order, if the field opens with one."""
    first = RUN_LABEL.match(raw)
    if not first:
        return None
    opener, value, closer = first.groups()
    if value.isdigit():
        values = map(str, count(int(value) + 1))
    elif value in ("i", "I"):
        values = (_roman(k) if value == "i" else _roman(k).upper() for k in count(2))
    elif value in ("a", "A"):
        values = (chr(ord(value) + k) for k in range(1, 26))
    else:
        return None
    return Run(opener, closer, values)


#: Blanks and delimiters that may stand at the ends of an item.
ENDS = " \t\r\n\v\f\u00a0;|•,/"


def strip_label(piece: str) -> str:
    """A piece without blanks at its ends and the item label at its start."""
    piece = piece.strip()
    m = LABEL.match(piece)
    return piece[m.end() :].strip() if m else piece


def _begins(piece: str) -> bool:
    piece = strip_label(piece)
    return AUTHOR.match(piece[1:].lstrip() if piece[:1] == '"' else piece) is not None


def citations(raw: str | None) -> list[str]:
    """The citations of a bibliography entry, cleaned; one item if it holds a single one.

    A delimiter parts two citations if what stands before it, back to the last parting, holds a
    year, and what follows opens as a citation does. Other delimiters belong to the citation.
    """
    if raw is None or not raw.strip():
        return []
    items: list[str] = []
    begin: int | None = None
    cuts = spans(raw)
    run = label_run(raw)
    labelled = spans(raw, run=run) if run else []
    if len(labelled) > 1 and all(YEAR.search(raw[a:b]) and _begins(raw[a:b]) for a, b, _ in labelled):
        cuts = labelled
    for k, (start, end, _) in enumerate(cuts):
        if begin is None:
            begin = start
        left = raw[begin:end]
        if not left.strip():
            begin = None
            continue
        rest = next((raw[s:e] for s, e, _ in cuts[k + 1 :] if raw[s:e].strip()), None)
        if rest is None or (YEAR.search(left) and _begins(rest)):
            items.append(left)
            begin = None
    if begin is not None:
        items.append(raw[begin:])
    cleaned = (unquote(strip_label(x.strip(ENDS))) for x in items) if len(items) > 1 else iter([raw.strip()])
    return [x for x in cleaned if x]


def explode_packed(df: DataFrame, keys: list[str], field: str, at_least: int = 2) -> DataFrame:
    """One row per citation of ``field``: the ``keys``, item_pos (from 0) and item.

    Fields that hold fewer than ``at_least`` items give no rows. Needs no shuffle: a field is
    split where it is read.
    """
    kinds = dict(df.select(*keys).dtypes)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [citations(x) for x in pdf[field]]
            pdf = pdf[keys].assign(item=[p if len(p) >= at_least else [] for p in parts])
            pdf["item_pos"] = [list(range(len(p))) for p in pdf["item"]]
            out = pdf.explode(["item_pos", "item"]).dropna(subset=["item"])
            out["item_pos"] = out["item_pos"].astype("int32")
            yield out[[*keys, "item_pos", "item"]]

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", item_pos int, item string"
    return df.select(*keys, field).where(F.length(F.trim(field)) > 0).mapInPandas(run, schema)


def packed_entries(papers: DataFrame) -> DataFrame:
    """Citations of the bibliography entries that hold several: row_id, bib_key, item_pos, item."""
    raw = papers.select("row_id", F.explode("bib_entries").alias("bib_key", "v")).select(
        "row_id", "bib_key", F.col("v.bib_entry_raw").alias("raw")
    )
    return explode_packed(raw, ["row_id", "bib_key"], "raw")
