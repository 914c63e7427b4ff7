"""BibTeX entries to flat records."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields that each kind of entry must have; a slash parts alternatives (fixed values).
REQUIRED = {
    "article": "author title journal year", "book": "author/editor title publisher year", "booklet": "title",
    "conference": "author title booktitle year", "electronic": "title url", "inbook": "author/editor title chapter/pages publisher year",
    "incollection": "author title booktitle publisher year", "inproceedings": "author title booktitle year", "manual": "title",
    "mastersthesis": "author title school year", "misc": "", "periodical": "title year", "phdthesis": "author title school year",
    "proceedings": "title year", "techreport": "author title institution year", "unpublished": "author title note",
}
_TEXT = T.StringType()
PERSON = T.StructType([T.StructField("family", _TEXT), T.StructField("given", _TEXT)])
ENTRY = T.StructType([
    T.StructField("type", _TEXT), T.StructField("key", _TEXT), T.StructField("fields", T.MapType(_TEXT, _TEXT)),
    T.StructField("author", T.ArrayType(PERSON)), T.StructField("lacking", T.ArrayType(_TEXT)),
])


def _value(text: str, at: int) -> tuple[str, int]:
    """The value that begins at a place: in braces, in quotes, or bare; parts joined by # are one."""
    out = []
    while at < len(text):
        at += len(text[at:]) - len(text[at:].lstrip())
        c = text[at : at + 1]
        if c == "{":
            depth, end = 0, at
            while end < len(text):
                depth += (text[end] == "{") - (text[end] == "}")
                end += 1
                if not depth:
                    break
            out.append(text[at + 1 : end - 1])
            at = end
        elif c == '"':
            end = text.find('"', at + 1)
            end = len(text) if end < 0 else end
            out.append(text[at + 1 : end])
            at = end + 1
        else:
            m = re.compile(r"[^,#}\s]*").match(text, at)
            out.append(m[0])
            at = m.end()
        rest = text[at:].lstrip()
        if not rest.startswith("#"):
            break
        at += len(text[at:]) - len(rest) + 1
    return " ".join("".join(out).replace("{", "").replace("}", "").split()), at


def entries(text: str) -> list[dict]:
    """The entries of a BibTeX text; comments, strings and preambles are passed over."""
    out = []
    for m in re.finditer(r"@(\w+)\s*[{(]\s*([^,\s]*)\s*,", text or ""):
        kind = m[1].lower()
        if kind in ("comment", "string", "preamble"):
            continue
        fields, at = {}, m.end()
        while name := re.compile(r"\s*,?\s*([\w-]+)\s*=\s*").match(text, at):
            value, at = _value(text, name.end())
            fields.setdefault(name[1].lower(), value)
            at = at + 1 if text[at : at + 1] == "," else at
        lacking = [r for r in REQUIRED.get(kind, "").split() if not any(fields.get(x) for x in r.split("/"))]
        people = []
        for person in re.split(r"\s+and\s+", fields.get("author", "")):
            family, comma, given = person.partition(",")
            if not comma:
                given, _, family = person.rpartition(" ")
            if person:
                people.append({"family": family.strip(), "given": given.strip()})
        out.append({"type": kind, "key": m[2], "fields": fields, "author": people, "lacking": lacking})
    return out


@F.pandas_udf(T.ArrayType(ENTRY))
def bibtex_udf(text: pd.Series) -> pd.Series:
    """The entries of each text, with required fields that they lack."""
    return pd.Series([None if t is None else entries(t) for t in text])
