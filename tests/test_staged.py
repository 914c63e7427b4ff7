"""Staged retrieval: fields, parsers' own records, ids."""

import datetime as dt

from pyspark.sql import functions as F

from paperloom.operators import retrieval
from paperloom.plans import reference

CANDIDATE = "title string, author array<string>, journal string, journal_volume string, journal_page string, year int, content string, arxiv string, from_structure string"


def test_staged_searches_all_fields_per_parser(spark):
    def c(engine, title=None, journal=None, volume=None, arxiv=None):
        return (title, None, journal, volume, None, None, None, arxiv, engine)

    at = dt.datetime(2020, 1, 1)
    rows = [
        (100, "p", 0, at, c("anystyle", journal="Nord Lett", volume="77")), (101, "p", 0, at, c("grobid", title="On sparse foams")),
        (200, "q", 0, at, c("anystyle", arxiv="6101.00001")), (300, "r", None, at, c(None, title="On viscous jets")),
    ]
    graded = spark.createDataFrame(rows, f"graded_id bigint, paper_id string, pos int, retrieved_at timestamp, candidate struct<{CANDIDATE.replace(' ', ':').replace(',:', ',')}>")
    asked = reference._parsed_citations(graded)
    assert {(r.cite_id, r.parser, r.title) for r in asked.collect()} == {
        (100, "anystyle", None), (100, "grobid", "On sparse foams"), (200, "anystyle", None), (300, "plain_text", "On viscous jets")}
    docs = spark.createDataFrame([
        (1, None, None, "Nord Lett", "77", None, None, None), (2, "On sparse foams", None, None, None, None, None, None), (3, "On viscous jets", None, None, None, None, None, None),
    ], "entity_id bigint, title string, author array<string>, journal string, journal_volume string, journal_page string, year int, content string")
    record = F.struct("title", "author", "journal", "journal_volume", "journal_page", "year", "content")
    got = retrieval.staged(asked, docs, retrieval.ENGINES["integrate"], record, record, reference._PARSERS, given="given").collect()
    hits = {(r.cite_id, r.parser): (r.entity_id, r.found_id) for r in got if r.hit_rank == 1}
    assert hits[100, "anystyle"] == (1, None) and hits[200, "anystyle"] == (None, "6101.00001") and hits[300, "plain_text"] == (3, None)
