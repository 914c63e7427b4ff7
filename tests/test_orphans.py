"""Orphans: the cascade against a loop over small tables, and the marks of papers."""

import datetime as dt
import random

from pyspark.sql import functions as F

from paperloom.operators import orphans
from paperloom.operators.orphans import ForeignKey


def test_cascade_is_the_fixpoint(spark):
    rng = random.Random(3)
    a = [(f"a{i}", rng.choice([None, *(f"a{j}" for j in range(14))])) for i in range(10)]
    b = [(f"b{i}", rng.choice([None, *(f"a{j}" for j in range(12))])) for i in range(30)]
    ta = spark.createDataFrame(a, "orphan_id string, up string")
    tb = spark.createDataFrame(b, "orphan_id string, a string")
    keys = [ForeignKey("a", ("up",), "a", ("orphan_id",)), ForeignKey("b", ("a",), "a", ("orphan_id",))]
    found = orphans.cascade({"a": ta, "b": tb}, keys)
    got = {(t, r.orphan_id): r.orphan_level for t, df in found.items() for r in df.collect()}
    ids, want, level = {x for x, _ in a}, {}, 0
    want = {("a", x): 0 for x, u in a if u and u not in ids} | {("b", x): 0 for x, u in b if u and u not in ids}
    while True:
        level += 1
        new = {(t, x): level for t, rows in (("a", a), ("b", b)) for x, u in rows if want.get(("a", u)) == level - 1 and (t, x) not in want}
        if not new:
            break
        want |= new
    assert got == want


PAPERS = (
    "row_id bigint, paper_id string, delivered_at timestamp, body_text array<struct<section:string,sec_number:string,text:string>>, "
    "bib_entries map<string,struct<bib_entry_raw:string,ids:map<string,string>>>, ref_entries map<string,struct<type:string,latex:string,caption:string>>"
)
CHANGES = "paper_id string, entry_table string, entry_key string, change_kind string, changed_at timestamp, received_at timestamp"
DAY = dt.datetime(2020, 1, 10)


def papers(spark, *rows):
    return spark.createDataFrame(rows, PAPERS)


def test_marks_and_changes(spark):
    entry = ("raw", {})
    text = "x {{cite:aa}} {{ CITE : BB , cc}} {{figure:f1}} {{note:zz}} {{table:aa}}"
    p = papers(
        spark,
        (1, "p", DAY, [("{{cite:dd}}", "1", text), (None, None, None)], {"aa": entry, "cc": None}, {"f1": None}),
        (2, "p", DAY + dt.timedelta(days=9), [("s", "1", "{{cite:aa}} {{cite:bb}}")], None, None),
        (3, "q", DAY, None, {}, {}),
    )
    d = dt.timedelta(days=1)
    log = [
        ("p", "bib_entries", "bb", "add", DAY - d, DAY + 5 * d), ("p", "bib_entries", "aa", "delete", DAY - 2 * d, DAY),
        ("p", "bib_entries", "aa", "add", DAY + d, DAY), ("p", "bib_entries", "bb", "delete", DAY + 2 * d, DAY),
        ("p", "bib_entries", "bb", "add", DAY - d, DAY + 5 * d), ("q", "bib_entries", "cc", "add", DAY - d, DAY),
    ]
    c = spark.createDataFrame(log, CHANGES)
    got = {tuple(r) for r in orphans.missing_entries(p, c).collect()}
    assert got == {
        (1, "bib_entries", "aa"), (1, "bib_entries", "cc"), (1, "bib_entries", "dd"), (1, "ref_entries", "f1"), (1, "ref_entries", "aa"), (2, "bib_entries", "bb"),
    }


def test_report_tells_direct_from_inherited(spark):
    body = [("s", "1", "a"), ("s", "3.1", "{{cite:aa}}"), ("s", "3.1.1", "{{cite:bb}}")]
    p = papers(spark, (1, "p", DAY, body, {"aa": ("r", {})}, None))
    c = spark.createDataFrame([], CHANGES)
    got = {r.orphan_table: (r.month, r.direct, r.inherited) for r in orphans.orphan_report(p, c).collect()}
    assert got == {"sections": ("2020-01", 1, 1), "bib_entries": ("2020-01", 1, 1)}


def test_empty(spark):
    p, c = papers(spark), spark.createDataFrame([], CHANGES)
    assert orphans.missing_entries(p, c).count() == 0
    assert orphans.orphan_report(p, c).count() == 0
    assert orphans.missing_entries(p.withColumn("orphan_id", F.lit(1)), c.withColumn("month", F.lit(1))).columns == ["row_id", "entry_table", "entry_key"]
