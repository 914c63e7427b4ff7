"""Survivors: the ranking against sorting, the model on made sources, edge cases."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom.llm import survivor
from paperloom.llm.survivor import FIELDS

SCHEMA = (
    "graded_id bigint, paper_id string, pos int, retrieved_level int, candidate struct<unique_id_list:array<string>,doi:string,arxiv:string,dblp:string,"
    "mag:string,pubmed:string,title:string,author:array<string>,journal:string,journal_volume:string,journal_page:string,year:int,publisher:string,"
    "content:string,short_content:string,score:double,from_structure:string>, retrieved_at timestamp, n_rows int"
)
NAMES = "unique_id_list doi arxiv dblp mag pubmed title author journal journal_volume journal_page year publisher content short_content score from_structure".split()


def row(i, paper="6101.00001", pos=0, level=5, score=1.0, engine="anystyle", at=0, **fields):
    c = {n: fields.get(n) for n in NAMES} | {"score": score, "from_structure": engine}
    return (i, paper, pos, level, tuple(c[n] for n in NAMES), dt.datetime(2020, 1, 1) + dt.timedelta(days=at), 7)


def made(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def key(r):
    c = dict(zip(NAMES, r[4], strict=True)) if r[4] else dict.fromkeys(NAMES)
    s = c["score"]
    s = -1 if s is None or math.isnan(s) or not 0 <= s <= 1 else s
    engine = {"anystyle": 2, "grobid": 1}.get((c["from_structure"] or "").strip().lower(), 0)
    return (-(2**31) if r[3] is None else r[3], s, sum(c[f] is not None for f in FIELDS), engine, r[5], -r[0])


def test_ranking(spark):
    rng = random.Random(2)
    rows = [
        row(
            i, rng.choice(["6101.00001", "arXiv:6101.00001", " 6101.00001v2", "ARXIV: 6101.00001"]), rng.randint(0, 6), rng.choice([None, -1, 4, 5]),
            rng.choice([None, math.nan, 7.0, -1.0, 0.5, 1.0]), rng.choice(["anystyle", " GROBID", None, "plain_text"]), rng.randint(0, 2),
            doi=rng.choice([None, "d"]), year=rng.choice([None, 2000]),
        )
        for i in range(200)
    ]
    got = {r.pos: (r.graded_id, r.n_rows) for r in survivor.fuse(made(spark, rows)).collect()}
    want = {}
    for r in rows:
        want.setdefault(r[2], []).append(r)
    assert got == {p: (max(rs, key=key)[0], len(rs)) for p, rs in want.items()}


def test_fused_values(spark):
    rows = [row(1, engine="anystyle", doi="10.1/a", title="Right one", year=2001), row(2, engine="grobid", doi="10.1/A ", title="Right, one", year=2001), row(3, engine="plain_text", doi="x", year=1999)]
    r = survivor.fuse(made(spark, rows)).collect()[0]
    assert (r.doi.lower(), r.title, r.year) == ("10.1/a", "Right one", 2001) and 0 < r.support <= 1


def test_copied_votes_are_discounted():
    apart = {"0000": 60, "0123": 40, "0100": 8, "0020": 8, "0003": 8}
    copied = {"0000": 60, "0011": 300, "0110": 60, "0022": 200, "0122": 200}
    assert survivor.fit(copied)["depends"][2, 3] > 0.5 > survivor.fit(apart)["depends"][0, 1]


def test_odd_rows(spark):
    none = (9, "6101.00001", 3, None, None, None, 0)
    rows = [none, none, row(1, paper=None), row(2, pos=None), row(3, paper=" "), row(4, pos=5, title=" ", doi="")]
    got = {r.pos: (r.graded_id, r.n_rows, r.title, r.support) for r in survivor.fuse(made(spark, rows)).collect()}
    assert got == {3: (9, 2, None, None), 5: (4, 1, None, None)}
    assert survivor.fuse(made(spark, rows).limit(0)).count() == 0


def test_old_ids_however_typed(spark):
    forms = ["qfx-th/6908006", "qfx-th_6908006", "arXiv:qfx-th/6908006", " QFX-TH/6908006v2 ", "https://arxiv.org/abs/qfx-th/6908006"]
    got = survivor.fuse(made(spark, [row(i, paper=p) for i, p in enumerate(forms)])).collect()
    assert [(r.paper_key, r.n_rows) for r in got] == [("qfx-th/6908006", len(forms))]


@pytest.mark.parametrize("hot", [1, 1000])
def test_claims_over_spellings_and_recency(spark, monkeypatch, hot):
    monkeypatch.setattr(survivor, "HOT_ROWS", hot, raising=False)
    rows = [row(i, journal=j, title=t, at=a) for i, (j, t, a) in enumerate([
        ("Phys. Rev.", "a", 1), ("phys rev", "B", 3), ("PHYS REV", "b.", 2), ("Acta", "a", 0), ("Acta", None, 9)])]  # two spell one journal; a tie of titles
    rows.append(row(9, engine="grobid", journal="phys rev", title="?!"))
    held = survivor.groups(made(spark, rows))
    got = held.select("n_rows", "claims.journal", "claims.title", survivor.pattern(F.col("claims.journal")).alias("p")).collect()[0]
    assert (got.n_rows, survivor.ENGINES[:2]) == (6, ("anystyle", "grobid"))
    assert [x and x.lower().strip(".").replace(".", "") for x in got.journal] == ["phys rev", "phys rev", None, None]
    assert got.title[0] in ("B", "b.") and got.title[1] is None and got.p == "00--"


def test_planted_copier_and_field_truth(spark):
    """An engine that copies another, errors and all, is found out; honest ones are not, and most fields come out true."""
    rng = random.Random(8)
    rows, truth = [], {}
    for g in range(1500):
        true = f"title {g} of {rng.random():.6f}"
        truth[f"p{g}"] = true
        own = {e: true if rng.random() < right else f"wrong {g} {rng.randint(0, 19)}" for e, right in (("anystyle", 0.7), ("plain_text", 0.85), ("other", 0.85))}
        own["grobid"] = own["anystyle"] if rng.random() < 0.9 else f"wrong {g} {rng.randint(0, 19)}"
        rows += [(f"p{g}", e, t) for e, t in own.items()]
    null = F.lit(None).cast("string")
    made = spark.createDataFrame(rows, "paper_id string, e string, t string").select(
        F.monotonically_increasing_id().alias("graded_id"), "paper_id", F.lit(0).alias("pos"), F.lit(1).alias("retrieved_level"), F.lit(dt.datetime(2024, 1, 1)).alias("retrieved_at"),
        F.struct(*(F.col("t").alias(f) if f == "title" else null.alias(f) for f in survivor.FIELDS), F.lit(0.5).alias("score"), F.col("e").alias("from_structure")).alias("candidate"),
    )
    model = {(r.engine, r.other): r.value for r in survivor.source_model(made).collect()}
    assert model["anystyle", "grobid"] > 0.8
    assert max(v for (a, b), v in model.items() if b and {a, b} != {"anystyle", "grobid"}) < 0.15
    assert abs(model["anystyle", None] - 0.7) < 0.1 > abs(model["plain_text", None] - 0.85)
    fused = {r.paper_key: r.title for r in survivor.fuse(made).collect()}
    right = sum(fused[p] == t for p, t in truth.items()) / len(truth)
    votes = Counter()
    for p, _, t in rows:
        votes[p, t] += 1
    plain = sum(votes[p, t] == max(n for (q, _), n in votes.items() if q == p) for p, t in list(truth.items())[:200]) / 200
    assert right > 0.85 and right > plain - 0.02
