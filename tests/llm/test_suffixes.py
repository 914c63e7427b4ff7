"""Shared passages: against brute force over all windows, and edge cases."""

import random

from paperloom.llm import queries, suffixes
from pyspark.sql import functions as F


def covered(pages):
    """Tokens of a page that stand in a window that an earlier page of its host has, by trying all."""
    held, out = {}, set()
    streams = {p: [(i, j, w) for i, text in enumerate(paras or []) for j, w in enumerate((text or "").split())] for p, (_, paras) in pages.items()}
    for p in sorted(pages):
        words = [w for _, _, w in streams[p]]
        for at in range(len(words) - suffixes.RUN + 1):
            key = (pages[p][0], tuple(words[at : at + suffixes.RUN]))
            if held.setdefault(key, p) != p:
                out |= {(p, i, j) for i, j, _ in streams[p][at : at + suffixes.RUN]}
    return out


def test_against_all_windows(spark):
    rng = random.Random(3)
    passages = [[rng.choice("abcdefgh") for _ in range(n)] for n in (7, 8, 9, 20, 40)]
    pages = {}
    for p in range(30):
        paras = []
        for _ in range(rng.randint(0, 4)):
            words = [rng.choice("pqrstuvwxyz") + rng.choice("0123") for _ in range(rng.randint(0, 12))] + rng.choice(passages) + [f"n{rng.random()}"]
            paras.append(rng.choice([" ".join(words), None, "", "  ".join(words[::-1])]))
        pages[p] = (f"h{p % 3}", paras)
    df = spark.createDataFrame([(p, h, x, "t") for p, (h, x) in pages.items()] * 2, "section_id bigint, paper_id string, section_content array<string>, text string")
    got = {(r.page, r.para, j) for r in suffixes.runs(df).collect() for j in range(r["first"], r["last"] + 1)}
    want = covered(pages)
    assert want and got == want
    left = suffixes.unique(df).where("text is not null").agg(F.sum(F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")))).first()[0]
    assert left == sum(len((t or "").split()) for _, x in pages.values() for t in x) - len(want)


def test_edges(spark):
    one = "the same words stand here on both of the pages"
    rows = [(1, None, [one]), (2, None, [one]), (3, "h", [one, one]), (4, "h", None), (5, "h", []), (6, "h", [None, one])]
    df = spark.createDataFrame(rows, "section_id bigint, paper_id string, section_content array<string>")
    assert [(r.host, r.page, r.para, r["first"], r["last"]) for r in suffixes.runs(df).collect()] == [("h", 6, 1, 0, 9)]
    assert suffixes.runs(df.limit(0)).count() == 0 and suffixes.unique(df.limit(0)).count() == 0


def test_clean_text_without_shared_passages(spark, tmp_path):
    shared = "one two three four five six seven eight"
    rows = [
        (1, "h", [f"{shared} <b>nine</b>", None]), (2, "h", [f"a  *b* &amp; {shared} c", "  <i>kept</i>  whole", "", None, shared]), (3, None, [f"{shared} \\emph{{x}}"]), (4, "h", None),
    ]
    df = spark.createDataFrame(rows, "section_id bigint, paper_id string, section_content array<string>")
    df.unionByName(df.limit(1)).write.parquet(f"{tmp_path}/sections.parquet")
    got = sorted((tuple(r) for r in queries.p2_unique(spark, str(tmp_path)).collect()), key=lambda r: r[1:3])
    assert got == [
        ("h", 1, 0, f"{shared} nine"), ("h", 1, 1, None),
        ("h", 2, 0, "a b & c"), ("h", 2, 1, "kept  whole"), ("h", 2, 2, ""), ("h", 2, 3, None), ("h", 2, 4, ""),
        ("page 3", 3, 0, f"{shared} x"),
    ]
