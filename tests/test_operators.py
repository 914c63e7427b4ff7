"""Batches, identity, retrieval, grading and citations against small brute-force versions."""

import itertools
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom.functions import reference, scoring
from paperloom.operators import batch, citations, grading, identity, retrieval


def test_shards_are_linspace(spark):
    for n, parts in ((10, 3), (1, 4), (7, 7), (23, 5)):
        df = spark.range(n).select(F.format_string("%03d", "id").alias("k"))
        got = {int(r.k): r.shard for r in batch.shard_of(df, "k", parts).collect()}
        bounds = [i * n // parts for i in range(parts + 1)]
        assert got == {k: max(i for i in range(parts) if bounds[i] <= k) for k in range(n)}


def test_sets_and_statuses(spark):
    a, b = spark.createDataFrame([("x",), ("y",), ("x",)], "id string"), spark.createDataFrame([("y",), ("z",)], "id string")
    assert [r.id for r in batch.unfinished(a, b).collect()] == ["x", "x"]
    assert batch.unfinished(a, b, redo=True).count() == 3
    assert {r.id for r in batch.remake_set(b, a, b).collect()} == {"x", "y", "z"}
    tried = batch.tried(lambda x: int(x), "int", {"ValueError": "NoNumber"})
    df = spark.createDataFrame([("3",), ("x",), (None,)], "s string").select("s", tried("s").alias("t"))
    assert {r.s: (r.t.value, r.t.status) for r in df.collect()} == {"3": (3, "Finish"), "x": (None, "NoNumber"), None: (None, "Skip")}


def record(**x):
    return dict.fromkeys("title author journal journal_volume journal_page year content".split()) | x


def test_similarity():
    s = scoring.similarity
    query = record(author=["R. B. Behunin", "B. H. Hu"], journal_volume="43", journal_page="12001", journal="Journal of Physics A: Mathematical and Theoretical", year=2010)
    found = record(
        title="Nonequilibrium force", year=2009, journal="j phys a, journal of physics a: mathematical and theoretical", journal_page="012001", journal_volume="43",
        author=["R. Behunin", "B. Hu"],
    )
    assert 0.9 < s(found, query) <= 1
    assert s(record(title="A drift of jets"), record(title="A drift of jets.")) == 1
    assert s(record(title="Deep nets"), record(title="Deep nets for images")) == 1
    assert s(record(title="Deep nets"), record(title="Wide trees")) == 0
    assert s(record(), record(year=2000)) == 0
    assert s(record(content="abc"), record(content="abc")) == 1
    assert s(record(author=["X Y"], content="ab"), record(author=["Q. Z"], content="ax")) == 0.5
    assert scoring.ratio("", "") == 0 and scoring.norm(None) == ""


def test_similarity_takes_nulls(spark):
    kind = scoring.RECORD
    df = spark.createDataFrame([(1, None, None), (2, tuple(record(title="a b").values()), tuple(record(title="a b").values()))], f"i int, a {kind}, b {kind}")
    assert {r.i: r.s for r in df.select("i", scoring.similarity_udf("a", "b").alias("s")).collect()} == {1: 0.0, 2: 1.0}


CANDIDATES = "c int, engine string, score double, rank int, title string, ids map<string,string>, is_note boolean"


def test_grades(spark):
    rows = [
        (1, "a", 1.0, 0, "t", {}, False), (2, "a", 0.97, 0, "t", {}, False), (3, "a", 0.3, 0, "t", {}, False), (4, "a", 0.7, 0, "t", {}, False),
        (5, "a", 0.7, 0, "same title here", {}, False), (5, "b", 0.6, 1, "same title here", {}, False), (6, "a", 0.7, 0, "one", {"doi": "x"}, False),
        (6, "b", 0.6, 1, "other", {"doi": "x"}, False), (7, "a", 0.7, 0, "one", {"doi": "x"}, False), (7, "b", 0.6, 1, "two", {"doi": "y"}, None),
        (8, "a", None, 0, None, None, True), (9, "a", None, 0, None, None, None), (10, "a", 0.7, 1, "late", {}, False), (10, "a", 0.7, 0, "first", {}, False),
    ]
    got = {r.c: (r.retrieved_level, r.candidate.title) for r in grading.grade(spark.createDataFrame(rows, CANDIDATES), ["c"]).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: 5, 2: 4, 3: 0, 4: 2, 5: 3, 6: 3, 7: 1, 8: -1, 9: 0, 10: 2}
    assert got[10][1] == "first"


def test_recommended_and_checked(spark):
    q = spark.createDataFrame([("p", 1, "A. Bee, on very long drifts 1999"), ("p", 2, "two; texts drifts"), ("q", 3, "A. Bee, on very long drifts 1999")], "paper_id string, query_id int, text string")
    k = spark.createDataFrame([("p", 7, "A. Bee: on very long drifts, 1999"), ("p", 8, "something wholly other about drifts")], "paper_id string, entry_id int, text string")
    assert [(r.query_id, r.known_id) for r in grading.recommended(q, k).collect()] == [(1, 7)]
    a = spark.createDataFrame([(1, {"doi": "x"}), (2, {"doi": "x"}), (3, {"doi": "x"})], "c int, ids map<string,string>")
    b = spark.createDataFrame([(1, {"arxiv": "q", "doi": "x"}), (2, {"doi": "y"})], "c int, ids map<string,string>")
    assert {r.c: r.check for r in grading.double_check(a, b, ["c"]).collect()} == {1: "same", 2: "different", 3: "unchecked"}


def test_identity_against_a_loop(spark):
    rng = random.Random(1)
    sources = [(p, [(f"{p}{i}", {k: rng.choice(["", *"abcdefgh"]) for k in rng.sample(["doi", "arxiv", "mag"], 2)}) for i in range(14)]) for p in ("A", "B", "C")]
    table, outcome = {}, {}
    for prefix, rows in sources:
        groups = []
        for key, ids in rows:
            mine = {x for x in ids.items() if x[1]}
            hit = [g for g in groups if g[1] & mine]
            merged = ([key], set(mine)) if mine else None
            for g in hit:
                groups.remove(g)
                merged = (merged[0] + g[0], merged[1] | g[1])
            if merged:
                groups.append(merged)
            else:
                outcome[key] = "no_ids"
        fresh = dict(table)
        for keys, ids in groups:
            found = {table[x] for x in ids if x in table}
            state = "new" if not found else "known" if len(found) == 1 else "conflict"
            entity = f"{prefix}.{min(keys)}" if not found else min(found)
            for k in keys:
                outcome[k] = state
            if state != "conflict":
                fresh |= {x: entity for x in ids}
        table = fresh
    dfs = [(p, spark.createDataFrame(rows, "row_key string, ids map<string,string>")) for p, rows in sources]
    aliases, outcomes = identity.build(dfs)
    assert {r.row_key: r.outcome for r in outcomes.collect()} == outcome
    assert {(r.type, r.value): r.entity_id for r in aliases.collect()} == table
    (kind, value), entity = next(iter(table.items()))
    said = identity.lookup(aliases, f"{kind}:{value}").collect()[0]
    assert said.entity_id == entity and f"{kind}:{value}" in said.aliases.split(" | ")


def test_upsert(spark):
    f = ("title", "author", "journal", "journal_volume", "journal_page", "year")
    schema = "entity_id string, title string, author array<string>, journal string, journal_volume string, journal_page string, year int"
    old = spark.createDataFrame([("a", "t", None, None, None, None, None), ("b", "t", ["x"], None, None, None, None), ("e", "t", None, None, None, None, None)], schema)
    new = spark.createDataFrame([("a", "u", ["y"], None, None, None, None), ("b", "u", None, None, None, None, None), ("c", "v", None, None, None, None, None), ("d", None, ["x"], None, None, None, None), (None, "q", None, None, None, None, None)], schema)
    got = {r.entity_id: (r.outcome, r.title, r.author) for r in identity.upsert(old, new, f).collect()}
    assert got == {"a": ("filled", "t", ["y"]), "b": ("nothing_new", "t", ["x"]), "c": ("inserted", "v", None), "d": ("too_little", None, ["x"]), "e": ("kept", "t", None)}


def test_bm25_against_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    docs = [(f"d{i:02}", " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(60)] + [("n", None)]
    asked = [(f"q{i}", " ".join(rng.sample(words, 3))) for i in range(8)] + [("z", "nothing known"), ("y", None)]
    d, q = spark.createDataFrame(docs, "entity_id string, title string"), spark.createDataFrame(asked, "query_id string, title string")
    got = {(r.query_id, r.hit_rank): (r.entity_id, r.bm25) for r in retrieval.bm25(q, d, ["title"], 3, most_common=1.0).collect()}
    bags = {k: Counter(re.findall(r"\w+", t)) for k, t in docs if t}
    avg = sum(sum(b.values()) for b in bags.values()) / len(bags)
    df = Counter(w for b in bags.values() for w in b)
    want = {}
    for k, t in asked:
        scores = []
        for e, b in bags.items():
            n = sum(b.values())
            s = sum(math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * n / avg)) for w in set(t.split()) if b[w]) if t else 0
            if s:
                scores.append((-s, e))
        want |= {(k, i + 1): x for i, x in enumerate(sorted(scores)[:3])}
    assert set(got) == set(want)
    assert all(got[k][0] == want[k][1] and got[k][1] == pytest.approx(-want[k][0]) for k in want)


def test_citation_texts(spark):
    a, b = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "Beta beta gamma delta epsilon zeta eta theta iota kappa lambda"
    df = spark.createDataFrame([(1, f"{a}; {b}."), (2, f"{a}; pp. 3"), (3, "short"), (4, None), (5, f"front; {a}; {b}")], "i int, text string")
    got = {}
    for r in citations.split_rows(df).collect():
        got.setdefault(r.i, []).append(r.text)
    assert got == {1: [a, b], 2: [f"{a}pp. 3;"], 3: [None], 4: [None], 5: ["front;", a, b]}
    short = spark.createDataFrame([("x" * 7000,), ("y",)], "t string").select(citations.shortened(F.col("t")).alias("t")).collect()
    assert [len(r.t) for r in short] == [6004, 1]
    refs = spark.createDataFrame([("p", 0, "a"), ("p", 1, "b"), ("q", 0, "c")], "paper_id string, pos int, text string")
    one = spark.createDataFrame([("p", 0, "A"), ("p", 1, "B"), ("q", 0, "C"), ("q", 1, "D")], "paper_id string, pos int, record string")
    got = {(r.paper_id, r.pos): (r.anystyle, r.status) for r in citations.merged_parsers(refs, {"anystyle": one}).collect()}
    assert got == {("p", 0): ("A", "pass"), ("p", 1): ("B", "pass"), ("q", 0): (None, "different_length_anystyle")}


def test_canonical_references(spark):
    rows = [
        '{"title": ["A long title"], "author": [{"given": "Jane M.", "family": "Doe"}, "Roe, Max", {"name": "Li Bo"}, "x"], "container-title": ["J. A"], "issued": {"date-parts": [[2001, 3]]}}',
        '{"title": "ab", "authors": "A. One, B. Two and C. Three", "journal": {"name": "J", "volume": "7", "pages": "1-2"}, "date": "3 May 1999"}',
        '{"title": "", "author": [], "externalids": {"DOI": "https://doi.org/10.1/X", "CorpusId": "5", "PubMed": " "}}', None, "[1]",
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string").select("i", F.try_parse_json("s").alias("v"))
    got = {r.i: r.r for r in df.select("i", reference.canonical(F.col("v")).alias("r")).collect()}
    assert (got[0].title, got[0].author, got[0].journal, got[0].year) == ("A long title", ["J. M. Doe", "M. Roe", "L. Bo"], "J. A", 2001)
    assert (got[1].title, got[1].author, got[1].journal, got[1].journal_volume, got[1].journal_page, got[1].year) == (None, ["A. One", "B. Two", "C. Three"], "J", "7", "1-2", 1999)
    assert got[2].unique_id == {"doi": "10.1/X"} and got[2].title is None and got[2].author is None
    assert got[3].title is None and got[4].title is None
    ids = spark.createDataFrame([({"doi": "a", "mag": "1"}, {"doi": "b", "mag": "1"}), ({"doi": "a"}, {"mag": "a"}), ({"doi": "a"}, None)], "a map<string,string>, b map<string,string>")
    assert [r.x for r in ids.select(reference.same_ids(F.col("a"), F.col("b")).alias("x")).collect()] == [True, False, False]


def test_ranks_have_no_gaps(spark):
    df = spark.createDataFrame([(x,) for x in itertools.chain(range(50), [7, 7])], "k int")
    assert sorted(r.n for r in batch.with_rank(df, "k", "n").collect()) == list(range(52))


def test_session_without_a_shared_folder(spark):
    """A cut needs no setting on one machine; elsewhere it is asked for."""
    import types

    from paperloom import session

    none = types.SimpleNamespace(get=lambda *_: None)
    here, there = (types.SimpleNamespace(conf=none, sparkContext=types.SimpleNamespace(master=m)) for m in ("local[2]", "spark://host:7077"))
    assert session.shared_dir(here).startswith("file://") and session.shared_dir(here) == session.shared_dir(here)
    try:
        session.shared_dir(there)
    except ValueError as e:
        assert "spark.checkpoint.dir" in str(e)
    else:
        raise AssertionError("no error")


def test_groups_of_long_chains(spark):
    """Rows tied one to the next over a long chain are one group; the smallest row names it."""
    from paperloom.operators import identity

    n = 100
    rows = [(f"r{i:03}", "doi", str(j)) for i in range(n) for j in (i, i + 1)] + [("s1", "doi", "x"), ("s2", "doi", "x"), ("t", "doi", "y")]
    got = {r.row_key: r.group for r in identity.within_source(spark.createDataFrame(rows, "row_key string, type string, value string")).collect()}
    assert {got[f"r{i:03}"] for i in range(n)} == {"r000"} and got["s2"] == got["s1"] == "s1" and got["t"] == "t"


def test_search_finds_what_only_common_words_name(spark):
    """A query whose rare word leads elsewhere still finds the record that its common words name best."""
    docs = [(i, "deep drift of jets") for i in range(40)] + [(100, "rare odd thing else"), (101, "deep drift of jets in jets of drift")]
    df = spark.createDataFrame(docs, "entity_id bigint, title string")
    asked = spark.createDataFrame([(1, "deep drift of jets odd")], "query_id bigint, title string")
    found, every = ([(r.entity_id, r.bm25) for r in retrieval.bm25(asked, df, ["title"], 5, most_common=m).orderBy("hit_rank").collect()] for m in (0.1, 1.0))
    assert found == every and len(found) == 5


def test_search_shuffles_no_pairs(spark, monkeypatch):
    """Where every query shares words with every record, what is shuffled follows both tables, not their product; many blocks find what one finds."""
    rng = random.Random(3)
    docs = [(i, " ".join(["deep", "drift", *rng.choices("abcdefghij", k=4)])) for i in range(3000)]
    df, asked = spark.createDataFrame(docs, "entity_id bigint, title string"), spark.createDataFrame(docs[:400], "query_id bigint, title string")
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = written()
    one = sorted(map(tuple, retrieval.bm25(asked, df, ["title"], 5, most_common=1.0).collect()))
    assert written() - before < 2_000_000 and len(one) == 2000
    monkeypatch.setattr(retrieval, "WORDS_AT_ONCE", 1000)
    monkeypatch.setattr(retrieval, "ASKED_AT_ONCE", 500)
    assert sorted(map(tuple, retrieval.bm25(asked, df, ["title"], 5).collect())) == one


def test_recommended_is_exact(spark):
    import random

    rng = random.Random(4)
    known = [("p", f"k{i}", "".join(rng.choice("abc ") for _ in range(rng.randint(5, 40))).strip() or "x") for i in range(60)]
    asked = []
    for i, (_, _, t) in enumerate(known):
        at = rng.randrange(len(t))
        asked.append(("p", f"q{i}", (t[:at] + rng.choice("abc") + t[at + rng.randint(0, 2):])))
    a, k = spark.createDataFrame(asked, "paper_id string, query_id string, text string"), spark.createDataFrame(known, "paper_id string, entry_id string, text string")
    got = {r.query_id: r.ratio for r in grading.recommended(a, k).collect()}
    want = {q: max(scoring.ratio(t, u) for _, _, u in known) for _, q, t in asked}
    assert got == {q: r for q, r in want.items() if r >= 90}
