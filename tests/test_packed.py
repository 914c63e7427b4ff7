"""Packed fields: tokenizer against plain splitting, citations by example, edge cases."""

from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.operators import packed

A = "A. Bee, On drifts, Open J. 3, 12 (1999)"
B = "C. D. Eff and G. Haa. Two titles; one note. Lett. 4, 2005"
C = "Ii, J.; Kay, L. Third work. Proc. 9 (2011) 44"


@settings(max_examples=200, deadline=None)
@given(st.text("ab ;|\n", max_size=30))
def test_without_quotes_it_is_a_plain_split(text):
    got = [text[a:b] for a, b, _ in packed.spans(text)]
    assert got == packed.regex.split("[;|\n•]", text)


@settings(max_examples=200, deadline=None)
@given(st.text('ab;"(){}\\ ', max_size=40))
def test_spans_cover_the_text(text):
    cuts = packed.spans(text)
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
    assert all(end + 1 == nxt == start for (_, end, nxt), (start, *_ ) in zip(cuts, cuts[1:], strict=False))


def test_citations():
    for sep in ("; ", " | ", "\n", " / ", " • ", ";;", "\r\n"):
        assert packed.citations(f"{A}{sep}{C}") == [A, C], sep
    assert packed.citations(f'"{A}", "{C}"') == [A, C]
    assert packed.citations(f'"{A} ""x; y"""; {C}') == [f'{A} "x; y"', C]
    assert packed.citations(f"(i) {A}, (ii) {C}") == [A, C]
    assert packed.citations(f"a) {A} b) {C} ") == [A, C]
    assert packed.citations(f"[1] {A}; [2] {C};") == [A, C]


def test_single_citations_stay_whole():
    for one in (
        B, C, "E. X, Parts (a) and (b): On it, Math. 2/5 (2012);", "G. L, Title here | Letters, vol. 194 | no. 3, 1969",
        "H. Q. Z, Low-rank solitons, https://x.example/a/b;v=164, 2024", 'M. N. S, "Random; a note", arXiv (1988)',
    ):
        assert packed.citations(one) == [one]


def test_rows(spark):
    rows = [(1, "k", f"{A}; {C}", 9), (2, "k", None, 9), (3, "k", "", 9), (4, "k", " ;; ", 9), (5, "k", A, 9), (1, "k", f"{A}; {C}", 9)]
    df = spark.createDataFrame(rows, "row_id int, key string, raw string, item int")
    got = sorted(tuple(r) for r in packed.explode_packed(df, ["row_id", "key"], "raw").collect())
    assert got == sorted(2 * [(1, "k", 0, A), (1, "k", 1, C)])
    assert packed.explode_packed(df.limit(0), ["row_id", "key"], "raw").count() == 0


def test_long_text_is_linear(spark):
    many = "; ".join([A] * 4000)
    assert len(packed.citations(many)) == 4000


def test_no_bounds(spark):
    many = " ".join(f"[{i}] {A}" for i in range(1, 1500))
    assert len(packed.citations(many)) == 1499
    far = "(" + "x; " * 400 + ")"
    assert [x for x in packed.citations(f"A. Bee, On {far}, 1999; {C}")] == [f"A. Bee, On {far}, 1999", C]
    assert packed.citations(f'"{A}",{" " * 90}"{C}"') == [A, C]
    assert packed.citations('"' * 100_000 + A)
    assert packed._roman(49) == "xlix"
