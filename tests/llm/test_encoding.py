"""Encoding: against the public tokenizer itself, round trips, edge cases."""

import pytest

from paperloom.llm import encoding

tokenizers = pytest.importorskip("tokenizers")
TEXTS = [
    "", None, " ", "\n\n  x", "It's 12,345.67 <|endoftext|> plain.", "naïve Größe — “quoted”…", "我们研究了等离子体。", "ดังนั้นฟลักซ์ 34.59", "🙂🙂 ok", "a" * 3000, "x\u00a0y\u3000z\u200b", "tab\t\tnew\r\nline   ",
    "don't we'll I'm they've", "e\u0301 ﬁ ½ ² Ⅷ", "word " * 400,
]


@pytest.fixture(scope="module")
def encoded(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([*rows, rows[4], rows[4]], "doc_id bigint, text string, word string")
    return df, encoding.encode(df).cache()


def test_ids(encoded):
    own = tokenizers.Tokenizer.from_file(f"{encoding.VOCABULARIES}/byte_bpe_50k.json")
    own.encode_special_tokens = True
    got = {r.doc_id: list(r.ids) for r in encoded[1].collect()}
    assert got == {i: own.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(TEXTS)}
    assert encoded[1].count() == len(TEXTS)


def test_round_trip(encoded):
    assert {r.doc_id: r.text for r in encoding.decode(encoded[1]).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_rare_words_take_the_other_way(spark, monkeypatch, encoded):
    monkeypatch.setattr(encoding, "HEAD_WORDS", 3)
    again = {r.doc_id: list(r.ids) for r in encoding.encode(encoded[0]).collect()}
    assert again == {r.doc_id: list(r.ids) for r in encoded[1].collect()}


def test_counts(encoded):
    n = {r.doc_id: r.n_tokens for r in encoding.token_counts(encoded[0].dropDuplicates(["doc_id"])).collect()}
    assert n == {r.doc_id: len(r.ids) for r in encoded[1].collect() if len(r.ids)}


def test_empty(spark):
    assert encoding.encode(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
