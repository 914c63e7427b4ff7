"""Encoding of a corpus with a public tokenizer through a table of its distinct words.

Texts are split into words in the JVM, each distinct word is encoded once, and the ids are
joined back by position. The most frequent words, a table of proven size, are looked up within
the row of their document, which so needs no shuffle; the other words alone are joined by a
shuffle on the word, and their ids then put into the gaps of their documents.

Defined results
---------------
* A null and an empty text have an empty list of ids, a blank text the ids of its blanks.
* Text that looks like a special token is plain text.
* One row per doc_id; of rows that share one, that of the greatest text counts. Extra columns are ignored.
* An empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.session import persist_table

#: Folder of the vocabulary files; a parameter of every function that reads them.
VOCABULARIES = "/opt/tokenizers"
#: The published split of byte-level BPE, with Unicode classes in Java's notation (fixed value).
WORDS = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Frequent words and signs of each: a table of at most 100,000 x 48 x 4 bytes of text, whatever the corpus.
HEAD_WORDS, HEAD_SIGNS = 100_000, 48


@cache
def ranks(name: str, folder: str) -> dict[bytes, int]:
    """Ids by piece of a rank file."""
    lines = Path(folder, f"{name}.tiktoken").read_bytes().splitlines()
    return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, filter(None, lines))}


@cache
def encoder(name: str, folder: str):  # noqa: ANN201
    """An encoder of single words; the split happens in Spark."""
    import tiktoken

    return tiktoken.Encoding(name, pat_str=r"(?s:.+)", mergeable_ranks=ranks(name, folder), special_tokens={})


def words_of(text: str | Column) -> Column:
    """The words of a text, in order; they make up the whole text."""
    return F.regexp_extract_all(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORDS), 0)


def word_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of each text: doc_id, pos, word."""
    return docs.where(F.length(text_col) > 0).select(
        F.col(id_col).alias("doc_id"), F.posexplode(words_of(text_col)).alias("pos", "word")
    )


def vocabulary(words: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """Each distinct word once, with its ids and the number of its occurrences: word, n, ids."""

    def encode(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(tokenizer, folder)
        for pdf in batches:
            yield pdf.assign(ids=[own.encode_ordinary(w) for w in pdf["word"]])

    return words.groupBy("word").agg(F.count("*").alias("n")).mapInPandas(encode, "word string, n bigint, ids array<int>")


def frequent(vocab: DataFrame) -> tuple[pa.Array, pa.Array]:
    """The most frequent words and their ids, of the size that :data:`HEAD_WORDS` and :data:`HEAD_SIGNS` prove; last [-1] for all others."""
    head = vocab.where(F.length("word") <= HEAD_SIGNS).orderBy(F.desc("n"), "word").limit(HEAD_WORDS).select("word", "ids").toPandas()
    return pa.array(head["word"], pa.string()), pa.array([*map(list, head["ids"]), [-1]], pa.list_(pa.int32()))


#: A document whose frequent words are looked up: ids with a -1 for each word that is not among them, those words and their places.
PARTLY = "doc_id bigint, ids array<int>, gaps array<int>, rare array<string>"


def _lists(starts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values)


def looked_up(docs: DataFrame, head: tuple[pa.Array, pa.Array], id_col: str, text_col: str) -> DataFrame:
    """Every document with the ids of its frequent words in place and its other words listed."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = shared.value
        for b in batches:
            words = b.column("words")
            first = words.offsets.to_numpy() - words.offsets[0].as_py()  # of each document, among the words
            flat = words.flatten()
            at = pc.index_in(flat, value_set=known).fill_null(len(known))
            ids = own.take(at)
            start = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())])  # of each word, among the ids
            lost = at.to_numpy() == len(known)
            doc = np.repeat(np.arange(len(words)), np.diff(first))
            gaps = (start[:-1] - start[first[doc]])[lost]
            begins = np.concatenate([[0], np.cumsum(lost)])[first]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), _lists(start[first], ids.flatten()), _lists(begins, pa.array(gaps, pa.int32())), _lists(begins, flat.filter(pa.array(lost)))],
                names=["doc_id", "ids", "gaps", "rare"],
            )

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), words_of(text_col).alias("words")).mapInArrow(run, PARTLY)


def _one_row_each(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents, the greatest text of each id where an id comes more than once."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows, ids = docs.agg(F.count("*"), F.count_distinct(key)).first()
    return docs if rows == ids else docs.groupBy(id_col).agg(F.max(text_col).alias(text_col))


def _vocabulary_of(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, folder: str) -> DataFrame:
    return persist_table(vocabulary(word_rows(docs, id_col, text_col), tokenizer, folder), "words")


def _rare_ids(partly: DataFrame, vocab: DataFrame) -> DataFrame:
    """The ids of the words that are not frequent: doc_id, at, ids. Hot documents and words are never collected."""
    rare = partly.where(F.size("rare") > 0).select("doc_id", F.explode(F.arrays_zip(F.col("gaps").alias("at"), F.col("rare").alias("word"))).alias("r"))
    return rare.select("doc_id", "r.at", "r.word").join(vocab.select("word", "ids").hint("shuffle_merge"), "word").select("doc_id", "at", "ids")


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str = "byte_bpe_50k", folder: str = VOCABULARIES,
) -> DataFrame:
    """The ids of every text: doc_id, ids."""
    docs = _one_row_each(docs, id_col, text_col)
    vocab = _vocabulary_of(docs, id_col, text_col, tokenizer, folder)
    partly = persist_table(looked_up(docs, frequent(vocab), id_col, text_col), "partly")
    filling = _rare_ids(partly, vocab).groupBy("doc_id").agg(F.collect_list(F.struct("at", "ids")).alias("fill"))
    open_ = partly.where(F.size("gaps") > 0).select("doc_id", "ids").join(filling, "doc_id")

    def filled(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for ids, fill in zip(pdf["ids"], pdf["fill"], strict=True):
                own, at, whole = np.asarray(ids), 0, []
                for f in sorted(fill, key=lambda x: x["at"]):
                    whole += [own[at : f["at"]], f["ids"]]
                    at = f["at"] + 1
                out.append(np.concatenate([*whole, own[at:]]).astype(np.int32))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": out})

    done = partly.where(F.size("gaps") == 0).select("doc_id", "ids")
    return done.unionByName(open_.mapInPandas(filled, "doc_id bigint, ids array<int>"))


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str = "byte_bpe_50k", folder: str = VOCABULARIES,
) -> DataFrame:
    """The number of tokens of every text that has any: doc_id, n_tokens."""
    docs = _one_row_each(docs.where(F.length(text_col) > 0), id_col, text_col)
    vocab = _vocabulary_of(docs, id_col, text_col, tokenizer, folder)
    partly = looked_up(docs, frequent(vocab), id_col, text_col)
    partly = persist_table(partly.select("doc_id", (F.size("ids") - F.size("gaps")).alias("known"), "gaps", "rare"), "partly")
    rare = _rare_ids(partly, vocab).groupBy("doc_id").agg(F.sum(F.size("ids")).alias("n"))
    every = partly.where(F.size("gaps") == 0).select("doc_id", F.col("known").cast("bigint").alias("n"))
    open_ = partly.where(F.size("gaps") > 0).select("doc_id", "known").join(rare, "doc_id").select("doc_id", F.col("known") + F.col("n"))
    return every.unionByName(open_.toDF("doc_id", "n")).withColumnRenamed("n", "n_tokens")


def pieces(spark: SparkSession, tokenizer: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """The id-to-piece table, as large as the tokenizer's vocabulary: id, piece (hexadecimal)."""
    rows = [(i, p.hex()) for p, i in ranks(tokenizer, folder).items()]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["id", "piece"]), "id int, piece string")


def decode(encoded: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """Texts from ids, by a join with the piece table: doc_id, text. An unknown id has no piece."""
    table = F.broadcast(pieces(encoded.sparkSession, tokenizer, folder))
    rows = encoded.select("doc_id", F.posexplode_outer("ids").alias("pos", "id"))
    placed = F.sort_array(F.collect_list(F.struct("pos", F.coalesce("piece", F.lit("")).alias("piece"))))
    return rows.join(table, "id", "left").groupBy("doc_id").agg(
        F.unhex(F.array_join(placed["piece"], "")).cast("string").alias("text")
    )
