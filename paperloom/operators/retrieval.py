"""Retrieval of candidates for citations: words of records by field, exact BM25 in blocks, staged top-k, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.scoring import similarity_udf
from paperloom.functions.text import arxiv_id, is_note
from paperloom.session import cpu_slots, persist_table

#: Usual parameters of BM25.
K1, B = 1.2, 0.75
#: Fields of each engine (fixed values).
ENGINES = {
    "integrate": ("author", "journal_volume", "journal_page", "title", "journal", "year"),
    "v21": ("author", "journal_volume", "journal_page", "title", "journal", "year"),
    "sentence": ("content",),
}


def tokens(c: Column) -> Column:
    """Words of a text: lower case letters and digits."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"(?U)[\p{L}\p{N}]+"), F.lit(0))


def postings(docs: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """The texts of each record by field: key, field (its place), len, words, n (rows that were alike). Arrays are read as one text; null fields have none.

    Rows of one key whose fields are equally long are one text.
    """
    parts = []
    kinds = dict(docs.dtypes)
    for i, f in enumerate(fields):
        text = F.array_join(f, " ") if kinds[f].startswith("array") else F.col(f).cast("string")
        parts.append(docs.select(key, F.lit(i).alias("field"), tokens(text).alias("words")).where(F.size("words") > 0))
    rows = reduce(DataFrame.unionByName, parts).withColumn("len", F.size("words"))
    return rows.groupBy(key, "field", "len").agg(F.flatten(F.collect_list("words")).alias("words"), F.count("*").alias("n"))


#: Words of records, and of queries, that one task holds at once, about; tokens at most that are held as a column over all records.
WORDS_AT_ONCE, ASKED_AT_ONCE, COLUMNS = 2_000_000, 1_000_000, 64
#: Records whose best score is taken at once in the search for the k best (fixed value).
_RUN = 64


def _flat(column: pa.ChunkedArray) -> pa.Array:
    """A column in one piece."""
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _k_best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and rounded scores of the k best of those above 0, earlier places first among equals; the length is a multiple of :data:`_RUN`."""
    tops = scores.reshape(-1, _RUN).max(axis=1)
    low = np.partition(tops, -k)[-k] if len(tops) > k else 0.0  # k scores at least are as good
    at = np.flatnonzero(scores >= low - 1e-6) if low > 1e-6 else np.flatnonzero(scores > 0)
    rounded = np.round(scores[at], 6)
    order = np.lexsort((at, -rounded))[:k]
    return at[order], rounded[order]


def _search(docs: pa.Table, asked: pa.Table, n_fields: int, k: int, most_common: float) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """The k best of some records for each of some queries: queries, records and rounded scores.

    ``docs`` has id, field, norm and words, ``asked`` id, field, token and idf. A record's parts are added
    in the order of tokens, so those of the same words have the same score.
    """
    asked = asked.sort_by([("id", "ascending"), ("field", "ascending"), ("token", "ascending")])
    token = _flat(asked["token"])
    known = token.unique()
    term, first, of = np.unique(pc.index_in(token, known).to_numpy().astype(np.int64) * n_fields + _flat(asked["field"]).to_numpy(), return_index=True, return_inverse=True)
    idf = _flat(asked["idf"]).to_numpy()[first]

    ids = _flat(docs["id"])
    own = ids.unique()
    own = own.take(pc.sort_indices(own))
    place, field, norm, words = pc.index_in(ids, own).to_numpy().astype(np.int64), _flat(docs["field"]).to_numpy(), _flat(docs["norm"]).to_numpy(), _flat(docs["words"])
    at = pc.index_in(words.flatten(), known)
    row = np.repeat(np.arange(len(ids)), pc.list_value_length(words).to_numpy())[pc.is_valid(at).to_numpy(zero_copy_only=False)]
    code = at.drop_null().to_numpy().astype(np.int64) * n_fields + field[row]
    t = np.minimum(np.searchsorted(term, code), len(term) - 1)
    held = term[t] == code
    each, tf = np.unique(t[held] * len(ids) + row[held], return_counts=True)
    t, row = np.divmod(each, len(ids))
    part = idf[t] * tf * (K1 + 1) / (tf + norm[row])
    size = -(-len(own) // _RUN) * _RUN
    each, back = np.unique(t * size + place[row], return_inverse=True)  # rows of one record meet
    part = np.bincount(back, part, len(each))
    t, doc = np.divmod(each, size)
    starts = np.searchsorted(t, np.arange(len(term) + 1))
    found, columns = np.diff(starts), {}
    for i in np.argsort(-found)[:COLUMNS]:
        if found[i] > most_common * len(own):
            columns[i] = np.bincount(doc[starts[i] : starts[i + 1]], part[starts[i] : starts[i + 1]], size)

    query = _flat(asked["id"])
    begins = np.append(np.flatnonzero(np.append(True, pc.not_equal(query[1:], query[:-1]).to_numpy(zero_copy_only=False))), len(query))
    scores, hits = np.empty(size), []
    for b, e in zip(begins, begins[1:], strict=False):
        scores.fill(0)
        for i in of[b:e]:
            if i in columns:
                scores += columns[i]
            else:
                scores[doc[starts[i] : starts[i + 1]]] += part[starts[i] : starts[i + 1]]
        hits.append(_k_best(scores, k))
    n = [len(x) for x, _ in hits]
    return query.take(pa.array(np.repeat(begins[:-1], n))), own.take(pa.array(np.concatenate([x for x, _ in hits]))), np.concatenate([x for _, x in hits])


def bm25(queries: DataFrame, docs: DataFrame, fields: Sequence[str], k: int, qid: str = "query_id", did: str = "entity_id",
         most_common: float = 0.1) -> DataFrame:
    """The k best documents of each query by the sum over fields of BM25: query_id, entity_id, bm25, hit_rank.

    Exact. Blocks of documents meet parts of the queries; all scores of a query in a block are added in
    memory and its k best leave it, so no pair of a query and a document is ever shuffled. Tokens in
    more than ``most_common`` of a block are held as a column over its documents, which changes no
    score. Scores are rounded to six places; ties go to the smaller id.
    """
    spark = docs.sparkSession
    index = persist_table(postings(docs, did, fields), "postings")
    asked = postings(queries.where(F.col(qid).isNotNull()), qid, fields).select(qid, "field", F.explode("words").alias("token")).distinct()
    n_docs = docs.count()
    field_len = index.groupBy("field").agg((F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("avg_len"))
    df = index.select("field", F.explode(F.array_distinct("words")).alias("token")).groupBy("field", "token").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    used = persist_table(asked.join(df, ["field", "token"]).select(F.col(qid).alias("id"), "field", "token", idf.alias("idf")), "used")
    parts = max(1, -(-used.count() // ASKED_AT_ONCE))
    blocks = max(-(-(index.agg(F.sum(F.col("len") * F.col("n"))).first()[0] or 0) // WORDS_AT_ONCE), -(-2 * cpu_slots(spark) // parts))

    def spread(rows: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        """Rows by the hash of their id, once for each of the other side's."""
        once = rows.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
        return once.repartition(blocks * parts, "block", "part")

    norm = K1 * (1 - B + B * F.col("len") / F.col("avg_len"))
    texts = index.where(F.col(did).isNotNull()).join(F.broadcast(field_len), "field").select(F.col(did).alias("id"), "field", norm.alias("norm"), "words")
    kinds = dict(index.dtypes)[did], dict(used.dtypes)["id"]
    n_fields = len(fields)

    def meet(block: pa.Table, part: pa.Table) -> pa.Table:
        if not len(block) or not len(part):
            return pa.table({qid: part["id"].slice(0, 0), did: block["id"].slice(0, 0), "bm25": pa.array([], pa.float64())})
        return pa.table(dict(zip((qid, did, "bm25"), _search(block, part, n_fields, k, most_common), strict=True)))

    met = spread(texts, "block", blocks, "part", parts).groupBy("block", "part").cogroup(spread(used, "part", parts, "block", blocks).groupBy("block", "part"))
    scored = met.applyInArrow(meet, f"`{qid}` {kinds[1]}, `{did}` {kinds[0]}, bm25 double")
    rank = F.row_number().over(Window.partitionBy(qid).orderBy(F.desc("bm25"), did))
    return scored.withColumn("hit_rank", rank).where(F.col("hit_rank") <= k)


#: Names that a field has in the index of an engine (fixed values).
NAMES = {"v21": {"journal_volume": "jvol", "journal_page": "jpage", "journal": "jname"}}


def clauses(record: Column, engine: str = "integrate", authors: int = 3) -> Column:
    """The clauses that a search for a record joins by OR: array of fields and text.

    One for each of the first authors, over all author fields, and one for each other field that is there.
    """
    if engine == "sentence":
        return F.array(F.struct(F.array(F.lit("content"), F.lit("short_content")).alias("fields"), record["content"].alias("text")))
    if engine not in ENGINES:
        raise ValueError(f"unknown engine {engine}")
    names = NAMES.get(engine, {})
    places = F.array(*(F.lit(f"author.{i}") for i in range(authors)))
    people = F.transform(F.slice(F.coalesce(record["author"], F.array().cast("array<string>")), 1, authors), lambda a: F.struct(places.alias("fields"), a.alias("text")))
    others = [F.struct(F.array(F.lit(names.get(f, f))).alias("fields"), record[f].cast("string").alias("text")) for f in ("journal_volume", "journal_page", "title", "journal", "year")]
    return F.filter(F.concat(people, F.array(*others)), lambda c: F.coalesce(F.trim(c["text"]), F.lit("")) != "")


def retrieve(queries: DataFrame, docs: DataFrame, engine: str, k: int) -> DataFrame:
    """The k best records of an engine's fields for each query; an unknown engine is an error."""
    if engine not in ENGINES:
        raise ValueError(f"unknown engine {engine}")
    names = {v: f for f, v in NAMES.get(engine, {}).items()}
    return bm25(queries, docs.withColumnsRenamed(names), ENGINES[engine], k)


#: What stands in the place of the results of a note (fixed value).
NOTE = "the_is_a_note"


def without_notes(citations: DataFrame, text: str = "content") -> tuple[DataFrame, DataFrame]:
    """Citations to be searched, and notes with their result in place of one."""
    note = F.coalesce(is_note(F.col(text)), F.lit(False))
    return citations.where(~note), citations.where(note).withColumn("found_id", F.lit(NOTE))


def paper_status(papers: DataFrame) -> DataFrame:
    """What becomes of the references of each paper (S15). ``papers`` has paper_id, has_text, n_text, has_structured, is_done."""
    status = (
        F.when(~F.col("has_text"), "no_ref_text").when(F.col("n_text") == 0, "empty_ref_text").when(~F.col("has_structured"), "no_ref_structured")
        .when(F.col("is_done"), "already_done").otherwise("pass")
    )
    return papers.select("paper_id", status.alias("status"))


def index_record(record: DataFrame, aliases: DataFrame, most: int = 3) -> DataFrame:
    """Records as an index has them: authors numbered, a known venue with all its names (Q2).

    ``aliases`` has venue (lower case) and names (array); other columns pass through.
    """
    rest = [c for c in record.columns if c not in ("author", "journal")]
    people = [F.get("author", F.lit(i)).alias(f"author_{i}") for i in range(most)]
    joined = record.withColumn("_venue", F.lower("journal")).join(aliases.withColumnRenamed("venue", "_venue"), "_venue", "left")
    return joined.select(*rest, *people, F.coalesce(F.array_join("names", ", "), F.col("_venue")).alias("journal"))


def resolved_by_id(queries: DataFrame, text: str = "content", given: str | None = None) -> DataFrame:
    """Queries that name their record, by a given id or an arXiv id in the text, with score one."""
    own = arxiv_id(F.col(text))
    found = F.coalesce(F.col(given), own) if given else own
    return queries.withColumn("found_id", found).where("found_id is not null").withColumn("score", F.lit(1.0))


def staged(queries: DataFrame, docs: DataFrame, fields: Sequence[str], record: Column, doc_record: Column, parsers: Sequence[str],
           accept: float = 0.95, retry: float = 0.5, keep: int = 3, wide: int = 5, given: str | None = None) -> DataFrame:
    """Candidates of each citation from its parsers' records.

    ``queries`` has cite_id, parser and the fields, a row per citation and parser. With ``given``, the
    column of an id, records that name theirs (there or in content) get it as found_id without a search. First the best hit per parser, in the order of
    parsers, up to the first above ``accept``. Citations whose best is at most ``retry`` then get
    ``wide`` hits per parser, re-scored, of which ``keep`` stay. Order: score, parser, hit.
    """
    place = F.array_position(F.array(*map(F.lit, parsers)), F.col("parser"))
    asked = queries.withColumn("query_id", F.concat_ws("/", "cite_id", "parser")).withColumn("place", place).withColumn("q", record)
    if given:
        named = resolved_by_id(asked, given=given).select("cite_id", "parser", "place", "found_id", "score", "query_id")
        asked = asked.join(named.select("query_id"), "query_id", "left_anti")
    asked = persist_table(asked, "asked")
    hits = bm25(asked, docs, fields, wide)
    full = hits.join(asked.select("query_id", "cite_id", "parser", "place", "q"), "query_id").join(
        docs.withColumn("d", doc_record).select("entity_id", "d"), "entity_id"
    )
    scored = full.select("cite_id", "parser", "place", "entity_id", "hit_rank", similarity_udf("d", "q").alias("score"))
    if given:
        by_id = named.drop("query_id").withColumns({"entity_id": F.lit(None).cast(docs.schema["entity_id"].dataType), "hit_rank": F.lit(1)})
        scored = scored.unionByName(by_id, allowMissingColumns=True)
    scored = persist_table(scored, "scored")
    top = scored.where("hit_rank = 1")
    stop = top.where(F.col("score") > accept).groupBy("cite_id").agg(F.min("place").alias("stop"))
    first = top.join(stop, "cite_id", "left").where("stop is null or place <= stop").drop("stop")
    low = first.groupBy("cite_id").agg(F.max("score").alias("best")).where(F.col("best") <= retry).select("cite_id")
    again = scored.join(low, "cite_id").withColumn(
        "n", F.row_number().over(Window.partitionBy("cite_id", "place").orderBy(F.desc("score"), "hit_rank"))
    ).where(F.col("n") <= keep).drop("n")
    both = first.join(low, "cite_id", "left_anti").unionByName(again)
    order = Window.partitionBy("cite_id").orderBy(F.desc("score"), "place", "hit_rank")
    return both.withColumn("rank", F.row_number().over(order))
