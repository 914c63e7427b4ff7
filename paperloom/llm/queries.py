"""Queries of this package, with production parameters over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import encoding, markup, matching, mixing, names, sentences, suffixes, survivor
from paperloom.session import persist_table, table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of spellings of one person or collaboration."""
    return names.linked_pairs(table(spark, sf, "graded"))


def p1_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Every spelling with its entity, its rows and the spelling that represents the entity."""
    return names.entities(table(spark, sf, "graded"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Kinds of markup per paragraph."""
    return markup.residue(table(spark, sf, "sections"))


def p2_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Clean paragraphs."""
    return markup.cleaned(table(spark, sf, "sections"))


def p2_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Passages that an earlier section of the same paper has."""
    return suffixes.runs(table(spark, sf, "sections"))


def p2_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Clean paragraphs without those passages."""
    own = suffixes.unique(table(spark, sf, "sections"))
    return own.select("host", F.col("page").alias("section_id"), F.col("para").alias("para_pos"), markup.clean(F.col("text")).alias("clean"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """The best row of each group of two or more."""
    return survivor.fuse(table(spark, sf, "graded")).where("n_rows >= 2").select("graded_id")


def p3_fused(spark: SparkSession, sf: str) -> DataFrame:
    """One record per group, each field at its best-supported value."""
    return survivor.fuse(table(spark, sf, "graded"))


def p3_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy of engines and chances of copying."""
    return survivor.source_model(table(spark, sf, "graded"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of rows of both catalogues that describe one work."""
    return p5_matches(spark, sf).select("graded_id", "corpus_id")


def p5_matches(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the confidence of each."""
    return matching.matches(table(spark, sf, "graded"), table(spark, sf, "s2_rows"))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document."""
    return encoding.encode(table(spark, sf, "documents"))


def p8_decoded(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each text comes back from its ids."""
    docs = table(spark, sf, "documents")
    back = encoding.decode(encoding.encode(docs)).withColumnRenamed("text", "back")
    same = F.col("back").eqNullSafe(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", "text").join(back, "doc_id", "left").select("doc_id", same.alias("same"))


def p9_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the mixture with their number of copies."""
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual share of each source."""
    targets = table(spark, sf, "mix_targets")
    return mixing.shares(mixing.mix(table(spark, sf, "documents"), targets), targets)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """The end of every sentence unit."""
    return sentences.boundaries(table(spark, sf, "documents"))


def p10_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Every sentence unit with its text."""
    return sentences.sentences(table(spark, sf, "documents"))


def p9_kept(spark: SparkSession, sf: str) -> DataFrame:
    """For each target its share, and whether the mixture keeps to it: within one document, no document more often than allowed."""
    docs, targets = table(spark, sf, "documents"), table(spark, sf, "mix_targets")
    mixture = persist_table(mixing.mix(docs, targets), "mixture")
    made = mixing.shares(mixture, targets)
    live = made.where("tokens > 0").agg(F.sum("target_share").alias("live"), F.sum("tokens").alias("total"))
    most = mixture.groupBy("source").agg(F.max("n_tokens").alias("longest"))
    allowed = targets.where("source is not null").groupBy("source").agg(F.max(F.coalesce("max_repeats", F.lit(0))).alias("allowed"))
    each = made.join(most, "source", "left").join(allowed, "source").crossJoin(F.broadcast(live))  # a row per target, one row of totals
    off = F.abs(F.col("tokens") - F.col("target_share") / F.col("live") * F.col("total"))
    kept = (F.col("tokens") == 0) | ((off <= 2 * F.col("longest") + 0.001 * F.col("total")) & (F.col("most_copies") <= F.col("allowed")))
    return each.select("source", F.round("target_share", 9).alias("target_share"), kept.alias("kept"))


def p10_rejoined(spark: SparkSession, sf: str) -> DataFrame:
    """The signs of every document's units, in order, without blanks."""
    rows = sentences.sentences(table(spark, sf, "documents"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sentence"))), lambda x: x["sentence"]), "")
    return rows.groupBy("doc_id").agg(F.regexp_replace(joined, r"(?U)[\s\x1c-\x1f]+", "").alias("signs"))


def queries() -> dict[str, Query]:
    found = (p1_found, p1_entities, p2_found, p2_clean, p2_runs, p2_unique, p3_found, p3_fused, p3_sources, p5_found, p5_matches, p8_ids, p8_decoded,
             p9_mixture, p9_shares, p9_kept, p10_found, p10_sentences, p10_rejoined)
    return {f.__name__: f for f in found}


_P3 = """
WITH k AS (
  SELECT graded_id, pos, retrieved_at, retrieved_level, candidate AS c,
    nullif(regexp_replace(regexp_replace(replace(lower(trim(paper_id)), '_', '/'),
      '^(?:https?://)?(?:www\\.)?(?:arxiv\\.org/(?:abs|pdf)/)?(?:arxiv\\s*:\\s*)?', ''), '(?:v\\d+)?(?:\\.pdf)?\\s*$', ''), '') AS paper
  FROM graded),
r AS (
  SELECT graded_id, count(*) OVER w0 AS n, row_number() OVER (PARTITION BY paper, pos ORDER BY
    coalesce(retrieved_level, -2147483648) DESC,
    CASE WHEN NOT isnan(c.score) AND c.score BETWEEN 0 AND 1 THEN c.score ELSE -1 END DESC,
    (c.doi IS NOT NULL)::int + (c.arxiv IS NOT NULL)::int + (c.dblp IS NOT NULL)::int + (c.mag IS NOT NULL)::int
      + (c.pubmed IS NOT NULL)::int + (c.title IS NOT NULL)::int + (c.journal IS NOT NULL)::int
      + (c.journal_volume IS NOT NULL)::int + (c.journal_page IS NOT NULL)::int + (c.year IS NOT NULL)::int
      + (c.publisher IS NOT NULL)::int DESC,
    CASE lower(trim(c.from_structure)) WHEN 'anystyle' THEN 2 WHEN 'grobid' THEN 1 ELSE 0 END DESC,
    retrieved_at DESC NULLS LAST, graded_id) AS rn
  FROM k WHERE paper IS NOT NULL AND pos IS NOT NULL WINDOW w0 AS (PARTITION BY paper, pos))
SELECT graded_id FROM r WHERE rn = 1 AND n >= 2
"""


_P2_RUNS = """
WITH d AS (SELECT DISTINCT coalesce(paper_id, 'page ' || section_id) AS host, section_id AS page, section_content AS c FROM sections),
w AS (SELECT host, page, para, place, word, row_number() OVER (PARTITION BY host, page, c ORDER BY para, place) AS pos, c FROM (
  SELECT host, page, c, para, unnest(range(len(l))) AS place, unnest(l) AS word FROM (
    SELECT host, page, c, para, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS l FROM (
      SELECT host, page, c, unnest(range(len(c)))::int AS para, unnest(c) AS text FROM d)))),
s AS (SELECT *, list(word) OVER (PARTITION BY host, page, c ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS k FROM w),
b AS (SELECT host, k, min(page) AS owner FROM s WHERE len(k) = 8 GROUP BY 1, 2 HAVING min(page) < max(page)),
h AS (SELECT s.host, s.page, s.c, s.pos FROM s JOIN b ON b.host = s.host AND b.k = s.k WHERE s.page > b.owner),
v AS (SELECT DISTINCT w.host, w.page, w.para, w.place FROM h JOIN w ON w.host = h.host AND w.page = h.page AND w.c IS NOT DISTINCT FROM h.c AND w.pos BETWEEN h.pos AND h.pos + 7),
i AS (SELECT *, place - row_number() OVER (PARTITION BY host, page, para ORDER BY place) AS island FROM v)
SELECT host, page, para, min(place)::int AS first, max(place)::int AS last FROM i GROUP BY host, page, para, island"""


def oracle_sql() -> dict[str, str]:
    blanks = "[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x0B\\x1c-\\x1f]+"
    return {
        "p2_runs": _P2_RUNS,
        "p9_kept": """
WITH t AS (SELECT source, sum(coalesce(weight, 0)) AS w, max(coalesce(max_repeats, 0)) AS r FROM mix_targets WHERE source IS NOT NULL GROUP BY 1)
SELECT source, round(w / (SELECT sum(w) FROM t), 9) AS target_share, true AS kept FROM t""",
        "p10_rejoined": f"SELECT doc_id, regexp_replace(text, '{blanks}', '', 'g') AS signs FROM documents WHERE regexp_replace(text, '{blanks}', '', 'g') <> ''",
        "p3_found": _P3,
        "p8_decoded": "SELECT doc_id, true AS same FROM documents",
    }
