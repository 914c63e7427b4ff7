"""Grading of retrieval: levels from the scores of candidates, cross-checks with known entries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.scoring import ratio_udf

UPPER, LOWER = 0.95, 0.5


def grade(candidates: DataFrame, keys: list[str], upper: float = UPPER, lower: float = LOWER, literal: bool = False) -> DataFrame:
    """The level and best candidate of each citation.

    ``candidates`` has score, engine, rank (order of arrival), title, ids (map) and is_note. Levels:
    -1 note, 0 nothing found or best below ``lower``, 5 score of one, 4 above ``upper``, 2 a single
    engine, 3 the two best engines agree by title or an id, 1 otherwise. Titles agree from a ratio
    of 96 of 100 on; ``literal`` takes any ratio from 1 on. A citation whose score is null counts
    as not found; ties go to the candidate that came first.

    Per engine and per citation only maxima are kept, so hot citations aggregate map-side.
    """
    order = F.struct(F.coalesce("score", F.lit(-1.0)).alias("score"), (-F.col("rank")).alias("first"))
    best = candidates.groupBy(*keys, "engine").agg(
        F.max_by(F.struct("engine", "score", "title", "ids", "rank"), order).alias("b"),
        F.max(order).alias("o"), F.bool_or("is_note").alias("note"),
    )
    two = best.groupBy(*keys).agg(
        F.array_sort(
            F.collect_list(F.struct("o", "b")),
            lambda x, y: F.when(x["o"] > y["o"], -1).when(x["o"] < y["o"], 1).otherwise(0),
        ).alias("engines"),
        F.bool_or("note").alias("note"),
    )
    one = F.get("engines", F.lit(0))["b"]
    other = F.get("engines", F.lit(1))["b"]
    sure = two.select(*keys, "note", F.size("engines").alias("n"), one.alias("one"), other.alias("other"))
    agree_title = ratio_udf(F.col("one.title"), F.col("other.title")) >= (1 if literal else 96)
    shared = F.coalesce(F.arrays_overlap(F.map_entries("one.ids"), F.map_entries("other.ids")), F.lit(False))
    level = (
        F.when(F.coalesce("note", F.lit(False)), -1)
        .when(F.col("one.score").isNull(), 0)
        .when(F.col("one.score") == 1, 5)
        .when(F.col("one.score") > upper, 4)
        .when(F.col("one.score") < lower, 0)
        .when(F.col("n") == 1, 2)
        .when(agree_title | shared, 3)
        .otherwise(1)
    )
    return sure.select(*keys, level.cast("int").alias("retrieved_level"), F.col("one").alias("candidate"))


def recommended(queries: DataFrame, known: DataFrame, paper: str = "paper_id", least: int = 90) -> DataFrame:
    """For each citation text the most similar known entry of its paper, from ``least`` on (T5).

    Exact. A text that holds several citations (a ``;``) gets none. Texts of a ratio of r have lengths
    within (2 - r) / r of each other, so they meet in neighbouring classes of length within their
    paper; and at most (1 - r) of the signs of both are edits, which the Levenshtein bound tests first.
    """
    share = (least - 0.5) / 100
    step = math.log((2 - share) / share)

    def length_class(c: str) -> Column:
        return F.floor(F.log(F.length(c).cast("double")) / step).cast("int")

    some = queries.where(~F.contains("text", F.lit(";")) & (F.length("text") > 0))
    q = some.select("*", F.explode(F.sequence(length_class("text") - 1, length_class("text") + 1)).alias("block"))
    k = known.withColumnsRenamed({"text": "known_text", "entry_id": "known_id"}).where("length(known_text) > 0")
    reach = F.floor((F.length("text") + F.length("known_text")) * (1 - share)).cast("int")
    pairs = q.join(k.withColumn("block", length_class("known_text")), [paper, "block"]).withColumn("reach", reach)
    near = pairs.where(F.expr("levenshtein(text, known_text, reach) >= 0"))
    scored = near.withColumn("ratio", ratio_udf("text", "known_text")).where(F.col("ratio") >= least)
    return scored.groupBy(paper, "query_id").agg(
        F.max(F.struct("ratio", (-F.xxhash64("known_id")).alias("_t"), "known_id", "known_text")).alias("b")
    ).select(paper, "query_id", "b.ratio", "b.known_id", "b.known_text")


def coverage(flags: DataFrame, key: str, hit: str) -> DataFrame:
    """Full, Part or None by how many of a paper's citations have a hit."""
    counts = flags.groupBy(key).agg(F.count_if(hit).alias("hits"), F.count("*").alias("all"))
    return counts.withColumn("coverage", F.when(F.col("hits") == F.col("all"), "Full").when(F.col("hits") > 0, "Part").otherwise("None"))


def double_check(retrieved: DataFrame, recommended_ids: DataFrame, keys: list[str]) -> DataFrame:
    """Whether the retrieved and recommended records of a citation share an id (T4).

    Both have the keys and a map ``ids``. A citation without recommendation is unchecked.
    """
    def pairs(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.explode("ids").alias("kind", "value")).distinct().withColumn(name, F.lit(True))

    hit = pairs(retrieved, "_a").join(pairs(recommended_ids, "_b"), [*keys, "kind", "value"]).select(*keys).distinct()
    has = recommended_ids.select(*keys).distinct().withColumn("_has", F.lit(True))
    out = retrieved.select(*keys).distinct().join(has, keys, "left").join(hit.withColumn("_hit", F.lit(True)), keys, "left")
    verdict = F.when(F.col("_hit"), "same").when(F.col("_has"), "different").otherwise("unchecked")
    return out.select(*keys, verdict.alias("check"))
