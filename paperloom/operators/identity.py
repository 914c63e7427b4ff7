"""Identity resolution over identifiers, and the index of records that it feeds.

An alias is (type, value). Rows whose identifiers name one entity add theirs to it, rows that
name none found a new one, rows that name several are conflicts and change nothing. Sources are
taken in the order of their rank, and within a source rows that share identifiers are first
brought together, so the result depends on rank and row id only, not on how tasks run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.reference import filled, identifiers, worth_keeping
from paperloom.session import persist_table

ALIAS = "type string, value string, entity_id string"


def alias_rows(rows: DataFrame, ids: str = "ids", key: str = "row_key") -> DataFrame:
    """Identifiers of rows, one per row: row_key, type, value; blank ones are left out."""
    pairs = rows.select(F.col(key).alias("row_key"), F.explode(ids).alias("type", "value"))
    return pairs.where("trim(value) <> '' and type <> 'semopenalex'").select("row_key", "type", F.trim("value").alias("value")).distinct()


def within_source(pairs: DataFrame) -> DataFrame:
    """Rows of one source that share identifiers, directly or through others: row_key, group, the smallest row_key.

    Rows are first tied to the smallest row of each of their identifiers; then large and small stars
    take turns until no edge changes, which takes rounds in the logarithm of the longest chain. Minima
    are aggregated map-side, so an identifier of very many rows is no hot spot.
    """
    named = persist_table(pairs.select("row_key", F.concat_ws(":", "type", "value").alias("alias")), "edges")
    low = named.groupBy("alias").agg(F.min("row_key").alias("v"))
    edges = named.join(low.hint("merge"), "alias").where("row_key <> v").select(F.col("row_key").alias("u"), "v").distinct()
    edges, before = persist_table(edges, "star"), None
    while True:
        edges = persist_table(_small_star(_large_star(edges)), "star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return named.select("row_key").distinct().join(edges.select(F.col("u").alias("row_key"), "v").hint("merge"), "row_key", "left").select(
        "row_key", F.coalesce("v", "row_key").alias("group")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """The greater neighbours of each row tied to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
    return both.where("v > u").join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("w").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of each row, and the row, tied to the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("w"))
    tied = down.join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("w").alias("v"))
    return tied.unionByName(low.select("u", F.col("w").alias("v"))).where("u <> v").distinct()


def resolve(aliases: DataFrame, rows: DataFrame, prefix: str, ids: str = "ids", key: str = "row_key") -> DataFrame:
    """Each row with its entity: row_key, entity_id, outcome (known, new, conflict, no_ids)."""
    pairs = persist_table(alias_rows(rows, ids, key), "pairs")
    groups = persist_table(within_source(pairs), "groups")
    known = (
        pairs.join(aliases, ["type", "value"], "left").join(groups, "row_key")
        .groupBy("group").agg(
            F.min("entity_id").alias("low"), F.max("entity_id").alias("high"), F.min("row_key").alias("first")
        )
    )
    outcome = F.when(F.col("low").isNull(), "new").when(F.col("low") == F.col("high"), "known").otherwise("conflict")
    named = known.select(
        "group", outcome.alias("outcome"),
        F.when(F.col("low").isNull(), F.concat(F.lit(prefix + "."), F.col("first").cast("string")))
        .when(F.col("low") == F.col("high"), F.col("low")).alias("entity_id"),
    )
    decided = groups.join(named, "group").select("row_key", "entity_id", "outcome")
    return rows.select(F.col(key).alias("row_key")).distinct().join(decided, "row_key", "left").fillna("no_ids", ["outcome"])


def with_source(aliases: DataFrame, rows: DataFrame, prefix: str, ids: str = "ids", key: str = "row_key") -> tuple[DataFrame, DataFrame]:
    """The alias table after a source, and the outcome of its rows."""
    outcome = persist_table(resolve(aliases, rows, prefix, ids, key), "outcome")
    fresh = alias_rows(rows, ids, key).join(outcome.where("entity_id is not null").select("row_key", "entity_id"), "row_key")
    added = fresh.groupBy("type", "value").agg(F.min("entity_id").alias("entity_id")).join(aliases, ["type", "value"], "left_anti")
    return persist_table(aliases.unionByName(added.select("type", "value", "entity_id")), "aliases"), outcome


def build(sources: Sequence[tuple[str, DataFrame]], ids: str = "ids", key: str = "row_key") -> tuple[DataFrame, DataFrame]:
    """The alias table of several sources in their order, and all outcomes with the source (P8 in ``conflict``)."""
    spark = sources[0][1].sparkSession
    aliases, outcomes = spark.createDataFrame([], ALIAS), None
    for prefix, rows in sources:
        aliases, outcome = with_source(aliases, rows, prefix, ids, key)
        outcome = outcome.withColumn("source", F.lit(prefix))
        outcomes = outcome if outcomes is None else outcomes.unionByName(outcome)
    return aliases, outcomes


def lookup(aliases: DataFrame, key: str) -> DataFrame:
    """All aliases of an entity, asked by its id or by one ``type:value``."""
    kind, colon, value = key.partition(":")
    hit = aliases.where((F.col("type") == kind) & (F.col("value") == value)) if colon else aliases.where(F.col("entity_id") == key)
    found = hit.select("entity_id").distinct()
    names = F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "type", "value"))), " | ")
    return aliases.join(F.broadcast(found.limit(1)), "entity_id").groupBy("entity_id").agg(names.alias("aliases"))


def entity_of(rows: DataFrame, aliases: DataFrame, order: Sequence[str], ids: str = "ids", key: str = "row_key") -> DataFrame:
    """The entity of each row by its first identifier that resolves, in an order of types (Q1)."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("type"))
    ranked = alias_rows(rows, ids, key).join(aliases, ["type", "value"]).withColumn("place", F.when(place > 0, place).otherwise(len(order) + 1))
    return ranked.groupBy("row_key").agg(F.min(F.struct("place", "value", "entity_id"))["entity_id"].alias("entity_id"))


def upsert(index: DataFrame, rows: DataFrame, fields: tuple[str, ...], key: str = "entity_id", order: str | None = None) -> DataFrame:
    """The index with rows of another source: inserted, filled in, or refused (Q3 to Q5).

    ``index`` and ``rows`` have the key and the fields. Several rows of one key are merged row after row
    in ``order``: each field is the first that any of them has (without order, the smallest).
    Outcome: kept, inserted, filled, nothing_new, too_little (refused, not in the index).
    """
    def merged(df: DataFrame, name: str) -> DataFrame:
        def first(f: str) -> Column:
            return F.min_by(f, F.when(F.col(f).isNotNull(), F.col(order))) if order else F.min(f)

        each = df.where(F.col(key).isNotNull()).groupBy(key).agg(*(first(f).alias(f) for f in fields))
        return each.select(key, F.struct(*fields).alias(name))

    both = merged(index, "old").join(merged(rows, "new"), key, "full")
    made = filled(F.col("old"), F.col("new"), fields)
    outcome = (
        F.when(F.col("new").isNull(), "kept").when(F.col("old").isNull() & worth_keeping(F.col("new")), "inserted")
        .when(F.col("old").isNull(), "too_little").when(made["changed"], "filled").otherwise("nothing_new")
    )
    record = F.when(F.col("old").isNull(), F.col("new")).when(F.col("new").isNull(), F.col("old"))
    chosen = [F.coalesce(record[f], made[f]).alias(f) for f in fields]
    return both.select(key, *chosen, outcome.alias("outcome"))


def enriched(index: DataFrame, rows: DataFrame, text: Column, good: Column, key: str = "entity_id") -> DataFrame:
    """The index with a short citation where it has none and a good row offers one (Q6, Q7)."""
    offered = rows.where(good & text.isNotNull()).groupBy(key).agg(F.min(text).alias("_short"))
    return index.join(offered, key, "left").withColumn("short_content", F.coalesce("short_content", "_short")).drop("_short")


def enrichment_census(index: DataFrame, rows: DataFrame, text: Column, good: Column, key: str = "entity_id") -> DataFrame:
    """Counts of rows by what happens to their short citation (Q6)."""
    have = index.select(key, F.col("short_content").isNotNull().alias("_has")).distinct()
    seen = rows.withColumn("_good", F.coalesce(good & text.isNotNull(), F.lit(False))).join(have, key, "left")
    state = (
        F.when(~F.col("_good"), "not_good").when(F.col(key).isNull(), "unresolved").when(F.col("_has").isNull(), "not_indexed")
        .when(F.col("_has"), "present").otherwise("added")
    )
    return seen.groupBy(state.alias("state")).agg(F.count("*").alias("rows"))


def _id_map(**columns: Column) -> Column:
    """A map of the identifiers that are not blank."""
    made = F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*(F.nullif(F.trim(c.cast("string")), F.lit("")) for c in columns.values())))
    return F.map_filter(made, lambda _, v: v.isNotNull())


def crossref_ids(items: DataFrame) -> DataFrame:
    """Rows of a DOI registry: row_key, ids; rows with more than one alternative id or no DOI are passed over."""
    several = F.size(F.array_distinct(F.coalesce("`alternative-id`", F.array().cast("array<string>")))) > 1
    return items.where(F.col("DOI").isNotNull() & ~several).select("row_key", _id_map(doi=F.col("DOI")).alias("ids"))


def scholar_ids(rows: DataFrame) -> DataFrame:
    """Rows of a catalogue with a map of external ids: row_key, ids by canonical name; an OpenAlex id begins with W."""
    ids = identifiers(F.map_filter("externalids", lambda k, _: F.lower(k) != "corpusid"))
    upper = F.transform_values(ids, lambda k, v: F.when(k == "openalex", F.regexp_replace(v, "^w", "W")).otherwise(v))
    return rows.select("row_key", F.map_filter(upper, lambda k, _: k != "semopenalex").alias("ids"))


def entry_ids(papers: DataFrame) -> DataFrame:
    """Bibliography entries of deliveries: row_key (of delivery and entry), ids (P5)."""
    rows = papers.select("row_id", F.posexplode(F.map_entries("bib_entries")).alias("pos", "e"))
    ids = identifiers(F.map_filter("e.value.ids", lambda _, v: F.coalesce(F.trim(v), F.lit("")) != ""))
    return rows.select(F.concat_ws("/", "row_id", "pos").alias("row_key"), ids.alias("ids")).where("ids is not null")


def preprint_ids(rows: DataFrame) -> DataFrame:
    """Rows of preprint metadata with id and doi: row_key, ids."""
    return rows.select("row_key", _id_map(arxiv=F.col("id"), doi=F.col("doi")).alias("ids"))


def conflicts(outcome: DataFrame, rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """The identifiers of rows that name several entities, each with its entity: row_key, type, value, entity_id."""
    several = outcome.where("outcome = 'conflict'").select("row_key")
    return alias_rows(rows).join(several, "row_key", "left_semi").join(aliases, ["type", "value"]).select("row_key", "type", "value", "entity_id")
