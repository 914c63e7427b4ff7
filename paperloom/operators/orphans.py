"""References to records that do not exist: fixpoint cascade over a foreign-key graph.

A row is a *direct* orphan if a key it holds has no row in the parent table. A child of an
orphan is an *inherited* orphan; the cascade runs semi-joins down the graph, level by level,
until no table gains orphans.

Defined results
---------------
* A null key refers to nothing and is no orphan. Repeated rows are kept and count each.
* An empty parent table makes every non-null reference an orphan; an empty child has none.
* Extra columns pass through; the operator's own names start with ``orphan_``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import persist_table


@dataclass(frozen=True)
class ForeignKey:
    """``child.columns`` refer to ``parent.parent_columns``."""

    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def _hit(child: DataFrame, parent: DataFrame, fk: ForeignKey, how: str) -> DataFrame:
    names = [f"orphan_k{i}" for i in range(len(fk.columns))]
    keys = parent.select(*(F.col(c).alias(n) for c, n in zip(fk.parent_columns, names, strict=True)))
    on = [F.col(c) == F.col(n) for c, n in zip(fk.columns, names, strict=True)]
    return child.join(keys, on, how)


def direct_orphans(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Rows of ``child`` whose non-null key is not in ``parent``."""
    held = child.where(" and ".join(f"`{c}` is not null" for c in fk.columns))
    return _hit(held, parent, fk, "left_anti")


def cascade(
    tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey], max_levels: int | None = None
) -> dict[str, DataFrame]:
    """The orphans of each table that refers to another: its rows with ``orphan_level``.

    Level 0 is direct, level n was inherited from an orphan of level n - 1. Each table needs a
    column ``orphan_id``, unique within it. The loop ends with the first level that finds no new
    row: in an acyclic graph after its depth, in a cyclic one when all reachable rows are found.
    ``max_levels=0`` gives the direct orphans only. Each level is written to the shared folder.
    """
    levels: dict[str, list[DataFrame]] = {}
    front: dict[str, DataFrame] = {}
    for name, df in tables.items():
        if own := [direct_orphans(df, tables[k.parent], k) for k in keys if k.child == name]:
            found = reduce(DataFrame.unionByName, own)
            front[name] = persist_table(found.dropDuplicates(["orphan_id"]), "orphans") if max_levels != 0 else found
            levels[name] = [front[name].withColumn("orphan_level", F.lit(0))]
    level = 0
    while front and (max_levels is None or level < max_levels):
        level += 1
        gained: dict[str, DataFrame] = {}
        for name, df in tables.items():
            hits = [_hit(df, front[k.parent], k, "left_semi") for k in keys if k.child == name and k.parent in front]
            if not hits:
                continue
            found = reduce(DataFrame.unionByName, hits)
            for seen in levels[name]:
                found = found.join(seen.select("orphan_id"), "orphan_id", "left_anti")
            found = persist_table(found.dropDuplicates(["orphan_id"]).select(df.columns), "orphans")
            if found.take(1):
                gained[name] = found
                levels[name].append(found.withColumn("orphan_level", F.lit(level)))
        front = gained
    return {name: reduce(DataFrame.unionByName, found) for name, found in levels.items()}


#: Kinds of marks and the entry table each refers to (fixed values).
MARK_TABLES = {"cite": "bib_entries", "figure": "ref_entries", "table": "ref_entries", "formula": "ref_entries"}


def marks(papers: DataFrame) -> DataFrame:
    """References in the body of each delivery: row_id, paper_id, delivered_at, section_pos, entry_table, entry_key.

    Keys come in lower case without outer blanks, once per row, section and table. Null sections,
    texts and arrays hold no marks; a mark of another kind refers to nothing.
    """
    pattern = r"\{\{\s*([A-Za-z]+)\s*:([^{}]*)\}\}"
    part = papers.select(
        "row_id", "paper_id", "delivered_at", F.posexplode("body_text").alias("section_pos", "b")
    ).select(
        "row_id", "paper_id", "delivered_at", "section_pos",
        F.concat_ws("\n", F.col("b.section"), F.col("b.text")).alias("said"),
    )
    found = part.where(F.col("said").contains("{{")).select(
        "row_id", "paper_id", "delivered_at", "section_pos",
        F.explode(
            F.arrays_zip(
                F.regexp_extract_all("said", F.lit(pattern), 1).alias("kind"),
                F.regexp_extract_all("said", F.lit(pattern), 2).alias("keys"),
            )
        ).alias("m"),
    )
    to = F.create_map(*(F.lit(x) for kv in MARK_TABLES.items() for x in kv))
    blanks = r"^[\s ]+|[\s ]+$"
    return (
        found.select(
            "row_id", "paper_id", "delivered_at", "section_pos",
            to[F.lower(F.col("m.kind"))].alias("entry_table"),
            F.explode(F.split("m.keys", ",")).alias("key"),
        )
        .select(
            "row_id", "paper_id", "delivered_at", "section_pos", "entry_table",
            F.lower(F.regexp_replace("key", blanks, "")).alias("entry_key"),
        )
        .where("entry_table is not null and entry_key <> ''")
        .distinct()
    )


def own_entries(papers: DataFrame) -> DataFrame:
    """Keys of the two maps of each delivery that have a non-null value."""
    def keys(name: str) -> DataFrame:
        return papers.select("row_id", F.explode(name).alias("entry_key", "v")).where("v is not null").select(
            "row_id", F.lit(name).alias("entry_table"), F.lower(F.trim("entry_key")).alias("entry_key")
        )

    return keys("bib_entries").unionByName(keys("ref_entries")).distinct()


def entries_there(papers: DataFrame, changes: DataFrame, refs: DataFrame) -> DataFrame:
    """Of the referred keys, those there at delivery: row_id, entry_table, entry_key.

    The last change at or before delivery decides; of changes at one instant the one received
    last, and of those an add. Without a change the row's own map decides. Rows whose key, kind
    or time is null change nothing; repeated rows and late receipt make no difference.
    """
    asked = refs.select("row_id", "paper_id", "delivered_at", "entry_table", "entry_key").distinct()
    log = changes.select(
        "paper_id",
        F.lower(F.trim("entry_table")).alias("entry_table"),
        F.lower(F.trim("entry_key")).alias("entry_key"),
        F.lower(F.trim("change_kind")).alias("change_kind"),
        "changed_at",
        "received_at",
    ).where("change_kind in ('add', 'delete') and changed_at is not null")
    last = (
        asked.join(log, ["paper_id", "entry_table", "entry_key"])
        .where("changed_at <= delivered_at")
        .groupBy("row_id", "entry_table", "entry_key")
        .agg(F.max(F.struct("changed_at", "received_at", F.col("change_kind") == "add")).alias("last"))
        .select("row_id", "entry_table", "entry_key", F.col("last.col3").alias("by_log"))
    )
    own = own_entries(papers).withColumn("own", F.lit(True))
    on = ["row_id", "entry_table", "entry_key"]
    return (
        asked.select(*on)
        .join(last, on, "left")
        .join(own, on, "left")
        .where(F.coalesce("by_log", "own", F.lit(False)))
        .select(*on)
    )


ON_ENTRY = ("row_id", "entry_table", "entry_key")
#: The graph of a delivery: marks refer to entries and lie in sections, subsections refer to their section.
PAPER_KEYS = (
    ForeignKey("marks", ON_ENTRY, "entries", ON_ENTRY),
    ForeignKey("marks", ("row_id", "section_pos"), "sections", ("row_id", "section_pos")),
    ForeignKey("sections", ("row_id", "outer_number"), "sections", ("row_id", "number")),
)


def numbered_sections(papers: DataFrame) -> DataFrame:
    """Sections of each delivery with their number and that of the section around it, null at the top."""
    number = F.nullif(F.trim("b.sec_number"), F.lit(""))
    outer = F.nullif(F.regexp_extract(F.col("number"), r"^(.+)[.\-][^.\-]+$", 1), F.lit(""))
    return (
        papers.select("row_id", "delivered_at", F.posexplode("body_text").alias("section_pos", "b"))
        .select("row_id", "delivered_at", "section_pos", number.alias("number"))
        .withColumn("outer_number", outer)
        .withColumn("orphan_id", F.concat_ws("/", "row_id", "section_pos"))
    )


def paper_tables(papers: DataFrame, changes: DataFrame) -> dict[str, DataFrame]:
    """The tables of :data:`PAPER_KEYS`."""
    refs = marks(papers)
    return {
        "entries": entries_there(papers, changes, refs),
        "marks": refs.withColumn("orphan_id", F.concat_ws("/", "row_id", "section_pos", "entry_table", "entry_key")),
        "sections": numbered_sections(papers),
    }


def missing_entries(papers: DataFrame, changes: DataFrame) -> DataFrame:
    """Marks whose entry is not there, the direct orphans of the cascade: row_id, entry_table, entry_key, once per row and table."""
    found = cascade(paper_tables(papers, changes), PAPER_KEYS)["marks"]
    return found.where("orphan_level = 0").select(*ON_ENTRY).distinct()


def orphan_report(papers: DataFrame, changes: DataFrame) -> DataFrame:
    """Orphans per table and month of delivery: orphan_table, month, direct, inherited.

    Marks are reported under the entry table they refer to, each once per section that holds it.
    """
    found = cascade(paper_tables(papers, changes), PAPER_KEYS)
    both = found["marks"].select(F.col("entry_table").alias("orphan_table"), "delivered_at", "orphan_level").unionByName(
        found["sections"].select(F.lit("sections").alias("orphan_table"), "delivered_at", "orphan_level")
    )
    return both.groupBy("orphan_table", F.date_format("delivered_at", "yyyy-MM").alias("month")).agg(
        F.count_if(F.col("orphan_level") == 0).alias("direct"),
        F.count_if(F.col("orphan_level") > 0).alias("inherited"),
    )
