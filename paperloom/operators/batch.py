"""Batches of work: shards, statuses, resumption and set operations on lists of items."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shard_of(df: DataFrame, order: str, parts: int, name: str = "shard") -> DataFrame:
    """The range shard of each item by its rank: shard i holds ranks from N*i/parts to N*(i+1)/parts.

    Ranks come from a range-partitioned sort and per-partition counts, not from one task.
    """
    ranked = with_rank(df, order, "_rank")
    n = df.count()
    bound = F.floor((F.col("_rank") * parts + parts - 1) / max(n, 1))
    candidates = ranked.withColumn(name, F.least(bound, F.lit(parts - 1)).cast("int"))
    low = F.floor(F.col(name) * n / parts)
    return candidates.withColumn(name, F.when(F.col("_rank") < low, F.col(name) - 1).otherwise(F.col(name))).drop("_rank")


def with_rank(df: DataFrame, order: str, name: str) -> DataFrame:
    """Ranks from 0 in an order, for tables of any size: sort by ranges, then add the sizes before each range."""
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType())])

    def number(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for pdf in batches:
            yield pdf.assign(_part=part, _at=range(at, at + len(pdf)))
            at += len(pdf)

    from paperloom.session import persist_table

    placed = persist_table(df.orderBy(order).mapInPandas(number, schema), "ranks")
    sizes = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # a row per partition
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]
    starts = df.sparkSession.createDataFrame(list(before.items()), "_part int, _before bigint")
    return placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_at") + F.col("_before")).drop("_part", "_at", "_before")


def status_census(df: DataFrame, status: str = "status") -> DataFrame:
    """Number of items of each status (C4)."""
    return df.groupBy(status).agg(F.count("*").alias("items"))


def unfinished(items: DataFrame, done: DataFrame, key: str = "id", redo: bool = False) -> DataFrame:
    """Items that have no output yet; all of them if ``redo``."""
    return items if redo else items.join(done.select(key).distinct(), key, "left_anti")


def remake_set(failed: DataFrame, sources: DataFrame, outputs: DataFrame, key: str = "id") -> DataFrame:
    """Items that failed, and sources without an output."""
    return failed.select(key).union(sources.select(key).join(outputs.select(key), key, "left_anti")).distinct()


def tried(fn: Callable[[str], object], kind: str, errors: dict[str, str] | None = None):  # noqa: ANN201
    """A vectorised function that never fails: struct of value, status and error.

    The status is Finish, Skip for null, the name given for an exception type, or Fail.
    """
    names = dict(errors or {})

    @F.pandas_udf(f"value {kind}, status string, error string")
    def run(x: pd.Series) -> pd.DataFrame:
        rows = []
        for item in x:
            if item is None:
                rows.append((None, "Skip", None))
                continue
            try:
                rows.append((fn(item), "Finish", None))
            except Exception as e:  # noqa: BLE001
                rows.append((None, names.get(type(e).__name__, "Fail"), f"{type(e).__name__}: {e}"[:500]))
        return pd.DataFrame(rows, columns=["value", "status", "error"])

    return run


def compared(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Old and new versions of items: new, gone, same or different."""
    a = old.select(key, F.sha2(F.col(value).cast("string"), 256).alias("_old"), F.lit(True).alias("_in_old"))
    b = new.select(key, F.sha2(F.col(value).cast("string"), 256).alias("_new"), F.lit(True).alias("_in_new"))
    verdict = (
        F.when(F.col("_in_old").isNull(), "new").when(F.col("_in_new").isNull(), "gone")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "same").otherwise("different")
    )
    return a.join(b, key, "full").select(key, verdict.alias("verdict"))


def presence(items: DataFrame, outputs: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """For each item which outputs exist, one boolean column per output."""
    for name, df in outputs.items():
        items = items.join(df.select(key).distinct().withColumn(name, F.lit(True)), key, "left").fillna(False, [name])
    return items


def excluded(items: DataFrame, banned: DataFrame, key: str) -> DataFrame:
    """Items not on a list of ids, such as those whose licence forbids use."""
    return items.join(banned.select(key), key, "left_anti")


def case_of(*pairs: tuple[Column, str], other: str) -> Column:
    """The name of the first condition that holds; null counts as false."""
    out = F.lit(other)
    for condition, name in reversed(pairs):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out
