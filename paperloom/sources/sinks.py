"""Sinks: tables by month, status lists, one text per document, versions of an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import yymm


def write_by_month(df: DataFrame, path: str, id_col: str = "paper_id") -> None:
    """A table in folders by the year and month in its ids."""
    df.withColumn("yymm", F.coalesce(yymm(F.col(id_col)), F.lit("none"))).write.mode("overwrite").partitionBy("yymm").parquet(path)


def write_status_lists(df: DataFrame, path: str, item: str = "id", status: str = "status") -> None:
    """The distinct items of each status as texts in a folder of their own."""
    df.select(F.col(item).cast("string").alias("value"), F.coalesce(status, F.lit("none")).alias("status")).distinct().write.mode(
        "overwrite"
    ).partitionBy("status").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line (B1)."""
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str, column: str) -> None:
    """One text per line; breaks inside become blanks, nulls empty lines (B1)."""
    df.select(F.coalesce(F.regexp_replace(column, r"\s*\R\s*", " "), F.lit("")).alias("value")).write.mode("overwrite").text(path)


def write_index(df: DataFrame, path: str, version: str, key: str = "entity_id") -> DataFrame:
    """A version of an index, and the rows refused for want of a key."""
    df.where(F.col(key).isNotNull()).write.mode("overwrite").parquet(f"{path}/version={version}")
    return df.where(F.col(key).isNull())
