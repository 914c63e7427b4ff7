"""Sessions, table access and durable cut points.

Lineage is cut only through reliable storage: the folder in ``spark.checkpoint.dir`` of the
session, which a cluster sets to shared storage. Where it is unset (tests, one machine) a
folder of our own is used.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A one-machine session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paperloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="paperloom-")


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder for cut points; a folder of our own only where unset and all runs on one machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (at or _own_dir()).rstrip("/")


#: The setting by which an execution removes its shuffle files at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def persist_table(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    # The shuffle files of this write are needed no longer once it is done; Spark then removes them.
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a table that :func:`persist_table` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for at in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored_bytes(df: DataFrame) -> int:
    """Bytes on storage of a DataFrame that was just read back from files, by the optimizer's statistics."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(stats.sizeInBytes().toString())


def cpu_slots(spark: SparkSession) -> int:
    """Task slots that the session can fill, at least one."""
    return max(1, spark.sparkContext.defaultParallelism)


__all__ = ["cpu_slots", "discard", "local_session", "persist_table", "shared_dir", "stored_bytes", "table"]
