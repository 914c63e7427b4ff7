"""Sources: work lists, texts, JSON, archives, TEI records and folders."""

from __future__ import annotations

import gzip
import io
import tarfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Endings of archive members that are TeX sources (fixed values).
TEX_LIKE = (".tex", ".bbl", ".bib", ".sty", ".cls", ".bst", ".txt", ".ltx")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern matches anything, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a text, without blanks at their ends: line; no rows if the file is missing (A2)."""
    if not exists(spark, path):
        return spark.createDataFrame([], "line string")
    return spark.read.text(path).select(F.trim("value").alias("line"))


def work_list(spark: SparkSession, path: str, data_path: str = "") -> DataFrame:
    """Items of work: path (A1).

    A ``.filelist`` holds paths, an ``.arxivids`` file ids under ``data_path``; another file is one item, a
    folder its entries, and what does not exist an id under ``data_path``.
    """
    prefix = data_path.rstrip("/") + "/" if data_path else ""
    if not exists(spark, path):
        return spark.createDataFrame([(prefix + path,)], "path string")
    if path.endswith((".filelist", ".arxivids")):
        lines = text_lines(spark, path).where("line <> ''")
        return lines.select((F.concat(F.lit(prefix), "line") if path.endswith(".arxivids") else F.col("line")).alias("path"))
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.getFileStatus(at).isDirectory():
        return spark.createDataFrame([(path,)], "path string")
    return spark.createDataFrame([(str(s.getPath().toUri().getPath()),) for s in fs.listStatus(at)], "path string")


def whole_texts(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """Whole files: path, content; bytes that are no UTF-8 are replaced."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(path).select("path", F.decode("content", "UTF-8").alias("content"))


def json_document(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per file as VARIANT; no rows if missing (A3)."""
    if not exists(spark, path):
        return spark.createDataFrame([], "path string, value string").select("path", F.try_parse_json("value").alias("record"))
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.try_parse_json("value").alias("record"))


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line as VARIANT, shapes may differ; broken lines have a null record (A4)."""
    return spark.read.text(path).where("trim(value) <> ''").select(F.col("value").alias("line"), F.try_parse_json("value").alias("record"))


def item_records(spark: SparkSession, path: str) -> DataFrame:
    """The elements of ``items`` of JSON documents, plain or gzip, and whole lines of ``.jsonl`` files (A5). Empty files have none."""
    def read(ending: str, whole: bool) -> DataFrame | None:
        if path.endswith(ending):
            return spark.read.text(path, wholetext=whole)
        return spark.read.option("pathGlobFilter", f"*{ending}").text(path, wholetext=whole) if not path.endswith((".json", ".gz", ".jsonl")) else None

    parts = []
    for ending, whole in ((".json", True), (".gz", True), (".jsonl", False)):
        found = read(ending, whole)
        if found is not None:
            record = F.try_parse_json("value")
            items = F.try_variant_get(record, "$.items", "array<variant>") if whole else F.array(record)
            parts.append(found.where("trim(value) <> ''").select(F.explode(items).alias("record")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def line_count(spark: SparkSession, path: str) -> int:
    """The number of lines of a text, blank ones too (Q8)."""
    return spark.read.text(path).count() if exists(spark, path) else 0


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A list of names, one on a line, as a set: name (A18). Blank lines are none."""
    return text_lines(spark, path).where("line <> ''").select(F.col("line").alias("name")).distinct()


def venue_aliases(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object from a venue's name to all its names: venue (lower case), names."""
    pairs = F.try_variant_get("record", "$", "map<string,array<string>>")
    return json_document(spark, path).select(F.explode(pairs).alias("venue", "names")).select(F.lower("venue").alias("venue"), "names")


def point_read(store: DataFrame, keys: DataFrame, key: str = "_id") -> DataFrame:
    """The records of some keys, with whether each is there (A15, A16). A record wrapped once more in ``doc`` is unwrapped."""
    found = keys.select(key).distinct().join(store.withColumn("found", F.lit(True)), key, "left").withColumn("found", F.coalesce("found", F.lit(False)))
    return found.withColumn("doc", F.coalesce(F.try_variant_get("doc", "$.doc", "variant"), F.col("doc"))) if "doc" in found.columns else found


def reference_number(label: Column) -> Column:
    """The place of a reference and its paper in a label such as ``Ref.3 of ArXiv:x``."""
    return F.struct(F.regexp_extract(label, r"^Ref\.(\d+) of ", 1).try_cast("int").alias("pos"), F.nullif(F.regexp_extract(label, r" of ArXiv:(.+)$", 1), F.lit("")).alias("paper_id"))


def with_update(store: DataFrame, changes: DataFrame, key: str = "_id") -> DataFrame:
    """The store with the fields of some records replaced; unknown keys change nothing."""
    fields = [c for c in changes.columns if c != key]
    joined = store.join(changes.withColumnsRenamed({f: f"_new_{f}" for f in fields}), key, "left")
    return joined.select(key, *(F.coalesce(f"_new_{f}", f).alias(f) if f in fields else F.col(f) for f in store.columns if f != key))


def tei_records(spark: SparkSession, path: str) -> DataFrame:
    """Bibliographic records of TEI files with their place: path, pos, title, author, journal, year, note, status.

    A file that is no XML has one row with the status ParseError, one without records the status Empty.
    """
    from xml.etree import ElementTree as ET

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for at, text in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    root = ET.fromstring(text)
                except ET.ParseError:
                    rows.append((at, None, None, None, None, None, None, "ParseError"))
                    continue
                structs = [e for e in root.iter() if e.tag.rpartition("}")[2] == "biblStruct"]
                for pos, e in enumerate(structs):
                    named = [(x.tag.rpartition("}")[2], x) for x in e.iter()]

                    def said(tag: str, found: list = named, **want: str) -> str | None:
                        hits = (x for t, x in found if t == tag and all(x.get(k) == v for k, v in want.items()))
                        return next((" ".join("".join(x.itertext()).split()) for x in hits), None) or None

                    people = [" ".join(" ".join(x.itertext()).split()) for t, x in named if t == "persName"]
                    rows.append((at, pos, said("title"), people, said("title", level="j"), said("date"), said("note"), "Pass"))
                if not structs:
                    rows.append((at, None, None, None, None, None, None, "Empty"))
            made = pd.DataFrame(rows, columns=["path", "pos", "title", "author", "journal", "year", "note", "status"])
            yield made.astype({"pos": "Int32"})

    return whole_texts(spark, path).mapInPandas(run, "path string, pos int, title string, author array<string>, journal string, year string, note string, status string")


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """TeX-like members of source archives: path, member, content, status.

    Kinds are told by their first bytes: tar (plain or gzip), a single gzip text, plain TeX, PDF. What is
    none of them, or broken, gives one row with its status and no content.
    """
    def opened(data: bytes, depth: int = 0) -> Iterator[tuple[str, str | None, str]]:
        if data[:4] == b"%PDF":
            yield "", None, "pdf"
        elif data[:2] == b"\x1f\x8b" and depth < 3:
            yield from opened(gzip.decompress(data), depth + 1)
        elif data[257:262] == b"ustar":
            with tarfile.open(fileobj=io.BytesIO(data)) as tar:
                for m in tar:
                    if m.isfile() and m.name.lower().endswith(TEX_LIKE):
                        yield m.name, tar.extractfile(m).read().decode("utf-8", "ignore"), "member"
        elif b"\\document" in data or b"\\begin" in data or b"\\input" in data:
            yield "", data.decode("utf-8", "ignore"), "plain"
        else:
            yield "", None, "unknown"

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for at, data in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    rows += [(at, *m) for m in opened(bytes(data))] or [(at, "", None, "empty")]
                except (OSError, EOFError, tarfile.TarError):
                    rows.append((at, "", None, "broken"))
            yield pd.DataFrame(rows, columns=["path", "member", "content", "status"])

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInPandas(
        run, "path string, member string, content string, status string"
    )


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log files as lines with their place: path, pos, line."""
    whole = whole_texts(spark, path, "*.log")
    return whole.select("path", F.posexplode(F.split("content", r"\r?\n")).alias("pos", "line"))


def counted_against(records: DataFrame, references: DataFrame) -> DataFrame:
    """Whether a paper's parsed records are as many as its references: paper_id, n_records, n_references, status (A10)."""
    a = records.where("pos is not null").groupBy("paper_id").agg(F.count("*").alias("n_records"))
    b = references.groupBy("paper_id").agg(F.count("*").alias("n_references"))
    both = b.join(a, "paper_id", "left").fillna(0, ["n_records"])
    return both.withColumn("status", F.when(F.col("n_records") == F.col("n_references"), "Pass").when(F.col("n_records") == 0, "NoFile").otherwise("Fail"))
