"""Converted papers as related tables, and their rendering as Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.document import extract_udf
from paperloom.session import persist_table


def converted(docs: DataFrame, html: bool = False, id_col: str = "paper_id", text_col: str = "content") -> DataFrame:
    """Each document taken apart once: paper_id and the fields of the paper (I36, J21, K14). Written, for it is read often."""
    done = docs.select(F.col(id_col).alias("paper_id"), extract_udf(html)(F.col(text_col), F.col(id_col).cast("string")).alias("p"))
    return persist_table(done.select("paper_id", "p.*"), "papers")


def references(papers: DataFrame) -> DataFrame:
    """References with whether the text cites them: paper_id, pos, key, text, is_note, in_context."""
    rows = papers.select("paper_id", "cited", F.explode("references").alias("r"))
    return rows.select(
        "paper_id", "r.pos", "r.key", "r.text", "r.is_note", F.coalesce(F.map_contains_key("cited", F.col("r.key")), F.lit(False)).alias("in_context")
    )


def citation_counts(papers: DataFrame) -> DataFrame:
    """How often each key is cited: paper_id, key, n (I4)."""
    return papers.select("paper_id", F.explode("cited").alias("key", "n"))


def missing_citations(papers: DataFrame) -> DataFrame:
    """Cited keys that no reference has, numbered in their order: paper_id, n, key."""
    return papers.select("paper_id", F.posexplode(F.array_sort("missing")).alias("n", "key"))


def markdown(papers: DataFrame) -> DataFrame:
    """Each paper as Markdown: abstract, headings by depth, paragraphs, media in place (V5 to V7)."""
    def line(b: Column) -> Column:
        head = F.concat(F.repeat(F.lit("#"), F.least(b["level"] + 1, F.lit(6))), F.lit(" "), b["text"])
        return F.when(b["kind"] == "heading", head).when(b["kind"] == "item", F.concat(F.lit("- "), b["text"])).when(
            b["kind"] == "note", F.concat(F.lit("> "), b["text"])
        ).otherwise(b["text"])

    def filled(text: Column, media: Column) -> Column:
        parts = F.split(text, r"(?=!\[(?:Figure|Table|Float):)|(?<=\])")
        key = r"^!\[(?:Figure|Table|Float):(.*)\]$"
        return F.array_join(F.transform(parts, lambda x: F.coalesce(F.element_at(media, F.regexp_extract(x, key, 1))["source"], x)), "")

    body = F.array_join(F.transform("blocks", lambda b: filled(line(b), F.col("media"))), "\n\n")
    head = F.when(F.coalesce("abstract", F.lit("")) != "", F.concat(F.lit("# Abstract\n\n"), F.col("abstract"), F.lit("\n\n"))).otherwise(F.lit(""))
    return papers.where("status = 'Finish'").select("paper_id", F.concat(head, body).alias("markdown"))


def inline_results(papers: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Retrieved ids put back to their reference, in the order of their pieces: paper_id, key, label."""
    rows = references(papers).join(retrieved, ["paper_id", "pos"])
    ids = F.array_sort(F.collect_list(F.struct("pos", "found_id")))
    joined = F.array_join(F.transform(ids, lambda x: x["found_id"]), ",")
    return rows.groupBy("paper_id", "key").agg(F.concat(F.lit("<"), joined, F.lit(">")).alias("label"))
