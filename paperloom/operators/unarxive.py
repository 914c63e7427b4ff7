"""Conversion of deliveries in unarXive form: numbering of entries, marks to text, paragraphs to sections."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import PREPOSITIONS

#: The word for each kind of entry (fixed values).
WORDS = {"figure": "Figure", "table": "Table", "cite": "Ref"}
#: Names of sections that belong to the appendix (fixed values).
APPENDIX = ("appendix", "supplementary")


def entry_values(papers: DataFrame) -> DataFrame:
    """The text that each mark of a delivery stands for: row_id, paper_id, kind, entry_key, n, value.

    Entries are numbered from 0 in the order of the maps, per kind and delivery; text and
    number agree. A formula stands for itself between dollar signs, other kinds for nothing.
    """
    refs = papers.select("row_id", "paper_id", F.posexplode(F.map_entries("ref_entries")).alias("pos", "e")).select(
        "row_id", "paper_id", "pos", F.lower(F.trim("e.value.type")).alias("kind"), F.col("e.key").alias("entry_key"),
        F.col("e.value.latex").alias("latex"),
    )
    cites = papers.select("row_id", "paper_id", F.posexplode(F.map_entries("bib_entries")).alias("pos", "e")).select(
        "row_id", "paper_id", "pos", F.lit("cite").alias("kind"), F.col("e.key").alias("entry_key"), F.lit(None).cast("string").alias("latex"),
    )
    n = F.row_number().over(Window.partitionBy("row_id", "kind").orderBy("pos")) - 1
    words = F.create_map(*(F.lit(x) for kv in WORDS.items() for x in kv))
    named = F.concat(F.lit("["), words[F.col("kind")], F.lit("."), F.col("n").cast("string"), F.lit(" of ArXiv:"), F.col("paper_id"), F.lit("]"))
    value = F.when(F.col("kind") == "formula", F.concat(F.lit("$"), F.coalesce("latex", F.lit("")), F.lit("$"))).otherwise(F.coalesce(named, F.lit("")))
    return refs.unionByName(cites).withColumn("n", n).select("row_id", "paper_id", "kind", "entry_key", "n", value.alias("value"))


def with_values(text: Column, values: Column) -> Column:
    """A text whose marks ``{{kind:key}}`` are replaced by a map from ``kind:key``; unknown ones stay (M1, M5).

    The text is cut at the marks, so each is looked up once and nothing is replaced twice.
    """
    parts = F.split(text, r"(?=\{\{)|(?<=\}\})")

    def one(x: Column) -> Column:
        mark = F.regexp_extract(x, r"^\{\{\s*([A-Za-z]+)\s*:([^{}]*)\}\}$", 1)
        keys = F.split(F.regexp_extract(x, r"^\{\{\s*([A-Za-z]+)\s*:([^{}]*)\}\}$", 2), ",")
        found = F.transform(keys, lambda k: F.element_at(values, F.concat(F.lower(mark), F.lit(":"), F.lower(F.trim(k)))))
        known = F.array_compact(found)
        return F.when((mark != "") & (F.size(known) > 0), F.array_join(known, ", ")).otherwise(x)

    return F.array_join(F.transform(parts, one), "")


def merged_citations(text: Column) -> Column:
    """Neighbouring references in one pair of brackets (M3)."""
    return F.regexp_replace(text, r"\]\s*,?\s*\[(?=(?:Ref|Figure|Table)\.)", ", ")


def numbered_marks(text: Column, paper: Column) -> Column:
    """Numbers in brackets as references: bare at the start of a sentence, with its preposition, else ``(See …)`` (M4).

    The text is cut at the marks; what stands before a mark is then the piece before it.
    """
    return _marks(text, r"\[[\d, -]+\]", lambda m: F.concat(F.lit("[Ref."), F.regexp_extract(m, r"^\[(.*)\]$", 1), F.lit(" of "), paper, F.lit("]")))


def named_marks(text: Column) -> Column:
    """References already written out in brackets, put as :func:`numbered_marks` puts numbers (M4)."""
    return _marks(text, r"\[\s*(?:DOI:|ArXiv:|Ref\.|ALEX:)[^\]]*\]", lambda m: m)


def _marks(text: Column, mark: str, label) -> Column:  # noqa: ANN001
    parts = F.split(text, rf"(?={mark})|(?<=\])")

    def one(x: Column, i: Column, all_: Column) -> Column:
        before = F.rtrim(F.coalesce(F.get(all_, i - 1), F.lit("")))
        word = F.lower(F.element_at(F.split(before, r"\s+"), -1))
        bare = (before == "") | before.rlike(r"[.!?;]$") | word.isin(PREPOSITIONS)
        return F.when(x.rlike(rf"^{mark}$"), F.when(bare, label(x)).otherwise(F.concat(F.lit("(See "), label(x), F.lit(")")))).otherwise(x)

    def whole(p: Column) -> Column:
        return F.array_join(F.transform(p, lambda x, i: one(x, i, p)), "")

    return F.get(F.transform(F.array(parts), whole), F.lit(0))


def paragraphs(papers: DataFrame) -> DataFrame:
    """Paragraphs with marks resolved: row_id, paper_id, pos, section_num, section_name, text, zone.

    The zone is reference from a paragraph that begins with "reference" on until one that begins
    with "appendix" or "supplementary", acknowledgement for such a paragraph, else body.
    """
    mark = F.concat_ws(":", "kind", F.lower(F.trim("entry_key")))
    # keys that differ in case or blanks are one; the first in the map holds
    once = entry_values(papers).groupBy("row_id", mark.alias("k")).agg(F.min(F.struct("n", "value"))["value"].alias("v"))
    values = once.groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("values"))
    body = papers.select("row_id", "paper_id", F.posexplode("body_text").alias("pos", "b")).join(values, "row_id", "left")
    empty = F.create_map().cast("map<string,string>")
    mapped = F.coalesce("values", empty)
    start = F.lower(F.trim("b.text"))
    turn = F.when(start.startswith("appendix") | start.startswith("supplementary"), F.lit(False)).when(start.startswith("reference"), F.lit(True))
    rows = body.select(
        "row_id", "paper_id", "pos", F.trim("b.sec_number").alias("section_num"),
        F.trim(F.regexp_replace(with_values(F.col("b.section"), mapped), r"\s+", " ")).alias("section_name"),
        merged_citations(F.trim(F.regexp_replace(with_values(F.col("b.text"), mapped), r"\s+", " "))).alias("text"),
        turn.alias("turn"), F.trim("b.text").startswith("Acknowledgement").alias("thanks"),
    )
    inside = F.coalesce(F.last("turn", ignorenulls=True).over(Window.partitionBy("row_id").orderBy("pos")), F.lit(False))
    zone = F.when(F.coalesce("thanks", F.lit(False)), "acknowledgement").when(F.col("inside"), "reference").otherwise("body")
    return rows.withColumn("inside", inside).select("row_id", "paper_id", "pos", "section_num", "section_name", "text", zone.alias("zone"))


def joined_paragraphs(rows: DataFrame) -> DataFrame:
    """Paragraphs of a section that go on from the one before, joined to it (M7, M9).

    A paragraph goes on if it begins in lower case or with "Proof", or if the one before ends with
    a dollar sign or colon and has less than 128 words. An island of such is one paragraph.
    """
    by = Window.partitionBy("row_id", "section_num").orderBy("pos")
    before = F.lag("text").over(by)
    open_end = before.rlike(r"[$:]\s*$") & (F.size(F.split(before, r"\s+")) < 128)
    goes_on = F.coalesce(F.col("text").rlike(r"^\s*(?:\p{Ll}|Proof)") & before.isNotNull(), F.lit(False)) | F.coalesce(open_end, F.lit(False))
    some = rows.where("zone = 'body' and text <> ''")
    return (
        some.withColumn("starts", F.when(goes_on, 0).otherwise(1))
        .withColumn("island", F.sum("starts").over(by))
        .groupBy("row_id", "paper_id", "section_num", "island")
        .agg(
            F.min("pos").alias("pos"), F.max_by("section_name", "pos").alias("section_name"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ").alias("text"),
        )
        .drop("island")
    )


def sections(papers: DataFrame) -> DataFrame:
    """Sections in first-seen order: row_id, paper_id, section_num, section_title, section_content, is_appendix."""
    rows = joined_paragraphs(paragraphs(papers))
    grouped = rows.groupBy("row_id", "paper_id", "section_num").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias("section_content"),
        F.max_by("section_name", "pos").alias("name"), F.min("pos").alias("first_pos"),
    )
    number = F.coalesce("section_num", F.lit(""))
    extra = F.lower("name").isin(*APPENDIX) | number.contains("-")
    title = F.when(F.coalesce("name", F.lit("")) != "", F.col("name")).when(
        F.coalesce(extra, F.lit(False)), F.concat(F.lit("Appendix "), F.replace(number, F.lit("-"), F.lit("")))
    ).otherwise(F.concat(F.lit("Section "), number))
    return grouped.select(
        "row_id", "paper_id", "section_num", title.alias("section_title"), "section_content",
        F.coalesce(extra, F.lit(False)).alias("is_appendix"), "first_pos",
    )


def resolved_citations(papers: DataFrame) -> DataFrame:
    """Bibliography entries with their ids; resolved if one id is given and the text holds one citation."""
    rows = papers.select("row_id", "paper_id", F.posexplode(F.map_entries("bib_entries")).alias("pos", "e"))
    ids = F.map_filter("e.value.ids", lambda _, v: F.coalesce(F.trim(v), F.lit("")) != "")
    some = F.coalesce(F.size(ids) > 0, F.lit(False))
    single = ~F.coalesce(F.contains("e.value.bib_entry_raw", F.lit(";")), F.lit(False))
    return rows.select(
        "row_id", "paper_id", "pos", F.col("e.key").alias("bib_key"), F.col("e.value.bib_entry_raw").alias("text"),
        (some & single).alias("is_resolved"),
    )


def packed(rows: DataFrame, least: int = 128, most: int = 512) -> DataFrame:
    """Paragraphs of a section packed to ``most`` words; a rest below ``least`` joins what is before it (M8).

    ``rows`` has row_id, section_num, pos, text. Sections are packed where their rows meet, in one
    group per section: what a section holds is bounded by its document.
    """
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = []
        for pos, text in pdf.sort_values("pos")[["pos", "text"]].itertuples(index=False):
            n = len((text or "").split())
            if out and out[-1][2] + n <= most:
                out[-1][1] += "\n" + (text or "")
                out[-1][2] += n
            else:
                out.append([pos, text or "", n])
        if len(out) > 1 and out[-1][2] < least:
            out[-2][1] += "\n" + out[-1][1]
            out[-2][2] += out[-1][2]
            out.pop()
        made = pd.DataFrame(out, columns=["pos", "text", "n_words"])
        made.insert(0, "section_num", pdf["section_num"].iloc[0])
        made.insert(0, "row_id", pdf["row_id"].iloc[0])
        return made.astype({"pos": "int32", "n_words": "int32"})

    return rows.groupBy("row_id", "section_num").applyInPandas(pack, "row_id bigint, section_num string, pos int, text string, n_words int")


def json_lines(rows: DataFrame, column: str = "line") -> DataFrame:
    """JSON lines read as VARIANT: the record, and whether the line is broken (A4)."""
    record = F.try_parse_json(column)
    return rows.withColumn("record", record).withColumn("is_broken", F.col("record").isNull())
