"""Citation texts: splitting joined ones, merging the results of parsers, short forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import words

#: Longer texts are cut in the middle to this length (fixed value).
LONGEST = 6000
_STRIP = " .;:,!?"


def is_citation(c: Column) -> Column:
    """Whether a piece can stand as a citation: a capital first, more than ten words, no bare DOI (R2)."""
    t = F.btrim(c, F.lit(_STRIP))
    return t.rlike(r"^\p{Lu}") & (words(t) > 10) & ~F.lower(t).startswith("doi")


#: Parts citations while a text is folded; the sign never stands in text.
_PARTED = "\x1e"


def split_citations(c: Column) -> Column:
    """The citations of a text that semicolons part.

    A piece that can stand as a citation opens one, a piece that can't is glued to what is open, with a
    semicolon after it. What is open at the end is left out unless it can stand as a citation.
    """
    pieces = F.transform(F.split(F.btrim(c, F.lit(" .;:,")), ";"), lambda x: F.btrim(x, F.lit(_STRIP)))
    folded = F.aggregate(
        pieces, F.lit(""),
        lambda acc, x: F.when(is_citation(x), F.when(acc == "", x).otherwise(F.concat(acc, F.lit(_PARTED), x))).otherwise(F.concat(acc, x, F.lit(";"))),
    )
    found = F.get(F.transform(F.array(folded), lambda f: F.split(f, _PARTED)), F.lit(0))
    return F.filter(found, lambda x, i: (x != "") & ((i < F.size(found) - 1) | is_citation(x)))


def split_rows(refs: DataFrame, text: str = "text") -> DataFrame:
    """One row per citation, the key repeated: the other columns, piece_pos and text."""
    rest = [c for c in refs.columns if c != text]
    return refs.select(*rest, F.posexplode_outer(split_citations(F.col(text))).alias("piece_pos", text))


def shortened(c: Column, most: int = LONGEST) -> Column:
    """A text of at most about ``most`` signs: its halves around dots."""
    half = most // 2
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(half)), F.lit("...."), F.right(c, F.lit(half)))).otherwise(c)


def merged_parsers(refs: DataFrame, parsed: dict[str, DataFrame]) -> DataFrame:
    """References with the record of each parser and the plain text; status of each paper's parsers.

    All have paper_id and pos; parsers have ``record``. A parser whose number of records differs
    from that of the references is not used for that paper, and the status says so.
    """
    n = refs.groupBy("paper_id").agg(F.count("*").alias("_n"))
    out, state = refs.withColumn("plain_text", shortened(F.col("text"))), F.lit("pass")
    for name, df in parsed.items():
        counts = df.groupBy("paper_id").agg(F.count("*").alias("_m"))
        fits = counts.join(n, "paper_id").where("_n = _m").select("paper_id")
        used = df.join(fits, "paper_id", "left_semi").select("paper_id", "pos", F.col("record").alias(name))
        have = counts.select("paper_id", F.lit(True).alias(f"_has_{name}")).join(fits.withColumn(f"_fit_{name}", F.lit(True)), "paper_id", "left")
        out = out.join(used, ["paper_id", "pos"], "left").join(have, "paper_id", "left")
        state = F.when(F.col(f"_has_{name}").isNull(), F.lit(f"no_{name}")).when(F.col(f"_fit_{name}").isNull(), F.lit(f"different_length_{name}")).otherwise(state)
    drop = [f"_{a}_{name}" for a in ("has", "fit") for name in parsed]
    return out.withColumn("status", state).drop(*drop)


def short_citation(author: Column, journal: Column, volume: Column, page: Column, year: Column) -> Column:
    """The short form of a citation without title, after the style of engineering journals."""
    names = F.when(F.size(author) == 1, F.get(author, F.lit(0))).when(
        F.size(author) == 2, F.array_join(author, " and ")
    ).otherwise(F.concat(F.array_join(F.slice(author, 1, F.size(author) - 1), ", "), F.lit(", and "), F.element_at(author, -1)))
    parts = F.array_compact(F.array(
        names, journal, F.when(volume.isNotNull(), F.concat(F.lit("vol. "), volume)), F.when(page.isNotNull(), F.concat(F.lit("pp. "), page)), year.cast("string")
    ))
    return F.concat(F.array_join(parts, ", "), F.lit("."))


def good_for_citation(author: Column, journal: Column) -> Column:
    """Whether a record has what a short citation needs."""
    return F.coalesce(F.size(author) > 0, F.lit(False)) & (F.coalesce(F.trim(journal), F.lit("")) != "")
