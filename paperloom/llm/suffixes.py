"""Passages that the pages of a host share: a host suffix array, cut at the length of the shortest passage.

The pages of a host (the sections of a paper) are streams of tokens. Every position gets the rank
of its suffix by prefix doubling: the rank over 2k tokens is made from those over k tokens at the
position and k places on. Suffixes of one rank stand next to each other in the suffix array and
share at least RUN tokens, so a rank that two pages of a host have begins a passage that both
hold. Positions of such ranks, each with the RUN tokens that it begins, cover the passages; the
page that comes first keeps its copy, on the others they are removed.

Ranks are 64-bit hashes, so no sort in one place is needed: pages with a rank are aggregated with
map-side combine, and a passage on a third of all pages is no hot spot.

Defined results
---------------
* Null and empty paragraphs and arrays have no tokens. A null host is a host of its own page only.
* Rows repeated whole are one page. Pages shorter than RUN tokens share nothing.
* A passage that one page alone repeats stays. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import persist_table

#: Tokens that a shared passage has at least; a power of two, for ranks are doubled.
RUN = 8


def tokens(paragraphs: str | Column) -> Column:
    """The stream of a page: an array of paragraph, place in it, and token (white space parts tokens)."""
    def of(text: Column, para: Column) -> Column:
        words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
        return F.transform(words, lambda w, i: F.struct(para.alias("para"), i.alias("at"), w.alias("word")))

    return F.flatten(F.transform(paragraphs, of))


def _doubled_by(k: int):  # noqa: ANN202
    """A function from ranks over k tokens to those over 2k; one entry for each position that has so many tokens left."""
    def run(ranks: Column) -> Column:
        return _doubled(ranks, k)

    return run


def _doubled(ranks: Column, k: int) -> Column:
    n = F.size(ranks)
    pairs = F.arrays_zip(F.slice(ranks, F.lit(1), F.greatest(n - k, F.lit(0))).alias("a"), F.slice(ranks, F.lit(k + 1), F.greatest(n - k, F.lit(0))).alias("b"))
    return F.transform(pairs, lambda p: F.xxhash64(p["a"], p["b"]))


def suffix_ranks(stream: Column, run: int = RUN) -> Column:
    """The rank of each suffix over its first ``run`` tokens, by position."""
    ranks, k = F.transform(stream, lambda t: F.xxhash64(t["word"])), 1
    while k < run:
        ranks, k = F.get(F.transform(F.array(ranks), _doubled_by(k)), F.lit(0)), 2 * k
    return ranks


def pages(sections: DataFrame, host: str = "paper_id", page: str = "section_id", text: str = "section_content") -> DataFrame:
    """Each page once, with its stream and the ranks of its suffixes: host, page, stream, ranks."""
    own = F.coalesce(F.col(host), F.concat(F.lit("page "), F.col(page).cast("string")))
    rows = sections.select(own.alias("host"), F.col(page).alias("page"), F.col(text).alias("text")).where(F.size("text") > 0)
    streams = rows.groupBy("host", "page", F.xxhash64("text").alias("_h")).agg(F.first("text").alias("text")).select("host", "page", tokens("text").alias("stream"))
    return streams.where(F.size("stream") > 0).select("*", suffix_ranks(F.col("stream")).alias("ranks"))


def runs(sections: DataFrame, **columns: str) -> DataFrame:
    """Where passages stand that an earlier page of the host has: host, page, para, first, last (tokens of the paragraph).

    Neighbouring and overlapping positions are one run; a run over several paragraphs has a row for each.
    """
    placed = persist_table(pages(sections, **columns), "pages")
    each = placed.select("host", "page", F.posexplode("ranks").alias("pos", "rank"))
    shared = each.groupBy("host", "rank").agg(F.min("page").alias("owner"), F.max("page").alias("other")).where("owner < other")
    begun = each.join(shared.select("host", "rank", "owner"), ["host", "rank"]).where("page > owner").select("host", "page", "pos")
    starts = begun.groupBy("host", "page").agg(F.array_sort(F.collect_set("pos")).alias("starts"))  # at most a page's tokens
    covered = placed.join(starts, ["host", "page"]).select(
        "host", "page", "stream", F.explode(F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + RUN - 1))))).alias("pos")
    ).select("host", "page", "pos", F.get("stream", F.col("pos"))["para"].alias("para"), F.get("stream", F.col("pos"))["at"].alias("at"))
    island = F.col("at") - F.row_number().over(Window.partitionBy("host", "page", "para").orderBy("at"))
    return covered.withColumn("island", island).groupBy("host", "page", "para", "island").agg(F.min("at").alias("first"), F.max("at").alias("last")).drop("island")


def unique(sections: DataFrame, host: str = "paper_id", page: str = "section_id", text: str = "section_content") -> DataFrame:
    """Every paragraph without the passages that an earlier page of its host has: host, page, para, text.

    A paragraph that keeps all its tokens keeps its white space too; others have single blanks. The
    text is generated, so that the optimizer doesn't merge its nested lambdas into the argument of a
    Python function that is applied to it: there it can't evaluate them.
    """
    own = F.coalesce(F.col(host), F.concat(F.lit("page "), F.col(page).cast("string")))
    rows = sections.select(own.alias("host"), F.col(page).alias("page"), F.posexplode(text).alias("para", "text")).dropDuplicates(["host", "page", "para", "text"])
    cut = runs(sections, host=host, page=page, text=text).groupBy("host", "page", "para").agg(F.collect_list(F.struct("first", "last")).alias("cut"))
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")

    def kept(w: Column, i: Column) -> Column:
        return ~F.exists("cut", lambda c: i.between(c["first"], c["last"]))

    less = F.array_join(F.filter(words, kept), " ")
    left = F.when(F.col("cut").isNull(), F.col("text")).otherwise(less)
    return rows.join(cut, ["host", "page", "para"], "left").select("host", "page", "para", F.explode(F.array(left)).alias("text"))
