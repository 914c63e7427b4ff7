"""Text and citation functions as column expressions; null in, null out unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns that mark a string as a citation rather than a note (fixed values).
YEAR = r"\b(?:17|18|19|20)\d{2}(?:\D|$)"
AUTHOR_YEAR = (r"\((?U:[\w\s])+, \d{4}\)", r"\((?U:[\w\s])+ \d+\)", r"\(\d{4}, (?U:[\w\s])+\)", r"\((?U:[\w\s])+ \d{4}\)")
OLD_ID = r"/\d{6,7}\b"
INITIALS_NAME = r"\b(?:[A-Z].?\s+)+[A-Z][a-z]+(?:\s?-?\s?[A-Z][a-z]+)*\b"
#: An arXiv id in running text; five digits are read too, which new ids have (fixed value).
ARXIV = r"arxiv:? *\s*(\d{4})\.(\d{4,5})(v\d+)?"
#: Effective tokens of a formula (fixed value).
TEX_TOKEN = r"\\[a-zA-Z]+\{[^}]*\}|\\[a-zA-Z]+|\w(?:_\{[^}]*\}|\^\{[^}]*\})?|[\w+-/*]"
#: Words that name what a number before which they stand refers to, in order of precedence (fixed values).
KINDS_BEFORE = {
    "Ref": "ref refs papers paper reference references",
    "Figure": "fig figures figs figure",
    "Table": "tab tables tabs table",
    "Section": "sec section",
    "Chapter": "chapter chapters chpt chpts",
    "Equation": "eq equ equation equations formula formulas",
}
#: Single words after which a citation reads as part of the sentence (fixed values).
PREPOSITIONS = (
    "at in on for with and see or nor about as by over against along among around before behind below beneath beside "
    "between beyond but concerning despite down during except inside into like near next off onto out outside over past "
    "since through throughout toward under underneath until up upon with within without"
).split()


def single_spaced(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends (L1)."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def formula_lines(c: Column) -> Column:
    """Each line of a formula without display commands and repeated blanks (L2)."""
    lines = F.transform(F.split(c, "\n"), lambda x: single_spaced(F.regexp_replace(x, r"\\displaystyle\b", "")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def formula_tokens(c: Column) -> Column:
    """Number of effective tokens of a formula (L3)."""
    return F.size(F.regexp_extract_all(c, F.lit(TEX_TOKEN), F.lit(0)))


def last_match(c: Column, pattern: str) -> Column:
    """Start of the last match of a pattern, from 0, or null (L4)."""
    before = F.regexp_extract(c, f"(?s)^(.*)(?:{pattern})", 1)
    return F.when(c.rlike(f"(?s){pattern}"), F.length(before))


def names_before(left: Column, label: Column, paper: Column, plain: bool = False) -> Column:
    """What the end of the left text calls a label: struct of left, label, hit."""
    if plain:
        return F.struct(left.alias("left"), label.alias("label"), F.lit(False).alias("hit"))
    cut = F.btrim(F.btrim(F.btrim(left), F.lit("._-:")))
    out = F.struct(left.alias("left"), label.alias("label"), F.lit(False).alias("hit"))
    for kind, words in reversed(KINDS_BEFORE.items()):
        end = rf"(?i)(^|[\s({{\[])(?:{'|'.join(words.split())})$"
        kept = F.regexp_replace(cut, end, "$1")
        kept = F.concat(kept, F.lit(" ")) if kind == "Ref" else kept
        named = F.concat(F.lit(f" [{kind}."), label, F.lit(" of "), paper, F.lit("]"))
        out = F.when(cut.rlike(end), F.struct(kept.alias("left"), named.alias("label"), F.lit(True).alias("hit"))).otherwise(out)
    return out


def without_brackets(left: Column, right: Column) -> Column:
    """One pair of brackets around a citation removed: struct of left, right."""
    a, b = F.coalesce(F.rtrim(left), F.lit("")), F.coalesce(F.ltrim(right), F.lit(""))
    pair = F.concat(F.right(a, F.lit(1)), F.left(b, F.lit(1))).isin("()", "[]", "{}")
    inner_a, inner_b = F.left(a, F.length(a) - 1), F.substring(b, F.lit(2), F.length(b))
    return F.struct(F.when(pair, inner_a).otherwise(a).alias("left"), F.when(pair, inner_b).otherwise(b).alias("right"))


def cited(left: Column, label: Column, right: Column, paper: Column, end: bool = True) -> Column:
    """A citation as it reads between its left and right text."""
    content = F.when(
        label.rlike("^<.*>$"), F.concat(F.lit("["), F.regexp_extract(label, "^<(.*)>$", 1), F.lit("]"))
    ).otherwise(F.concat(F.lit("[Ref."), label, F.lit(" of "), paper, F.lit("]")))
    before = F.btrim(F.coalesce(left, F.lit("")))
    word = F.element_at(F.split(before, r"\s+"), -1)
    open_ = (before == "") | before.rlike(r"[.!?;]$") | word.isin(PREPOSITIONS)
    out = F.when(open_, content).otherwise(F.concat(F.lit("(See "), content, F.lit(")")))
    if not end:
        return out
    after = F.btrim(F.coalesce(right, F.lit("")))
    return F.when((after == "") | after.rlike(r"^\p{Lu}"), F.concat(out, F.lit("."))).otherwise(out)


def has_year(c: Column) -> Column:
    """Whether a year from 1700 to 2099 stands in the text."""
    return c.rlike(YEAR)


def has_citation(c: Column) -> Column:
    """Whether an author-year citation in brackets stands in the text."""
    return c.rlike("|".join(AUTHOR_YEAR))


def named_people(c: Column) -> Column:
    """Initials with a surname in the text."""
    return F.regexp_extract_all(c, F.lit(INITIALS_NAME), F.lit(0))


def words(c: Column) -> Column:
    """Number of words between white space; none in a blank text."""
    t = F.btrim(F.regexp_replace(c, r"(?U)\s+", " "))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))


def is_note(c: Column) -> Column:
    """Whether a bibliography entry is a note: ten words or more and no mark of a citation."""
    mark = has_year(c) | has_citation(c) | c.rlike(OLD_ID) | c.rlike(INITIALS_NAME) | c.rlike("@|http|arXiv:")
    return ~mark & (words(c) >= 10)


def arxiv_id(c: Column) -> Column:
    """The first arXiv id in a text, bare, or null."""
    return F.nullif(F.regexp_extract(F.lower(c), r"arxiv:? *\s*(\d{4}\.\d{4,5}(?:v\d+)?)", 1), F.lit(""))


def normal(c: Column) -> Column:
    """Lower case, single blanks."""
    return single_spaced(F.lower(c))


def four_digits(c: Column) -> Column:
    """The first number of four digits, or null."""
    return F.nullif(F.regexp_extract(c, r"\b(\d{4})\b", 1), F.lit("")).try_cast("int")


def merged_authors(bib: Column) -> Column:
    """A BibTeX entry whose repeated author lines are one."""
    people = F.array_join(F.regexp_extract_all(bib, F.lit(r"author = \{(.*?)\}"), F.lit(1)), ", ")
    rest = F.regexp_replace(bib, r"author = \{.*?\},?\n\s*(?=(?s:.*)author = \{)", "")
    one = F.regexp_replace(rest, r"author = \{.*?\}", "\ufdd0")
    return F.when(F.contains(bib, F.lit("author")), F.replace(one, F.lit("\ufdd0"), F.concat(F.lit("author = {"), people, F.lit("}")))).otherwise(bib)


def shrunk_brackets(c: Column) -> Column:
    """Repeated square brackets as one."""
    return F.regexp_replace(F.regexp_replace(c, r"\[+", "["), r"\]+", "]")


def yymm(c: Column) -> Column:
    """The year and month that an id holds."""
    return F.nullif(F.regexp_extract(c, r"(\d{4})", 1), F.lit(""))
