"""Markup residue in text: kinds of markup per paragraph, and clean text that keeps structure.

The kinds are a column expression over one paragraph and need no shuffle. Code and formulas are set
apart first; what they hold is no markup and is kept as it is. Marks that nest (LaTeX arguments,
wiki links and templates) are read by depth, the others by a grammar of patterns. Passages that
the sections of a paper share are found by :mod:`paperloom.llm.suffixes`; they can't tell markup
from text within a paragraph, so they do not decide the kinds (README has the figures).

The clean text writes headings as ``# x``, list items as ``- x``, code between fences, formulas
between dollar signs and table rows with ``|``; emphasis, links, templates, comments, footnote
marks and layout commands go, their words stay.

Defined results
---------------
* Null, empty and blank paragraphs have no kinds; the clean text of null is null, else "".
* Null and empty arrays have no paragraphs. Positions count every element, null ones too.
* Repeated rows give one row per distinct kind; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.nested import entities_udf, resolve_udf

#: Names of elements that count as tags (fixed values).
TAGS = (
    "a abbr article aside b big blockquote body br caption center cite code col dd del details div dl dt em "
    "figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li "
    "link main mark math menclose meta mfenced mfrac mi mn mo mover mpadded mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover nav noscript ol option p pre q ref s samp script section "
    "select semantics small source span strike strong style sub summary sup svg table tbody td template textarea "
    "tfoot th thead title tr tt u ul var video wbr"
).split()
_ATTR = r"""(?:\s+[\w:.-]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+)|\s+(?:hidden|checked|disabled|open|async|defer|controls))"""
TAG = rf"(?i:</?(?:{'|'.join(sorted(TAGS, key=len, reverse=True))}){_ATTR}*\s*/?>|</?[a-z]+:[a-z]+{_ATTR}*\s*/?>)"
ENTITY = r"&(?:[a-zA-Z][a-zA-Z0-9]{1,30}|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});"

#: Code and formulas, which are set apart before anything else is looked for.
FENCE = r"(?s:```.*?```)"
PRE = r"(?is:<pre\b[^>]*>.*?</pre>)"
#: Code that is never closed goes on to the end; for the kinds it is text.
OPEN_PRE = r"(?is:<pre\b[^>]*>.*?(?:</pre>|\z))"
VERBATIM = r"(?s:\\begin\{(?:verbatim|lstlisting)\}.*?\\end\{(?:verbatim|lstlisting)\})"
_DISPLAYED = r"(?:equation|align|alignat|gather|multline|flalign|eqnarray|displaymath|math|IEEEeqnarray|split)\*?"
EQUATION = rf"(?s:\\begin\{{{_DISPLAYED}\}}.*?\\end\{{{_DISPLAYED}\}}|\\\[.+?\\\]|\\\(.+?\\\))"
TICKS = r"`[^`\n]+`"
FORMULA = r"(?s:\$\$.+?\$\$)|(?<![\\$])\$(?![\s$])[^$\n]*?(?<![\s\\])\$(?![\d$])"

#: Patterns of each kind, over a paragraph without formulas and code (fixed values, alternatives of one pattern).
HTML = [r"(?s:<!--.*?(?:-->|$))", r"(?i:<!doctype[^>]*>)", TAG, ENTITY]
MARKDOWN = [
    r"```", TICKS,
    r"\*\*(?=\S)[^*\n]+(?<=\S)\*\*", r"(?<![\w*\\])\*(?![\s*])[^*\n]+(?<![\s*])\*(?![\w*])",
    r"(?<![\w\\_])__(?![\s_])(?![A-Z]{3,}__)[^_\n]+(?<!\s)__(?![\w_])", r"(?<![\w\\_])_(?![\s_])[^_\n]+(?<![\s_])_(?![\w_])",
    r"~~(?=\S)[^~\n]+~~",
    r"(?m:^ {0,3}#{1,6}[ \t]+\S)", r"(?m:^[^\s#>|=-][^\n]*\n(?:={3,}|-{3,})[ \t]*$)",
    r"(?m:^[ \t]*[-*+][ \t]+\S)", r"(?m:^[ \t]*\d{1,3}[.)][ \t]+\S[^\n]*\n[ \t]*\d{1,3}[.)][ \t]+\S)",
    r"!?\[[^\[\]\n]*\]\([^()\s]+(?:\s+\"[^\"]*\")?\)", r"(?m:^ {0,3}>[ \t]?\S)",
    r"(?m:^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\|[-:| \t]*$)", r"(?m:^[ \t]*\|[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|[ \t]*$)",
    r"\[\^[^\]\s]+\]",
]
WIKI = [
    r"'{2,5}(?=[^'\s])[^'\n]+'{2,5}", r"(?m:^={2,6}[ \t]*[^=\s][^=\n]*={2,6}[ \t]*$)", r"\[\[[^\[\]\n]+\]\]",
    r"\[https?://[^\s\]]+[ \t][^\]\n]+\]", r"\{\{(?!\\)[^{}]+\}\}", r"(?m:^\{\|)", r"(?m:^\|\})", r"(?m:^\|-{1,2}(?![-|])[^|\n]*$)",
    r"(?<!\w)__[A-Z]{3,}__(?!\w)", r"(?mi:^#redirect\b)",
]
LATEX = [
    r"(?<![\w:\\/.])\\[A-Za-z]{2,}", r"\\[A-Za-z]+\*?(?=[{\[])", r"\\[%&_#$\{\}]", r"\\\\(?=[\s\[]|$)",
    r"\\[\"'`^~=.](?:[A-Za-z]|\{|\\[ij])", r"\\[()\[\]]",
]
KINDS = {"html": HTML, "markdown": MARKDOWN, "wiki": WIKI, "latex": LATEX}


def _sub(x: Column, *pairs: tuple[str, str]) -> Column:
    for pattern, to in pairs:
        x = F.regexp_replace(x, F.lit(pattern), F.lit(to))
    return x


def plain_of_code(text: Column) -> Column:
    """A paragraph in which the content of code and the formulas are blanked, the marks of code kept."""
    return _sub(
        text,
        (FENCE, "```\n```"), (PRE, "<pre></pre>"), (VERBATIM, r"\\begin{verbatim}"), (TICKS, "`x`"), (FORMULA, " "),
    )


def kinds(text: Column) -> Column:
    """The kinds of markup in a paragraph: an array without nulls, empty where there are none."""
    x = plain_of_code(text)
    # Every kind needs one of a few signs; most paragraphs have none, and skip the patterns.
    marked = F.coalesce(x.rlike(r"[<>&*_`~#|\[\]\\'{}=]|(?m:^[ \t]*(?:[-+]|\d{1,3}[.)])[ \t])|---"), F.lit(False))
    found = F.array_compact(F.array(*(F.when(x.rlike("|".join(p)), F.lit(k)) for k, p in KINDS.items())))
    return F.when(marked, found).otherwise(F.array().cast("array<string>"))


def _clean_text(x: Column) -> Column:
    """Text outside code and formulas: all markup resolved to words and structure."""
    x = _sub(  # html
        x,
        (r"(?s)<!--.*?(?:-->|$)", ""), (r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", ""), (r"(?i)<!doctype[^>]*>", ""),
        (r"(?is)<h[1-6]\b[^>]*>\s*(.*?)\s*</h[1-6]\s*>", "\n# $1\n"), (r"(?i)\s*<li\b[^>]*>\s*", "\n- "),
        (r"(?i)\s*<dt\b[^>]*>\s*", "\n- "), (r"(?i)\s*<dd\b[^>]*>\s*", ": "), (r"(?i)<(?:br|hr)\s*/?>", "\n"),
        (r"(?i)<img\b[^>]*\balt\s*=\s*[\"']?([^\"'>\s]+)[^>]*>", "$1"),
        (r"(?i)</(?:td|th)>\s*<(?:td|th)\b[^>]*>", " | "), (r"(?i)<tr\b[^>]*>\s*<t[dh]\b[^>]*>", "\n| "),
        (r"(?i)</t[dh]>\s*(?:</tr>)?", " |"), (r"(?i)<t[dh]\b[^>]*>", "| "),
        (r"(?i)</?(?:p|div|ul|ol|dl|table|tbody|thead|figure|figcaption|section|blockquote)\b[^>]*>", "\n"), (TAG, ""),
    )
    x = _sub(  # wiki
        x,
        (r"(?mi)^#redirect\s*\[\[([^\]]*)\]\]", "$1"), (r"(?<!\w)__[A-Z]{3,}__(?!\w)", ""),
        (r"\[https?://\S+\s([^\]\n]+)\]", "$1"),
        (r"(?m)^={2}[ \t]*([^=\n]*[^=\s])[ \t]*={2}[ \t]*$", "# $1"), (r"(?m)^={3,6}[ \t]*([^=\n]*[^=\s])[ \t]*={3,6}[ \t]*$", "## $1"),
        (r"'{2,5}(?=[^'\s])([^'\n]+)'{2,5}", "$1"), (r"(?m)^\{\|[^\n]*\n?", ""), (r"(?m)^\|\}", ""), (r"(?m)^\|-[^\n]*\n?", ""),
        (r"(?m)^!(?!\[)[ \t]*([^\n]*)$", "| $1 |"), (r"(?m)^\|[ \t]*([^|\n]+)$", "| $1 |"), (r"(?m)^;[ \t]*(\S[^:\n]*):[ \t]*", "- $1: "),
    )
    x = _sub(  # Markdown
        x,
        (r"!\[([^\[\]\n]*)\]\([^()\n]*\)", "$1"), (r"\[([^\[\]\n]+)\]\([^()\n]*\)", "$1"),
        (r"(?m)^\[\^[^\]\s]+\]:[ \t]*", ""), (r"\[\^[^\]\s]+\]", ""),
        (r"(?m)^([^\s#>|=-][^\n]*)\n={3,}[ \t]*$", "# $1"), (r"(?m)^([^\s#>|=-][^\n]*)\n-{3,}[ \t]*$", "## $1"),
        (r"\*\*(?=\S)([^*\n]+)\*\*", "$1"), (r"(?<![\w*])\*(?![\s*])([^*\n]+)(?<![\s*])\*(?![\w*])", "$1"),
        (r"(?<![\w_])__(?![\s_])([^_\n]+)__(?![\w_])", "$1"), (r"(?<![\w_])_(?![\s_])([^_\n]+)(?<!\s)_(?![\w_])", "$1"),
        (r"~~(?=\S)([^~\n]+)~~", "$1"), (r"(?m)^ {0,3}>[ \t]?", ""), (r"(?m)^([ \t]*)[*+][ \t]+", "$1- "),
        (r"(?m)^([ \t]*)-[ \t]+\[[ xX]\][ \t]+", "$1- "), (r"(?m)^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\|[-:| \t]*$\n?", ""),
        (r"(?m)^(#{1,6})[ \t]+", "$1 "),
    )
    return x


def _clean_apart(x: Column) -> Column:
    """Code between fences, formulas as they are."""
    code = _sub(
        x,
        (r"(?is)^<pre\b[^>]*>\s*(?:<code\b[^>]*>)?", "\n```\n"), (r"(?is)(?:</code>)?\s*</pre>$", "\n```\n"), (r"(?is)^(\n```\n.*[^`\n])\s*\z", "$1\n```\n"),
        (r"^\\begin\{(?:verbatim|lstlisting)\}\s*", "\n```\n"), (r"\s*\\end\{(?:verbatim|lstlisting)\}$", "\n```\n"),
    )
    code = _sub(
        code,
        (rf"^\\begin\{{{_DISPLAYED}\}}\s*", "\n\\$\\$"), (rf"\s*(?:\\label\{{[^{{}}]*\}}\s*)?\\end\{{{_DISPLAYED}\}}$", "\\$\\$\n"),
        (r"(?s)^\\\[\s*(.*?)\s*\\\]$", "\\$\\$$1\\$\\$"), (r"(?s)^\\\(\s*(.*?)\s*\\\)$", "\\$$1\\$"),
    )
    return F.when(x.startswith("$") | x.startswith("`"), x).otherwise(code)


#: A noncharacter that parts code and formulas from other text.
APART = "\ufdd0"


def clean(text: Column) -> Column:
    """Clean text of a paragraph, with headings, lists, code blocks, tables and formulas kept."""
    apart = f"{FENCE}|{OPEN_PRE}|{VERBATIM}|{EQUATION}|{TICKS}|{FORMULA}"

    def parted(x: Column, change, other) -> Column:  # noqa: ANN001
        marked = F.regexp_replace(F.replace(x, F.lit(APART), F.lit("\ufffd")), F.lit(f"({apart})"), F.lit(f"{APART}$1{APART}"))
        return F.array_join(F.transform(F.split(marked, APART), lambda s, i: F.when(i % 2 == 1, other(s)).otherwise(change(s))), "")

    plain = parted(resolve_udf(apart)(text), _clean_text, _clean_apart)
    return F.btrim(_sub(entities_udf(apart)(plain), (r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n")), F.lit(" \t\r\n"))


def paragraphs(sections: DataFrame, id_col: str = "section_id", text_col: str = "section_content") -> DataFrame:
    """One row per paragraph: section_id, para_pos (from 0, nulls counted), text."""
    return sections.select(F.col(id_col).alias("section_id"), F.posexplode(text_col).alias("para_pos", "text"))


def residue(sections: DataFrame) -> DataFrame:
    """One distinct row per paragraph and kind of markup in it: section_id, para_pos, kind."""
    found = paragraphs(sections).select("section_id", "para_pos", F.explode(kinds(F.col("text"))).alias("kind"))
    return found.distinct()


def cleaned(sections: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every paragraph with its clean text: section_id, para_pos, clean; whole-row duplicates once."""
    rows = paragraphs(sections).dropDuplicates(["section_id", "para_pos", "text"])
    return rows.select("section_id", "para_pos", *keep, clean(F.col("text")).alias("clean"))
