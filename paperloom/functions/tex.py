"""TeX sources: file classes, comments, braces, packages, preamble and bibliography commands."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Beginnings of the commands kept in a preamble (fixed values).
KEPT_COMMANDS = (
    "input def Declare define abstract newcommand let usepackage documentstyle eqnobysec newenvironment newtheorem "
    "providecommand subtitle renewcommand addbibresource bibliography documentclass title global"
).split()
#: Commands that a class gets in place of one that cannot be compiled (fixed value).
PLAIN_CLASS = "\\documentclass[amsmath,amssymb,color,hyperref,cite]{revtex4-1}"
#: Old packages and their successors (fixed values).
RENAMED = {"amssym": "amssymb", "subeqnar": "subeqnarray"}
#: Marks of drawings in the source (fixed values).
DRAWING_FLAGS = ("tikz-cd", "sty_jtana_tikzit", "auxTikzDefs", "tikzit", "tikz-timing", "tikzpicture")


def file_class(name: Column) -> Column:
    """hard (``.tex``), soft (no suffix, or text-like), component (style, class, bibliography), or other."""
    low = F.lower(name)
    return (
        F.when(low.rlike(r"\.tex$"), F.lit("hard"))
        .when(low.rlike(r"\.(?:sty|cls|bst|bbl|bib|clo|def|fd|cfg)$"), F.lit("component"))
        .when(~low.rlike(r"\.[a-z0-9]+$") | low.rlike(r"\.(?:latex|ltx|txt)$"), F.lit("soft"))
        .otherwise(F.lit("other"))
    )


def plain_name(name: Column, modes: Sequence[str]) -> Column:
    """A file name without the mark of a standardisation mode (D3)."""
    return F.regexp_replace(name, rf"(?i)\.(?:{'|'.join(map(regex.escape, modes))})(\.tex)$", "$1")


def before_analysis(path: Column) -> Column:
    """The folder before an ``analysis.*`` part of a path, or null."""
    return F.nullif(F.regexp_extract(path, r"^(.*?)/+analysis\.[^/]*/", 1), F.lit(""))


def with_suffix(name: Column, suffix: str) -> Column:
    """A name that ends with a suffix."""
    return F.when(name.endswith(suffix), name).otherwise(F.concat(name, F.lit(suffix)))


def uncommented(text: Column) -> Column:
    """Source without comments; a line that was nothing but a comment goes."""
    return F.regexp_replace(F.regexp_replace(text, r"(?m)^[ \t]*%.*(?:\r?\n|$)", ""), r"(?m)(?<!\\)%.*$", "")


def has_drawing(text: Column) -> Column:
    """HasTIKZ, NoTIKZ, or NoSource for null."""
    flags = [F.contains(text, F.lit(f)) for f in DRAWING_FLAGS]
    hit = flags[0]
    for f in flags[1:]:
        hit = hit | f
    return F.when(text.isNull(), "NoSource").when(hit, "HasTIKZ").otherwise("NoTIKZ")


def renamed_packages(text: Column) -> Column:
    """Old packages replaced by their successors."""
    for old, new in RENAMED.items():
        text = F.regexp_replace(text, rf"(\\usepackage(?:\[[^\]]*\])?\{{){old}(\}})", f"$1{new}$2")
    return text


def bibliography_names(text: Column) -> Column:
    """File names of the first bibliography command; empty where there is none (H1)."""
    body = F.regexp_extract(text, r"\\bibliography\s*\{([^}]*)\}", 1)
    return F.filter(F.transform(F.split(body, ","), lambda x: F.trim(x)), lambda x: x != "")


def cited_keys(text: Column) -> Column:
    """Keys of all cite commands, in order (H2)."""
    bodies = F.regexp_extract_all(text, F.lit(r"\\cite[a-zA-Z]*\*?(?:\[[^\]]*\])*\{([^}]*)\}"), F.lit(1))
    return F.filter(F.flatten(F.transform(bodies, lambda b: F.transform(F.split(b, ","), lambda x: F.trim(x)))), lambda x: x != "")


def bib_items(bbl: Column) -> Column:
    """Entries of a ``.bbl`` text: array of label, key, content (H3)."""
    pattern = r"(?s)\\bibitem\s*(?:\[((?:[^\[\]]|\[[^\]]*\])*)\])?\s*\{([^}]*)\}(.*?)(?=\\bibitem|\\end\{thebibliography\}|\z)"
    label, key, content = (F.regexp_extract_all(bbl, F.lit(pattern), F.lit(i)) for i in (1, 2, 3))
    return F.transform(
        F.arrays_zip(label.alias("label"), key.alias("key"), content.alias("content")),
        lambda z: F.struct(
            F.nullif(z["label"], F.lit("")).alias("label"), F.trim(z["key"]).alias("key"),
            F.trim(F.regexp_replace(z["content"], r"\s+", " ")).alias("content"),
        ),
    )


def plain_entry(content: Column) -> Column:
    """A bibliography entry as plain text (H4)."""
    for pattern, to in (
        (r"\\(?:newblock|bibinfo|bibfield|bibnamefont|bibfnamefont|natexlab|eprint|href@?noop?)\b", " "),
        (r"\\(?:emph|textit|textbf|texttt|text|url|enquote)\s*\{([^{}]*)\}", "$1"),
        (r"\{\\(?:it|bf|em|sl|sc|tt|rm)\s+([^{}]*)\}", "$1"), (r"NoStop\s", ""), (r"<[^<>]*>", ""), (r"\\[a-zA-Z]+\s*", ""), (r"[{}~]", " "),
        (r"\s+", " "),
    ):
        content = F.regexp_replace(content, pattern, to)
    return F.trim(content)


def braces(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the outermost pairs of braces; escaped braces count as text."""
    depth = start = i = 0
    while i < len(text):
        c = text[i]
        if c == "\\":
            i += 2
            continue
        if c == "{":
            if not depth:
                start = i
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if not depth:
                yield start, i + 1
        i += 1


def chunks(block: str) -> Iterator[tuple[str, str]]:
    """A preamble as (command, source) chunks, each with its balanced arguments; text outside has no command."""
    at = 0
    while at < len(block):
        m = regex.compile(r"\\([A-Za-z@]+)\*?").search(block, at)
        if not m:
            yield "", block[at:]
            return
        if m.start() > at:
            yield "", block[at : m.start()]
        end = regex.compile(r"(?:\\[A-Za-z@]+)?").match(block, m.end()).end()  # a command may be an argument
        while True:
            more = regex.compile(r"[ \t]*(\[[^\]]*\]|(?=\{))").match(block, end)
            if not more:
                break
            end = more.end()
            if block[end : end + 1] == "{":
                span = next(braces(block[end:]), None)
                if span is None:
                    end = len(block)
                    break
                end += span[1]
        yield m[1], block[m.start() : end]
        at = end


def comment_out(block: str, kept: frozenset[str], reverse: bool = False) -> str:
    """A preamble whose commands that don't begin as one in ``kept`` (or do, if ``reverse``) are comments."""
    out = []
    for command, source in chunks(block):
        drop = command and command.startswith(tuple(kept)) == reverse
        out.append("\n".join("%" + x for x in source.split("\n")) + "\n" if drop else source)
    return "".join(out)


def without_packages(text: str, banned: frozenset[str]) -> tuple[str, list[str]]:
    """Source whose package lists lack the banned ones, and those removed."""
    removed: list[str] = []

    def one(m: regex.Match) -> str:
        names = [x.strip() for x in m[2].split(",")]
        removed.extend(x for x in names if x in banned)
        left = [x for x in names if x and x not in banned]
        return f"\\usepackage{m[1] or ''}{{{','.join(left)}}}" if left else ""

    return regex.sub(r"\\usepackage(\[[^\]]*\])?\{([^}]*)\}", one, text), removed


def captions_only(text: str, kinds: Sequence[str]) -> str:
    """Environments of some kinds as comments, their captions and labels kept after them."""

    def one(m: regex.Match) -> str:
        kept = [m[0][c.start() : c.start() + (next(braces(m[0][c.start() :]), (0, 0))[1])] for c in regex.finditer(r"\\caption(?:\[[^\]]*\])?(?=\{)", m[0])]
        kept += regex.findall(r"\\label\{[^}]*\}", "".join(x for x in [m[0]]))
        body = "\n".join("%" + x for x in m[0].split("\n"))
        return "\n".join([body, *dict.fromkeys(kept)])

    return regex.sub(rf"(?s)\\begin\{{({'|'.join(kinds)})\*?\}}.*?\\end\{{\1\*?\}}", one, text)


def split_preamble(block: str, kept: frozenset[str] = frozenset(KEPT_COMMANDS)) -> tuple[str, str]:
    """A preamble parted into what is kept and the commands taken out."""
    parts = [(command and not command.startswith(tuple(kept)), source) for command, source in chunks(block)]
    return "".join(x for out, x in parts if not out), "\n".join(x for out, x in parts if out)


def without_affiliations(text: str) -> str:
    """Commands between the start of the document and its first section or abstract as comments."""
    head, begin, rest = text.partition("\\begin{document}")
    m = regex.search(r"\\section\b|\\begin\{abstract\}|\\abstract\b", rest)
    if not begin or not m:
        return text
    return head + begin + comment_out(rest[: m.start()], frozenset(KEPT_COMMANDS)) + rest[m.start() :]


def plain_class(text: str) -> str:
    """A document of a class that compiles anywhere, its bibliography named by the plain command."""
    text = regex.sub(r"\\document(?:class|style)(?:\[[^\]]*\])?\{[^}]*\}", lambda m: f"% {m[0]}\n{PLAIN_CLASS}", text)
    named = regex.findall(r"\\addbibresource\{(.+?)\.bib\}", text)
    text = regex.sub(r"\\addbibresource\{.+?\.bib\}", "", text)
    if named:
        text = text.replace("\\end{document}", f"\\bibliography{{{named[-1]}}}\n\\end{{document}}", 1)
    return regex.sub(r"\\(?:printbibliography|appendixpage).*", "", text)


#: Modes: whether the class is replaced, and whether all packages are comments rather than the banned ones alone (fixed values).
MODES = {"clean": (False, False), "revtex": (True, False), "nopackage": (True, True), "clean_beta": (False, False), "revtex_beta": (True, False)}


def standardised(text: str, mode: str, banned: frozenset[str]) -> tuple[str, list[str]]:
    """A source as a mode of :data:`MODES` wants it, with the packages removed.

    Comments and preamble commands go, figures and tables keep caption and label only. Banned packages
    go, or all of them become comments; a class that needs biblatex is replaced in every mode.
    """
    force, bare = MODES[mode]
    text = regex.sub(r"(?m)(?<!\\)%.*$", "", text)
    head, begin, body = text.partition("\\begin{document}")
    text = (comment_out(head, frozenset(KEPT_COMMANDS)) if begin else head) + begin + body
    removed: list[str] = []
    if bare:
        text = regex.sub(r"(?<!% )\\usepackage(?:\[[^\]]*\])?\{[^}]*\}", lambda m: f"% {m[0]}", text)
    else:
        text, removed = without_packages(text, banned)
    if force or "biblatex" in removed:
        text = plain_class(text)
    if "CJK" in removed:
        text = regex.sub(r"\\(?:begin|end)\{CJK\*?\}", lambda m: f"% {m[0]}", text)
    text = regex.sub(r"\\(?:begin|end)\{opening\}", lambda m: f"% {m[0]}", text)
    text = without_affiliations(text)
    return captions_only(captions_only(text, ["figure", "wrapfigure"]), ["table"]), removed


def seek_class(text: Column) -> Column:
    """Options and name of the document class (the class mode of E10)."""
    pattern = r"\\documentclass\[(.*?)\]\{(.*?)\}"
    options = F.transform(F.split(F.regexp_extract(text, pattern, 1), ","), lambda x: F.trim(x))
    return F.struct(options.alias("options"), F.trim(F.regexp_extract(text, pattern, 2)).alias("name"))


def repointed(text: Column, root: Column) -> Column:
    """A source whose bibliography command names its own root; put before the end where there is none (H7)."""
    own = F.concat(F.lit("\\bibliography{"), root, F.lit("}"))
    named, end = r"\\bibliography\{[^}]*\}", r"\\end\{document\}"
    safe = F.concat(F.lit("\\\\bibliography\\{"), F.regexp_replace(root, r"([\\$])", r"\\$1"), F.lit("\\}"))
    put = F.regexp_replace(text, F.lit(named), safe)
    added = F.concat(F.substring_index(text, "\\end{document}", 1), own, F.lit("\n\\end{document}"))
    return F.when(text.rlike(named), put).when(text.rlike(end), added).otherwise(text)


def standardise_udf(mode: str, banned: Iterable[str] = ()):  # noqa: ANN201
    """A vectorised function: source to struct of text and removed packages; null stays null."""
    words = frozenset(banned)

    @F.pandas_udf("text string, removed array<string>")
    def run(source: pd.Series) -> pd.DataFrame:
        done = [(None, []) if x is None else standardised(x, mode, words) for x in source]
        return pd.DataFrame(done, columns=["text", "removed"])

    return run
