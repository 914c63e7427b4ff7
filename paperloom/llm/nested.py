"""Markup whose arguments nest: LaTeX commands, wiki links and templates, read by depth in one pass."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
import regex
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Commands whose argument stays as text, by number of arguments before it that go (fixed values).
WRAPPERS = {
    **dict.fromkeys("emph textbf textit texttt textsc textrm textsf textsl textup text mbox hbox underline title caption url mathrm author enquote path uppercase ensuremath".split(), 0),
    "textcolor": 1, "color": 1, "href": 1, "parbox": 1, "raisebox": 1,
}
HEADINGS = {"part": "#", "chapter": "#", "section": "#", "subsection": "##", "subsubsection": "##", "paragraph": "##", "subparagraph": "##"}
#: Commands that point at something, written as their keys in square brackets (fixed values).
POINTERS = frozenset("cite citep citet citealp citeauthor citeyear ref eqref cref Cref autoref pageref nocite".split())
#: Commands that go with their arguments, and layout commands that take none (fixed values).
GONE = frozenset("label hspace vspace index bibliographystyle bibliography input include includegraphics usepackage documentclass pagestyle thispagestyle setlength addtolength vskip hskip footnotemark".split())
LAYOUT = frozenset(
    "noindent indent newpage clearpage cleardoublepage centering raggedright raggedleft maketitle hline cline toprule midrule bottomrule par bigskip medskip smallskip "
    "small footnotesize scriptsize tiny large Large LARGE huge Huge normalsize it bf em sc tt rm sl sf itshape bfseries scshape ttfamily rmfamily sffamily upshape mdseries "
    "linebreak pagebreak newline tableofcontents appendix quad qquad hfill vfill protect relax left right displaystyle textstyle limits nolimits".split()
)
#: Commands that are signs or words of text (fixed values).
SIGNS = {
    "ldots": "…", "dots": "…", "LaTeX": "LaTeX", "TeX": "TeX", "BibTeX": "BibTeX", "textendash": "–", "textemdash": "—", "textbackslash": "\\", "textasciitilde": "~",
    "textquoteleft": "‘", "textquoteright": "’", "textquotedblleft": "“", "textquotedblright": "”", "S": "§", "P": "¶", "copyright": "©", "pounds": "£", "ss": "ß",
    "ae": "æ", "AE": "Æ", "oe": "œ", "OE": "Œ", "aa": "å", "AA": "Å", "o": "ø", "O": "Ø", "l": "ł", "L": "Ł", "i": "ı", "j": "ȷ", "slash": "/", "and": ",",
}
#: Combining signs of the accent commands (fixed values).
ACCENTS = {
    '"': "\u0308", "'": "\u0301", "`": "\u0300", "^": "\u0302", "~": "\u0303", "=": "\u0304", ".": "\u0307",
    "u": "\u0306", "v": "\u030c", "H": "\u030b", "c": "\u0327", "k": "\u0328", "r": "\u030a", "d": "\u0323", "b": "\u0331",
}
_ESCAPED = "%&_#${}"
_COMMAND = regex.compile(r"\\([A-Za-z]+\*?|.)", regex.S)
_NEXT = regex.compile(r"\\|\{(?=\\)")
_BREAK = regex.compile(r"(?:\[[^\]\n]*\])?[ \t]*(?:\\hline)?")
_LETTER = regex.compile(r"\s*(?:\{\s*\\?([A-Za-z])\}|\\?([A-Za-z]))")
_FORMULA = regex.compile(r"[dtc]?frac|binom|sqrt|over\w+|hat|bar|vec|tilde|dot|ddot|math\w+|sum|prod|int|lim|sup|inf|max|min|log|exp|operatorname")
_BLANKS, _ANY_BLANKS = regex.compile(r"[ \t]*"), regex.compile(r"\s*")
_TABULAR = ("tabular", "tabular*", "array", "longtable", "tabularx")
_PUNCTUATION = {"(": "$", ")": "$", "[": "$$", "]": "$$", ",": " ", ";": " ", ":": " ", "!": "", " ": " ", "-": ""}


def _pairs(text: str) -> dict[int, int]:
    """The place of the closing sign of each brace and bracket that has one; escaped ones are text."""
    out: dict[int, int] = {}
    held: dict[str, list[int]] = {"{": [], "[": []}
    for m in regex.finditer(r"\\.|[{}\[\]]", text, flags=regex.S):
        c = m[0]
        if c in held:
            held[c].append(m.start())
        elif c in "}]" and held[opener := "{" if c == "}" else "["]:
            out[held[opener].pop()] = m.start()
    return out


def latex(text: str) -> str:
    """Text whose LaTeX commands are resolved to words, structure and formulas; linear, however deep they nest."""
    closing = _pairs(text)
    out: list[str] = [""]
    stack: list[tuple[int, int, str]] = [(0, len(text), "")]  # what is still to be read: from, to, what to put after it

    def sign(at: int, end: int) -> str:
        return text[at] if at < end else ""

    def groups(at: int, end: int, opener: str, most: int = 9) -> tuple[list[tuple[int, int]], int]:
        found = []
        while len(found) < most and sign(at, end) == opener and closing.get(at, end) < end:
            found.append((at + 1, closing[at]))
            at = closing[at] + 1
        return found, at

    while stack:
        at, end, after = stack.pop()
        while at < end:
            m = _NEXT.search(text, at, end)
            if not m:
                out.append(text[at:end])
                at = end
                break
            cut = m.start()
            out.append(text[at:cut])
            if m[0] == "{":
                at = cut + 1
                if closing.get(cut, end) < end:  # a group that begins with a command
                    stack += [(closing[cut] + 1, end, after)]
                    end, after = closing[cut], ""
                else:
                    out.append("{")
                continue
            c = _COMMAND.match(text, cut, end)
            if not c:
                out.append("\\")
                at = cut + 1
                continue
            name, at = c[1].rstrip("*"), c.end()
            before = text[cut - 1] if cut else ""
            if name in _ESCAPED:
                out.append(name)
            elif name == "\\":
                at = _BREAK.match(text, at, end).end()
                out[-1] = out[-1].rstrip(" \t")
                out.append(" |")
            elif name in ACCENTS and (not name.isalpha() or sign(at, end) in ("{", " ")) and (x := _LETTER.match(text, at, end)):
                out.append(unicodedata.normalize("NFC", (x[1] or x[2]) + ACCENTS[name]))
                at = x.end()
            elif not name[:1].isalpha():
                out.append(_PUNCTUATION.get(name, name))
            elif before in tuple(":/\\.") and before or before.isalnum() and name not in SIGNS and sign(at, end) not in ("{", "["):
                out.append(c[0])  # part of a path, no command
            elif name == "item":
                out[-1] = out[-1].rstrip()
                out.append("\n- ")
                at = _ANY_BLANKS.match(text, at, end).end()
            elif name in SIGNS:
                out.append(SIGNS[name])
                at += sign(at, end) == " " and sign(at + 1, end).isalpha() and SIGNS[name].isalpha() and len(SIGNS[name]) < 3
            elif name in LAYOUT:
                at = _BLANKS.match(text, at, end).end()
            else:
                at = groups(at, end, "[")[1]
                one = WRAPPERS[name] + 1 if name in WRAPPERS else 1 if name in HEADINGS or name == "footnote" else 9
                args, at = groups(at, end, "{", one)
                if name in POINTERS and args:
                    out[-1] = out[-1].rstrip(" ~")
                    out.append(f" [{text[slice(*args[-1])]}]")
                elif name in ("begin", "end"):
                    if args and text[slice(*args[0])] in _TABULAR:
                        out[-1] = out[-1].rstrip()
                elif name in GONE:
                    at = _BLANKS.match(text, at, end).end()
                elif args and _FORMULA.fullmatch(name):
                    out.append(f"${text[cut:at]}$")
                elif args:  # what a wrapper, a heading, a note or an unknown command holds is text
                    lead, tail = (f"\n{HEADINGS[name]} ", "\n") if name in HEADINGS else (" (", ")") if name == "footnote" else ("", "")
                    out.append(lead)
                    stack.append((at, end, after))
                    kept = args[-1:] if name in WRAPPERS else args
                    stack += [(a, b, tail if i == 0 else " ") for i, (a, b) in enumerate(reversed(kept))][:-1] if len(kept) > 1 else []
                    at, end = kept[0]
                    after = tail if len(kept) == 1 else " "
                elif sign(at, end) in ("{", "["):  # an argument that never closes
                    out.append(c[0])
                else:  # an unknown sign is a formula
                    out.append(f"${c[0]}$")
        out.append(after)
    return "".join(out)


_LINK = regex.compile(r"\[\[|\]\]|\{\{(?!\\)|\}\}")


def wiki(text: str) -> str:
    """Text whose wiki links are their labels and whose templates go, however they nest. Unclosed ones stay."""
    opened: list[tuple[str, list[str]]] = [("", [])]
    at = 0
    for m in _LINK.finditer(text):
        opened[-1][1].append(text[at : m.start()])
        at = m.end()
        if m[0] in ("[[", "{{"):
            opened.append((m[0], []))
        elif len(opened) > 1 and (opened[-1][0], m[0]) in (("[[", "]]"), ("{{", "}}")):
            kind, parts = opened.pop()
            inner = "".join(parts)
            opened[-1][1].append(_link(inner) if kind == "[[" else _template(inner))
        else:
            opened[-1][1].append(m[0])
    opened[-1][1].append(text[at:])
    while len(opened) > 1:
        kind, parts = opened.pop()
        opened[-1][1].append(kind + "".join(parts))
    return "".join(opened[0][1])


def _link(inner: str) -> str:
    target, bar, label = inner.partition("|")
    if regex.match(r"(?i)\s*(?:file|image):", target):
        return inner.rpartition("|")[2] if bar else ""
    if regex.match(r"(?i)\s*category:", target):
        return ""
    return label if bar else target.lstrip(":")


def _template(inner: str) -> str:
    """A number with its unit is its value, marks of citations stay, other templates go."""
    if regex.match(r"\s*(?:cite|figure|table|formula)\s*:", inner):
        return "{{" + inner + "}}"
    name, *args = inner.split("|")
    if name.strip().lower() not in ("val", "convert", "nowrap"):
        return ""
    return " ".join(x for a in args for x in [a.partition("=")[2] if "=" in a else a] if x)


def entities(text: str) -> str:
    """Text with all character references of HTML resolved."""
    return regex.sub(r"&(?:[a-zA-Z][a-zA-Z0-9]{1,30}|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});", lambda m: html.unescape(m[0]), text)


def outside(apart: str, change) -> object:  # noqa: ANN001
    """``change`` applied to what stands outside of code and formulas, which ``apart`` finds."""
    pattern = regex.compile(apart.replace("\\z", "\\Z"))

    def run(text: str) -> str:
        out, at = [], 0
        for m in pattern.finditer(text):
            out += [change(text[at : m.start()]), m[0]]
            at = m.end()
        return "".join([*out, change(text[at:])])

    return run


def resolve_udf(apart: str):  # noqa: ANN201
    """A vectorised function that resolves nesting markup outside code and formulas; null stays null."""
    def change(text: str) -> str:
        if "[[" in text or "{{" in text:
            text = wiki(text)
        return latex(text) if "\\" in text else text

    resolve = outside(apart, change)

    @F.pandas_udf(StringType())
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([resolve(t) if t is not None and ("\\" in t or "[[" in t or "{{" in t) else t for t in text], dtype=object)

    return run


def entities_udf(apart: str):  # noqa: ANN201
    """A vectorised function that resolves character references outside code and formulas; null stays null."""
    resolve = outside(apart, entities)

    @F.pandas_udf(StringType())
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([resolve(t) if t is not None and "&" in t else t for t in text], dtype=object)

    return run
