"""Converted papers: LaTeXML XML and its HTML to flat blocks, references, labels and media.

A document is parsed once per row into a tree and taken apart in a fixed order: notes,
bibliography, figures, tables and floats, equations, labels; then citations and references in
the text are written out, and what is left becomes blocks in reading order. All of it is one
Arrow function that never fails: what goes wrong becomes the status of the row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import functions as F

from paperloom.functions.text import PREPOSITIONS

PAPER = (
    "status string, error string, title string, abstract string, acknowledge string, author array<string>, "
    "blocks array<struct<path:array<int>,level:int,title:string,kind:string,text:string>>, "
    "references array<struct<pos:int,key:string,tag:string,text:string,is_note:boolean>>, "
    "labels map<string,struct<type:string,label:string>>, media map<string,struct<kind:string,caption:string,source:string>>, "
    "cited map<string,int>, missing array<string>"
)
#: Smaller documents hold nothing (fixed value).
LEAST_BYTES = 100
#: Citations of a note beyond which a soft one stays a reference (fixed value).
MOST_CITED = 2
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


class _Builder(HTMLParser):
    """A tree from HTML as found: unclosed and stray tags are mended."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = ET.Element("html")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        while self.open[-1].tag in _CLOSES.get(tag, ()) and len(self.open) > 1:
            self.open.pop()
        at = ET.SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})
        if tag not in _VOID:
            self.open.append(at)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        at = self.open[-1]
        if len(at):
            at[-1].tail = (at[-1].tail or "") + data
        else:
            at.text = (at.text or "") + data


def parse_html(text: str) -> ET.Element:
    """A tree from HTML; scripts and styles are dropped."""
    builder = _Builder()
    builder.feed(re.sub(r"(?is)<(script|style)\b.*?</\1\s*>", "", text))
    return builder.root


def parse_xml(text: str) -> ET.Element:
    """A tree from XML with names in no namespace."""
    root = ET.fromstring(text)
    for e in root.iter():
        if isinstance(e.tag, str):
            e.tag = e.tag.rpartition("}")[2]
        for k in [k for k in e.attrib if "}" in k]:
            e.attrib[k.rpartition("}")[2]] = e.attrib.pop(k)
    return root


@dataclass
class Paper:
    """What is gathered from one tree."""

    tree: ET.Element
    paper_id: str
    html: bool
    references: list[dict] = field(default_factory=list)
    labels: dict[str, tuple[str, str]] = field(default_factory=dict)
    media: dict[str, tuple[str, str, str]] = field(default_factory=dict)
    counts: Counter = field(default_factory=Counter)
    notes: dict[str, tuple[bool, str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.parent = {c: p for p in self.tree.iter() for c in p}


def is_a(e: ET.Element, *names: str) -> bool:
    """Whether an element is of a kind: by its name, or by a class ``ltx_<name>`` in HTML."""
    if e.tag in names:
        return True
    classes = e.get("class", "").split()
    return any(f"ltx_{n}" in classes for n in names)


def find(tree: ET.Element, *names: str) -> list[ET.Element]:
    """Elements of some kinds in document order."""
    return [e for e in tree.iter() if isinstance(e.tag, str) and is_a(e, *names)]


def remove(paper: Paper, e: ET.Element, text: str = "") -> None:
    """Takes an element out and puts a text in its place; what follows it stays."""
    up = paper.parent.get(e)
    if up is None or e not in list(up):
        return
    kids = list(up)
    i = kids.index(e)
    put = text + (e.tail or "")
    if i:
        kids[i - 1].tail = (kids[i - 1].tail or "") + put
    else:
        up.text = (up.text or "") + put
    up.remove(e)


def squeezed(text: str) -> str:
    """White space as single blanks."""
    return " ".join(text.split())


def raw_text(e: ET.Element) -> str:
    return squeezed("".join(e.itertext()))


def names_of(e: ET.Element, up: dict) -> list[str]:
    """Labels of an element, or of the nearest of six around it."""
    for _ in range(6):
        given = [x for k in ("key", "labels", "id") for x in e.get(k, "").split()]
        if given:
            return given
        e = up.get(e)
        if e is None:
            break
    return []


#: Order of the roles of tags (fixed values).
_ROLES = {"key": 0, "typerefnum": 1, "refnum": 2, "number": 2, "autoref": 4}


def tag_of(e: ET.Element) -> str:
    """The printed number of an element."""
    tags = [t for t in e if is_a(t, "tags")]
    inner = [t for ts in tags for t in ts if is_a(t, "tag")] or [t for t in e if is_a(t, "tag")]
    if not inner:
        inner = [t for c in e for t in c if is_a(t, "tag")][:1]
    best = min(inner, key=lambda t: _ROLES.get(t.get("role", ""), 3), default=None)
    return re.sub(r"^[(\[]|[)\].:]$", "", raw_text(best)) if best is not None else ""


def number_in(tag: str) -> str:
    m = re.search(r"[A-Z]?\d+(?:\.\d+)*[a-z]?", tag)
    return m[0] if m else tag


def math_to_tex(paper: Paper) -> None:
    """Formulas as TeX between dollar signs; without TeX they go."""
    for e in find(paper.tree, "Math", "math"):
        note = next((a for a in e.iter("annotation") if "tex" in a.get("encoding", "")), None)
        tex = e.get("tex") or e.get("alttext") or (raw_text(note) if note is not None else "")
        tex = squeezed(tex.replace("\\displaystyle", ""))
        display = "display" in (e.get("mode", ""), e.get("display", "")) or e.get("display") == "block"
        remove(paper, e, f" $${tex}$$ " if tex and display else f" ${tex}$ " if tex else " ")


def collect_notes(paper: Paper) -> list[str]:
    """Footnotes, taken out."""
    notes = []
    for e in find(paper.tree, "note", "footnote"):
        content = next((x for x in e.iter() if is_a(x, "note_content")), e)
        for mark in [x for x in content.iter() if is_a(x, "note_mark", "tag", "tags")]:
            remove(paper, mark)
        notes.append(raw_text(content))
        remove(paper, e)
    return notes


def collect_bibliography(paper: Paper) -> None:
    """References in order, taken out; entries that are notes are marked."""
    for bib in find(paper.tree, "bibliography"):
        for item in [x for x in bib.iter() if is_a(x, "bibitem", "bibentry")]:
            key = item.get("key") or item.get("id") or ""
            tag = tag_of(item)
            for t in [x for x in item.iter() if is_a(x, "tags", "tag")]:
                remove(paper, t)
            text = raw_text(item)
            inner = any(is_a(x, "ref", "cite") and len(raw_text(x)) > 10 and not x.get("href", "").startswith("http") for x in item.iter())
            tex = max((len(re.findall(r"\\[a-zA-Z]+|\w", m)) for m in re.findall(r"\$([^$]*)\$", text)), default=0)
            n = len(paper.references)
            paper.references.append({"pos": n, "key": key, "tag": tag, "text": text, "is_note": inner or tex > 15})
            if inner or tex > 15:
                paper.notes |= {k: (inner, text) for k in {key, item.get("id", "")} - {""}}
            for k in {key, item.get("id", "")} - {""}:
                paper.labels[k] = ("Reference", str(n))
        remove(paper, bib)


def _cited_in(e: ET.Element) -> list[tuple[ET.Element, list[str]]]:
    """The references of a citation: each element with its keys."""
    named = ((b, b.get("bibrefs") or (b.get("href", "")[1:] if b.get("href", "").startswith("#") else "")) for b in e.iter())
    return [(b, keys) for b, text in named if (keys := [k.strip() for k in text.split(",") if k.strip()])]


def put_notes_back(paper: Paper, most: int = MOST_CITED) -> list[str]:
    """Notes among the references written out where they are cited, as ``(Note: …)``.

    A soft note, one without a citation of its own, stays a reference if it is cited more than ``most`` times.
    """
    cites = find(paper.tree, "cite")
    count = Counter(k for c in cites for _, keys in _cited_in(c) for k in keys)
    back: list[str] = []
    for c in cites:
        for b, keys in _cited_in(c):
            noted = [k for k in keys if k in paper.notes and (paper.notes[k][0] or count[k] <= most)]
            for key in noted:
                back.append(key)
                put_before(paper, c, f" (Note: {paper.notes[key][1]})")
            left = [k for k in keys if k not in noted]
            if noted and left:
                b.set("bibrefs", ",".join(left))
            elif noted and b is not c:
                remove(paper, b)
            elif noted:
                b.set("bibrefs", "")
        if back and not _cited_in(c) and not raw_text(c).strip(" ,;[]()"):
            remove(paper, c)
    return back


def put_before(paper: Paper, e: ET.Element, text: str) -> None:
    """Puts a text right before an element."""
    up = paper.parent[e]
    i = list(up).index(e)
    if i:
        up[i - 1].tail = (up[i - 1].tail or "") + text
    else:
        up.text = (up.text or "") + text


def collect_leftovers(paper: Paper) -> None:
    """Figures and tables that no number or caption names: kept as extra_figure_n and extra_table_n, empty ones dropped."""
    for kind, tag in (("Figure", "figure"), ("Table", "table")):
        n = 0
        for e in [x for x in paper.tree.iter() if x.tag == tag and x is not paper.tree]:
            if paper.parent.get(e) is None or e not in list(paper.parent[e]) or e.get("class", "").startswith("ltx_eqn"):
                continue
            if raw_text(e):
                key = f"extra_{tag}_{n}"
                n += 1
                paper.media[key] = (kind, "", table_text(e) or raw_text(e))
                paper.labels[key] = (kind, key)
            remove(paper, e)


def unique_ids(text: str) -> str:
    """XML in which ids that come again end in ``_n``."""
    tree, seen, again = ET.fromstring(text), set(), Counter()
    for e in tree.iter():
        own = e.get("id")
        if own and own in seen:
            again[own] += 1
            e.set("id", f"{own}_{again[own]}")
        elif own:
            seen.add(own)
    return ET.tostring(tree, encoding="unicode")


def whole_references(labels: dict[str, dict[str, str]], by_count: bool = False) -> dict[str, list[tuple[str, str]]]:
    """Labels by kind turned round: for each key its kinds with their label, or its place among those of the kind."""
    out: dict[str, list[tuple[str, str]]] = {}
    for kind, held in labels.items():
        for n, (key, label) in enumerate(held.items()):
            out.setdefault(key, []).append((kind, str(n) if by_count else label))
    return out


def side_sections(paper: Paper, name: str) -> list[dict]:
    """Appendix or index sections, taken out: title and paragraphs of each."""
    out = []
    for e in find(paper.tree, name):
        if paper.parent.get(e) is None:
            continue
        head = next((c for c in e if is_a(c, "title") or re.fullmatch(r"h[1-6]", c.tag)), None)
        made = [b["text"] for b in blocks(e) if b["kind"] != "heading"]
        out.append({"title": raw_text(head) if head is not None else None, "paragraph": made})
        remove(paper, e)
    return out


def table_text(e: ET.Element) -> str:
    """A table as text rows, the first one as its head; a table in a cell is written in one line."""
    rows = []
    for r in [x for x in e.iter() if is_a(x, "tr")]:
        cells = [raw_text(c).replace("|", "\\|") for c in r if is_a(c, "td", "th")]
        if cells:
            rows.append("| " + " | ".join(cells) + " |")
    if rows:
        rows.insert(1, "|" + " --- |" * (rows[0].count(" | ") + 1))
    return "\n".join(rows)


def collect_media(paper: Paper) -> None:
    """Figures, tables and floats, each with caption and source, replaced by a placeholder."""
    for kind, names in (("Table", ("table",)), ("Figure", ("figure",)), ("Float", ("float",))):
        for e in [x for x in find(paper.tree, *names) if paper.parent.get(x) is not None]:
            if kind == "Table" and paper.html and e.tag == "table" and not is_a(e, "tabular") and e.get("class", "").startswith("ltx_eqn"):
                continue
            captions = [c for c in e.iter() if is_a(c, "caption", "figcaption")]
            number = number_in(next((t for t in (tag_of(c) for c in [*captions, e]) if t), "")) or str(paper.counts[kind] + 1)
            for t in [x for c in captions for x in c.iter() if is_a(x, "tag", "tags")]:
                remove(paper, t)
            caption = " ".join(raw_text(c) for c in captions)
            graphics = [f"![{g.get('id', '')}]({g.get('src') or g.get('graphic', '')})" for g in e.iter() if is_a(g, "graphics") or g.tag == "img"]
            source = "\n".join([*graphics, *(t for t in [table_text(e)] if t)])
            paper.counts[kind] += 1
            key = next(iter(names_of(e, {})), f"{kind.lower()}_{paper.counts[kind]}")
            for name in {*names_of(e, {}), key}:
                paper.labels[name] = (kind, number)
            paper.media[key] = (kind, caption, source)
            remove(paper, e, f"\n![{kind}:{key}]\n")


def collect_equations(paper: Paper) -> None:
    """Equation blocks as displayed formulas, their numbers as labels; groups are joined by row breaks."""
    for e in find(paper.tree, "equationgroup", "equation"):
        if paper.parent.get(e) is None:
            continue
        number = number_in(tag_of(e)) or str(paper.counts["Equation"] + 1)
        paper.counts["Equation"] += 1
        for name in names_of(e, {}):
            paper.labels[name] = ("Equation", number)
        for t in [x for x in e.iter() if is_a(x, "tags", "tag", "eqn_eqno", "MathFork")]:
            if not is_a(t, "MathFork"):
                remove(paper, t)
        rows = [x.strip() for x in re.findall(r"\${1,2}([^$]+)\${1,2}", "".join(e.itertext()))]
        joined = " \\\\ ".join(rows) if is_a(e, "equationgroup") else " ".join(rows)
        remove(paper, e, f"\n$$ {joined} $$\n" if joined else " ")


_SECTIONS = ("part", "chapter", "section", "subsection", "subsubsection", "paragraph", "appendix")


def collect_labels(paper: Paper) -> None:
    """Numbers of sections, items and theorems."""
    for e in find(paper.tree, *_SECTIONS, "item", "theorem", "proof"):
        kind = "Section" if is_a(e, *_SECTIONS) else "Item" if is_a(e, "item") else "Theorem"
        head = next((c for c in e if is_a(c, "title")), None)
        number = number_in(tag_of(head) if head is not None and tag_of(head) else tag_of(e))
        if number:
            for name in names_of(e, {}):
                paper.labels.setdefault(name, (kind, number))


def cited_as(left: str, label: str, right: str) -> str:
    """A citation as it reads in its sentence."""
    before, after = left.strip(), right.strip()
    if not before or before[-1] in ".!?;" or before.rsplit(None, 1)[-1] in _AFTER:
        out = label
    else:
        out = f"(See {label})"
    return out + ("." if not after or after[0].isupper() else "")


_AFTER = frozenset(PREPOSITIONS)
#: Kinds of labels in order of precedence, with the word written (fixed values).
_WORD = {"Reference": "Ref", "Equation": "Equation", "Figure": "Figure", "Table": "Table", "Section": "Section", "Item": "Item", "Theorem": "Theorem", "Float": "Float"}


def write_references(paper: Paper) -> tuple[dict[str, int], list[str]]:
    """Citations and cross-references as text; how often each key is cited, and keys that nothing has."""
    cited: Counter = Counter()
    missing: dict[str, int] = {}
    for e in find(paper.tree, "cite"):
        keys = [k.strip() for b in e.iter() for k in (b.get("bibrefs") or (b.get("href", "")[1:] if b.get("href", "").startswith("#") else "")).split(",") if k.strip()]
        cited.update(keys)
        parts = []
        for k in keys:
            if k not in paper.labels:
                missing.setdefault(k, len(missing))
            kind, label = paper.labels.get(k, ("Reference", f"MissingCite_{missing.get(k, 0)}"))
            parts.append(f"{_WORD[kind]}.{label}")
        up = paper.parent.get(e)
        at = list(up).index(e) if up is not None else 0
        left = ((up[at - 1].tail if at else up.text) or "") if up is not None else ""
        text = cited_as(left, f"[{', '.join(parts)} of {paper.paper_id}]", e.tail or "x") if parts else raw_text(e)
        remove(paper, e, " " + text)
    for e in find(paper.tree, "ref"):
        key = e.get("labelref") or (e.get("href", "")[1:] if e.get("href", "").startswith("#") else "")
        if key:
            cited[key] += 1
            kind, label = paper.labels.get(key, ("", ""))
            remove(paper, e, f"[{_WORD[kind]}.{label} of {paper.paper_id}]" if kind else raw_text(e))
        elif e.get("href"):
            remove(paper, e, f"[{raw_text(e)}]({e.get('href')})")
    return dict(cited), sorted(missing)


def inline(e: ET.Element) -> str:
    """The text of an element with emphasis and list marks."""
    out = [e.text or ""]
    for c in e:
        body = inline(c)
        bold = "bold" in (c.get("font", ""), c.get("class", "")) or c.tag in ("b", "strong") or "ltx_font_bold" in c.get("class", "").split()
        italic = c.get("font") == "italic" or c.tag in ("i", "em") or "ltx_font_italic" in c.get("class", "").split()
        if body.strip() and (bold or italic):
            body = f"**{body.strip()}**" if bold else f"*{body.strip()}*"
        if is_a(c, "item") or c.tag == "li":
            body = "\n- " + squeezed(body)
        if is_a(c, "tags", "tag"):
            body = ""
        out += [body, c.tail or ""]
    return "".join(out)


def lines(text: str) -> str:
    return "\n".join(x for x in (squeezed(x) for x in text.split("\n")) if x)


def blocks(e: ET.Element, path: tuple[int, ...] = (), title: str | None = None) -> Iterator[dict]:
    """Blocks in reading order: paragraphs with the path and title of their section."""
    n, loose = 0, []

    def flush() -> Iterator[dict]:
        text = lines("".join(loose))
        loose.clear()
        if text:
            yield {"path": list(path), "level": len(path), "title": title, "kind": "text", "text": text}

    loose.append(e.text or "")
    for c in e:
        heading = is_a(c, "title") or re.fullmatch(r"h[1-6]", c.tag) is not None
        if is_a(c, *_SECTIONS) or c.tag in ("section",):
            yield from flush()
            head = next((x for x in c if is_a(x, "title") or re.fullmatch(r"h[1-6]", x.tag)), None)
            name = squeezed(inline(head)) if head is not None else None
            yield {"path": [*path, n], "level": len(path) + 1, "title": name, "kind": "heading", "text": name or ""}
            yield from blocks(c, (*path, n), name)
            n += 1
        elif heading and path:
            pass
        elif heading or is_a(c, "p", "item") or c.tag in ("li", "pre", "blockquote"):
            yield from flush()
            text = lines(inline(c))
            if text:
                kind = "heading" if heading else "item" if c.tag == "li" or is_a(c, "item") else "text"
                yield {"path": list(path), "level": len(path), "title": title, "kind": kind, "text": text}
        elif c.tag in ("nav", "head", "footer", "header"):
            pass
        elif len(c) or is_a(c, "para", "itemize", "enumerate"):
            yield from flush()
            yield from blocks(c, path, title)
        else:
            loose.append(inline(c))
        loose.append(c.tail or "")
    yield from flush()


def take(paper: Paper, *names: str) -> str:
    """The text of the first element of a kind, taken out."""
    e = next(iter(find(paper.tree, *names)), None)
    if e is None:
        return ""
    for t in [x for x in e.iter() if is_a(x, "title")]:
        remove(paper, t)
    text = squeezed(inline(e))
    remove(paper, e)
    return text


def extract(text: str | None, paper_id: str, html: bool) -> dict:
    """A document taken apart; the status tells what went wrong, if anything did."""
    if text is None:
        return {"status": "NoHTML" if html else "NoXML"}
    if len(text.encode("utf-8", "ignore")) < LEAST_BYTES:
        return {"status": "TooSmall"}
    try:
        tree = parse_html(text) if html else parse_xml(text)
    except ET.ParseError as e:
        tree = parse_html(text)  # reads what it can (A9)
        if not len(tree):
            return {"status": "ParseError", "error": str(e)}
    if html:
        article = next(iter(find(tree, "article")), None)
        if article is None:
            return {"status": "NoArticle"}
        tree = article
    try:
        return {"status": "Finish"} | _extracted(Paper(tree, paper_id or "", html))
    except RecursionError:
        return {"status": "TooDeep"}
    except Exception as e:  # noqa: BLE001
        return {"status": "Fail", "error": f"{type(e).__name__}: {e}"[:300]}


def _extracted(paper: Paper) -> dict:
    math_to_tex(paper)
    notes = collect_notes(paper)
    people = [raw_text(x) for x in find(paper.tree, "personname")]
    for e in find(paper.tree, "authors", "creator"):
        remove(paper, e)
    collect_bibliography(paper)
    put_notes_back(paper)
    collect_equations(paper)
    collect_media(paper)
    collect_leftovers(paper)
    collect_labels(paper)
    cited, missing = write_references(paper)
    head = next((x for x in paper.tree if is_a(x, "title") or x.tag == "h1"), None)
    title = squeezed(inline(head)) if head is not None else None
    if head is not None:
        remove(paper, head)
    abstract, thanks = take(paper, "abstract"), take(paper, "acknowledgements")
    made = list(blocks(paper.tree))
    made += [{"path": [], "level": 0, "title": None, "kind": "note", "text": n} for n in notes]
    return {
        "title": title, "abstract": abstract, "acknowledge": thanks, "author": people, "blocks": made, "references": paper.references,
        "labels": {k: {"type": t, "label": v} for k, (t, v) in paper.labels.items()},
        "media": {k: {"kind": a, "caption": b, "source": c} for k, (a, b, c) in paper.media.items()}, "cited": cited, "missing": missing,
    }


def extract_udf(html: bool):  # noqa: ANN201
    """A vectorised function of (text, paper id) to the struct :data:`PAPER`."""
    columns = [c.split()[0] for c in re.split(r", (?![^<]*>)", PAPER)]

    @F.pandas_udf(PAPER)
    def run(text: pd.Series, paper_id: pd.Series) -> pd.DataFrame:
        rows = [extract(t, i, html) for t, i in zip(text, paper_id, strict=True)]
        return pd.DataFrame([[r.get(c) for c in columns] for r in rows], columns=columns)

    return run


CLASSIC = (
    "status string, sections array<struct<tag:string,section_title:string,section_content:array<array<string>>>>, "
    "appendix array<struct<title:string,paragraph:array<string>>>, index array<struct<title:string,paragraph:array<string>>>, put_back array<string>"
)


def classic(text: str | None, paper_id: str) -> dict:
    """A document in the older shape: a flat list of sections with their paragraphs, appendix and index apart.

    Footnotes stay where they are, as ``[[[Notice: …]]]``, and so do notes among the references that are cited once.
    """
    if text is None:
        return {"status": "NoXML"}
    try:
        paper = Paper(parse_xml(text), paper_id or "", False)
    except ET.ParseError:
        return {"status": "ParseError"}
    math_to_tex(paper)
    for e in find(paper.tree, "note", "footnote"):
        for mark in [x for x in e.iter() if is_a(x, "tags", "tag")]:
            remove(paper, mark)
        remove(paper, e, f"[[[Notice: {raw_text(e)}]]]")
    collect_bibliography(paper)
    back = put_notes_back(paper, most=1)
    collect_equations(paper)
    collect_media(paper)
    collect_leftovers(paper)
    collect_labels(paper)
    write_references(paper)
    aside = {name: side_sections(paper, name) for name in ("appendix", "index")}
    sections = []
    for e in find(paper.tree, "section"):
        head = next((c for c in e if is_a(c, "title")), None)
        tag = tag_of(head) if head is not None else ""
        for t in [x for x in (head.iter() if head is not None else ()) if is_a(x, "tag", "tags")]:
            remove(paper, t)
        body = [[b["text"]] for b in blocks(e) if b["kind"] != "heading" and b["path"] == []]
        sections.append({"tag": tag, "section_title": raw_text(head) if head is not None else None, "section_content": body})
    return {"status": "Finish", "sections": sections, "put_back": back, **aside}


def classic_udf():  # noqa: ANN201
    """A vectorised function of (text, paper id) to the struct :data:`CLASSIC`."""
    columns = [c.split()[0] for c in re.split(r", (?![^<]*>)", CLASSIC)]

    @F.pandas_udf(CLASSIC)
    def run(text: pd.Series, paper_id: pd.Series) -> pd.DataFrame:
        rows = [classic(t, i) for t, i in zip(text, paper_id, strict=True)]
        return pd.DataFrame([[r.get(c) for c in columns] for r in rows], columns=columns)

    return run
