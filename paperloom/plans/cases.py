"""Operators whose input the tables do not hold, over small inputs, held against values worked out by hand.

Each query gives rows of group, item and value; the SQL is the list of what is expected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import bibtex, colour, csl, document, reference, scoring, tex, text
from paperloom.operators import batch, citations, documents, grading, identity, projects, retrieval, unarxive
from paperloom.plans.expected import EXPECTED

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, Query] = {}


def case(f: Query) -> Query:
    """Registers a query."""
    FOUND[f.__name__] = f
    return f


def _one(spark: SparkSession, **columns: Column) -> DataFrame:
    """A row per named value, computed over one row."""
    pairs = F.array(*(F.struct(F.lit(k).alias("item"), _text(c).alias("value")) for k, c in columns.items()))
    return spark.range(1).select(F.explode(pairs).alias("p")).select(F.lit("").alias("group"), "p.item", "p.value")


def _text(c: Column) -> Column:
    return F.coalesce(F.to_json(F.struct(c.alias("v"))), F.lit("{}"))


def _rows(df: DataFrame, group: str | Column, item: str | Column, value: Column) -> DataFrame:
    as_column = [F.col(x) if isinstance(x, str) else x for x in (group, item)]
    return df.select(as_column[0].cast("string").alias("group"), as_column[1].cast("string").alias("item"), _text(value).alias("value"))


def _each(spark: SparkSession, values: Sequence[str | None], **columns: Callable[[Column], Column]) -> DataFrame:
    """Functions of each text of a list; the group is its place."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    parts = [_rows(df, "i", F.lit(k), f(F.col("x"))) for k, f in columns.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@case
def fx_file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of files, names without modes, folders before an analysis, suffixes, months."""
    names = ["main.tex", "a.TEX", "README", "s.sty", "b.bbl", "p.pdf", "x.clean.tex", "x.revtex.tex", "/d/analysis.log/x", "1512.03385", None]
    return _each(
        spark, names, file_class=tex.file_class, plain=lambda x: tex.plain_name(x, ("clean", "revtex")), before=tex.before_analysis,
        suffixed=lambda x: tex.with_suffix(x, ".tex"), month=text.yymm,
    )


@case
def fx_tex_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Comments, drawings, packages, classes and bibliography commands of sources."""
    sources = [
        "a % c\n% whole\nb \\% d", "\\usepackage{tikz-cd}", "\\usepackage{tikz}\\begin{picture}\\end{picture}", "\\usepackage{tikzit}", "\\usepackage[x]{amssym}",
        "\\documentclass[11pt, twocolumn]{article}", "\\bibliography{refs, more}\n\\cite{a,b}\\citep[see][]{c}", "x\n\\end{document}", None,
    ]
    return _each(
        spark, sources, uncommented=tex.uncommented, drawing=tex.has_drawing, renamed=tex.renamed_packages, klass=tex.seek_class,
        bibliographies=tex.bibliography_names, cited=tex.cited_keys, repointed=lambda x: tex.repointed(x, F.lit("root")),
    )


@case
def fx_tex_modes(spark: SparkSession, sf: str) -> DataFrame:
    """A source in each mode."""
    source = (
        "\\documentclass{x}\n\\usepackage{biblatex,amsmath}\n\\author{Me}\n\\newcommand{\\q}[1]{w{#1}}\n\\DeclareMathOperator{\\op}{op}\n\\addbibresource{refs.bib}\n"
        "\\begin{document}\n\\affiliation{There}\n\\section{One} % note\n\\begin{figure}\\includegraphics{f}\\caption{C}\\label{l}\\end{figure}\n\\printbibliography\n\\end{document}"
    )
    df = spark.createDataFrame([(source,)], "x string")
    parts = []
    for mode in tex.MODES:
        done = df.select(tex.standardise_udf(mode, ["biblatex"] if mode == "clean_beta" else [])("x").alias("r"))
        parts += [_rows(done, F.lit(mode), F.lit("text"), F.col("r.text")), _rows(done, F.lit(mode), F.lit("removed"), F.col("r.removed"))]
    kept, out = tex.split_preamble("\\title{a}\n\\odd[x]{y{z}}\\newcommand{\\q}[1]{w}")
    return _union(*parts, _one(spark, kept=F.lit(kept), extracted=F.lit(out)))


_FILES = [
    ("a", "main.tex", "\\input{sec}\\begin{document}"), ("a", "sec.tex", "text"), ("b", "x.tex", "\\begin{document}"), ("b", "y.tex", "\\begin{document}"), ("b", "x.bbl", ""),
    ("c", "only.tex", ""), ("d", "pic.eps", ""), ("e", "p.tex", ""), ("e", "q.tex", ""), ("f", "one.tex", "\\begin{document}"), ("f", "supplement.tex", "\\begin{document}"),
    ("g", "z.clean.tex", ""), ("h", "z.clean.tex", ""), ("h", "w.revtex.tex", ""), ("i", "U.TEX", ""), ("i", "p.pdf", ""), ("j", "readme", ""),
]


@case
def fx_projects(spark: SparkSession, sf: str) -> DataFrame:
    """Root files, classes of folders, good files, buckets to remake, and listings."""
    files = spark.createDataFrame(_FILES, "paper_id string, name string, content string")
    listing = spark.createDataFrame([("x quant-ph/a.tex",), ("x quant-ph/a.jpg",), ("x hep-th/b.tex",), (" 1 quant-ph/c.BIB ",)], "line string")
    return _union(
        _rows(projects.root_files(files), "paper_id", F.lit("root"), F.struct("status", "root")), _rows(projects.folder_class(files), "paper_id", F.lit("folder"), F.col("status")),
        _rows(projects.good_files(files), "paper_id", F.lit("good"), F.struct("status", "names")), _rows(projects.remake_buckets(files), "paper_id", F.lit("bucket"), F.struct("bucket", "root")),
        _rows(projects.cleaned_listing(files), "paper_id", F.lit("cleaned"), F.struct("has_tex", "names")), _rows(projects.needed_files(listing, "quant-ph"), F.lit("listing"), "path", F.lit(True)),
        _rows(projects.include_edges(files), "paper_id", "src", F.col("dst")),
    )


@case
def fx_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, missing files, states and modes of compilations."""
    lines = [
        "Conversion complete: 2 warnings; 1 error; 3 undefined macros[\\a, \\b]; 1 missing file[foo.sty]", "Conversion complete: No obvious problems", "Conversion complete: 4 warnings",
        "Error: can't find my.cls anywhere", "nothing",
    ]
    logs = [("p", "clean", i, x) for i, x in enumerate(["start", "...", lines[0]])] + [("p", "revtex", 0, lines[1]), ("q", "clean", 0, lines[2]), ("r", "clean", 0, "start")]
    df = spark.createDataFrame(logs, "paper_id string, mode string, pos int, line string")
    files = spark.createDataFrame([("p", "foo.sty"), ("q", "x.tex")], "paper_id string, name string")
    status = projects.log_status(df)
    counts = df.select("paper_id", "mode", "pos", projects.log_counts(F.col("line")).alias("c")).select("paper_id", "mode", "pos", "c.*")
    states = spark.createDataFrame([("p", True, True), ("q", True, False), ("r", False, False)], "paper_id string, passed boolean, has_bib boolean")
    return _union(
        _each(spark, lines, counts=projects.log_counts, missing=projects.missing_names), _rows(status, "paper_id", "mode", F.col("status")),
        _rows(projects.modes_table(status), "paper_id", F.lit("passed"), F.col("passed")), _rows(projects.needed_styles(df, files), "style", "is_private", F.col("papers")),
        _rows(projects.allowed_failures(counts), "paper_id", F.concat_ws("/", "mode", "pos"), F.col("is_allowed")), _rows(projects.moved(states), "paper_id", F.lit("place"), F.col("place")),
    )


@case
def fx_bibliographies(spark: SparkSession, sf: str) -> DataFrame:
    """Compiled bibliographies, their plain text, where they go, and what papers without references have (H3 to H5, H8, H9)."""
    bbl = "\\begin{thebibliography}{9}\n\\bibitem[Ab(20)]{k1} A. Bee, \\emph{On {\\bf drifts}}.\n\\bibitem{k2}\\newblock C~D\n\\end{thebibliography}"
    df = spark.createDataFrame([(bbl,)], "x string").select(F.posexplode(tex.bib_items(F.col("x"))).alias("pos", "b"))
    both = spark.createDataFrame([("a", "x \\bibliography{r} y"), ("b", "z\\end{document}"), ("c", "w")], "paper_id string, content string")
    made = spark.createDataFrame([("a", "BBL"), ("b", "BBL")], "paper_id string, content string")
    roots = [(p, "r.tex", c) for p, c in (
        ("a", ""), ("b", ""), ("c", ""), ("d", ""), ("e", "\\bibliography{m,n}"), ("f", "\\bibliography{m,n}"), ("g", "\\bibliography{m,n}"), ("h", "\\bibliography{m,n}"),
        ("i", "\\bibliography{m,n}"), ("j", "\\bibliography{m,IEEEabrv}"), ("k", "\\bibliography{m}"),
    )]
    have = {"a": "r.bbl", "b": "r.bib", "e": "m.bbl n.bbl", "f": "m.bbl n.bib", "g": "m.bib n.bib", "h": "m.bbl", "i": "m.bib", "k": "r.bbl"}
    files = [(p, n) for p, names in have.items() for n in names.split()]
    triage = projects.reference_triage(
        spark.createDataFrame(roots, "paper_id string, name string, content string"), spark.createDataFrame(files, "paper_id string, name string"),
        spark.createDataFrame([("d", 3)], "paper_id string, n int"),
    )
    ready = projects.reference_readiness(spark.createDataFrame([("a", "x"), ("b", ""), ("c", None)], "paper_id string, text string"))
    return _union(
        _rows(df, "pos", F.lit("item"), F.col("b")), _rows(df, "pos", F.lit("plain"), tex.plain_entry(F.col("b.content"))),
        _rows(projects.with_bibliography(both, made), "paper_id", F.lit("merged"), F.col("content")), _rows(triage, "paper_id", F.lit("triage"), F.col("bucket")),
        _rows(ready, "paper_id", F.lit("ready"), F.col("status")),
    )


XML = (
    "<document xmlns='http://dlmf.nist.gov/LaTeXML'><title>On drifts</title><creator role='author'><personname>A. Bee</personname></creator>"
    "<abstract><p>We show <Math tex='\\displaystyle a  b' mode='inline'/>.</p></abstract>"
    "<section labels='LABEL:s1' xml:id='S1'><title><tag>1</tag>Start</title><para><p>As in <cite><bibref bibrefs='k1'/></cite> and Fig. <ref labelref='F1'/>, see <cite><bibref bibrefs='k3'/></cite> it.</p></para>"
    "<para><p>Noted<cite><bibref bibrefs='k2'/></cite> here.<note>Foot.</note></p></para>"
    "<equation labels='E1'><tags><tag role='refnum'>(3)</tag></tags><Math tex='c=d' mode='display'/></equation>"
    "<figure labels='F1'><tags><tag role='refnum'>2</tag></tags><graphics graphic='f.png'/><caption>A figure</caption></figure></section>"
    "<section><title>End</title><table labels='T1'><tabular><tr><td>x</td><td>y</td></tr><tr><td>1</td><td>2</td></tr></tabular><caption><tag role='refnum'>7</tag>Tab</caption></table>"
    "<itemize><item><para><p>one</p></para></item><item><para><p><text font='bold'>two</text></p></para></item></itemize></section>"
    "<appendix><title>More</title><para><p>Aside.</p></para></appendix>"
    "<bibliography><biblist><bibitem key='k1'><tags><tag role='refnum'>1</tag></tags><bibblock>C. Dee, 2001.</bibblock></bibitem>"
    "<bibitem key='k2'><bibblock>A remark, as in <ref href='#k1'>the work of Dee and others</ref>.</bibblock></bibitem></biblist></bibliography></document>"
)
HTML = (
    "<html><body><article class='ltx_document'><h1 class='ltx_title'>On drifts</h1><div class='ltx_abstract'><p class='ltx_p'>Short.</p></div>"
    "<section class='ltx_section' id='S1'><h2 class='ltx_title'><span class='ltx_tag'>1</span> Start</h2><p class='ltx_p'>Shown in <cite class='ltx_cite'><a class='ltx_ref' href='#b1'>1</a></cite> by "
    "<math alttext='x^{2}' display='inline'></math>.</p><figure class='ltx_figure' id='F1'><img src='f.png'><figcaption class='ltx_caption'><span class='ltx_tag'>Figure 4</span>A figure</figcaption></figure>"
    "<table class='ltx_tabular'><tr><td>plain</td></tr></table></section><section class='ltx_bibliography'><ul><li class='ltx_bibitem' id='b1'><span class='ltx_bibblock'>C. Dee, 2001.</span></li></ul></section></article></body></html>"
)


def _taken(spark: SparkSession, content: str, html: bool) -> DataFrame:
    papers = documents.converted(spark.createDataFrame([("P", content)], "paper_id string, content string"), html=html)
    blocks = papers.select(F.posexplode("blocks").alias("pos", "b"))
    return _union(
        _rows(papers, F.lit("paper"), F.lit("head"), F.struct("status", "title", "abstract", "author", "missing")), _rows(blocks, F.lit("block"), F.lpad(F.col("pos").cast("string"), 2, "0"), F.col("b")),
        _rows(papers.select(F.explode("labels").alias("k", "v")), F.lit("label"), "k", F.col("v")), _rows(papers.select(F.explode("media").alias("k", "v")), F.lit("media"), "k", F.col("v")),
        _rows(documents.references(papers), F.lit("reference"), "key", F.struct("pos", "text", "is_note", "in_context")), _rows(documents.citation_counts(papers), F.lit("cited"), "key", F.col("n")),
        _rows(documents.missing_citations(papers), F.lit("missing"), "key", F.col("n")), _rows(documents.markdown(papers), F.lit("markdown"), "paper_id", F.col("markdown")),
    )


@case
def fx_xml(spark: SparkSession, sf: str) -> DataFrame:
    """A LaTeXML document taken apart."""
    return _taken(spark, XML, html=False)


@case
def fx_html(spark: SparkSession, sf: str) -> DataFrame:
    """A page of the same kind taken apart."""
    return _taken(spark, HTML, html=True)


@case
def fx_xml_states(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of documents that are missing, small, broken or of another kind."""
    long = "x " * 60
    rows = [("none", None), ("small", "<a/>"), ("broken", f"<document><p>{long}</q></document>"), ("text", long), ("whole", f"<document><p>{long}</p></document>")]
    df = spark.createDataFrame(rows, "paper_id string, content string")
    parts = []
    for html in (False, True):
        done = df.select("paper_id", document.extract_udf(html)("content", "paper_id").alias("p"))
        parts.append(_rows(done, "paper_id", F.lit("html" if html else "xml"), F.col("p.status")))
    return _union(*parts)


@case
def fx_classic(spark: SparkSession, sf: str) -> DataFrame:
    """The same document in the older shape, and ids made unique."""
    df = spark.createDataFrame([("P", XML)], "paper_id string, content string").select(document.classic_udf()("content", "paper_id").alias("p")).select("p.*")
    labels = document.whole_references({"Figure": {"a": "1", "b": "2"}, "Table": {"a": "7"}})
    return _union(
        _rows(df.select(F.posexplode("sections").alias("pos", "s")), F.lit("section"), "pos", F.col("s")), _rows(df, F.lit("paper"), F.lit("rest"), F.struct("status", "appendix", "index", "put_back")),
        _one(spark, unique=F.lit(document.unique_ids("<a id='x'><b id='x'/><c id='x'/><d id='y'/></a>")), labels=F.lit(str(labels)), counts=F.lit(str(document.whole_references({"Figure": {"a": "1", "b": "2"}}, True)))),
    )


@case
def fx_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text and citation functions."""
    ends = spark.createDataFrame([("shown in", "r"), ("shown and", "Next"), ("It holds.", ""), ("we find", "that"), ("see Fig.", "x"), ("as refs", "x"), ("(", ")")], "l string, r string")
    left, right, lit = F.col("l"), F.col("r"), F.lit
    values = [" a \u2003 b\n c ", "\\displaystyle x  y\n\n z", "Smith 2001", "one two three four five six seven eight nine ten", "arXiv: 2101.12345v2 x", "J. Bee and K. L. Cee", "[[a]] [b]", None]
    marks = ["We show [1, 2] it. [3] holds", "as in [4]", "end. [Ref.2 of ArXiv:x] so", "we [DOI:10/a] x"]
    return _union(
        _each(spark, values, single=text.single_spaced, lines=text.formula_lines, tokens=text.formula_tokens, note=text.is_note, year=text.has_year, arxiv=text.arxiv_id, people=text.named_people,
              normal=text.normal, number=text.four_digits, brackets=text.shrunk_brackets, last=lambda x: text.last_match(x, "[a-z]")),
        _rows(ends, F.lit("cited"), left, text.cited(left, lit("3"), right, lit("P"))), _rows(ends, F.lit("ids"), left, text.cited(left, lit("<a,b>"), right, lit("P"), end=False)),
        _rows(ends, F.lit("named"), left, text.names_before(left, lit("3"), lit("P"))), _rows(ends, F.lit("bare"), left, text.without_brackets(left, right)),
        _each(spark, marks, numbers=lambda x: unarxive.numbered_marks(x, lit("P")), names=unarxive.named_marks),
        _one(spark, merged=text.merged_authors(lit("@a{k,\n author = {A B},\n author = {C D},\n year = 1}")), once=unarxive.merged_citations(lit("so [Ref.1 of P], [Ref.2 of P] is"))),
    )


@case
def fx_marks(spark: SparkSession, sf: str) -> DataFrame:
    """A delivery whose keys differ in case, resolved and put into sections."""
    entry = "struct<bib_entry_raw:string,ids:map<string,string>>"
    schema = (
        "row_id bigint, paper_id string, body_text array<struct<section:string,sec_number:string,text:string>>, "
        f"bib_entries array<struct<k:string,v:{entry}>>, ref_entries array<struct<k:string,v:struct<type:string,latex:string,caption:string>>>"
    )
    body = [
        ("Intro", "1", "We use {{cite:K1}} and {{formula:F1}}"), ("Intro", "1", "so it goes on. {{cite:k1 , k2}}"), ("Intro", "1", "Next {{figure:G1}} here $"), ("Intro", "1", "After it."),
        ("Proofs", "A-1", "Appendix text"), ("End", "2", "Acknowledgement of all"), ("", "3", "References follow"), ("", "3", "Lost"),
    ]
    refs = [("F1", ("formula", "x^2", None)), ("G1", ("figure", None, "cap")), ("T1", ("table", None, None))]
    bibs = [("K1", ("A. Bee 1999", {"doi": "10/a"})), ("k1 ", ("other", None)), ("K2", ("B; C", {"arxiv": "1"}))]
    papers = spark.createDataFrame([(1, "X", body, bibs, refs)], schema).withColumns(
        {"bib_entries": F.map_from_entries("bib_entries"), "ref_entries": F.map_from_entries("ref_entries")}
    )
    lines = unarxive.paragraphs(papers)
    return _union(
        _rows(unarxive.entry_values(papers), "kind", "entry_key", F.struct("n", "value")), _rows(lines, "zone", "pos", F.struct("section_num", "section_name", "text")),
        _rows(unarxive.joined_paragraphs(lines), F.lit("joined"), "pos", F.struct("section_num", "text")), _rows(unarxive.sections(papers), F.lit("section"), "section_num", F.struct("section_title", "section_content", "is_appendix")),
        _rows(unarxive.packed(lines.where("zone = 'body'"), least=3, most=9), F.lit("packed"), F.concat_ws("/", "section_num", "pos"), F.struct("text", "n_words")),
        _rows(unarxive.resolved_citations(papers), F.lit("resolved"), "bib_key", F.col("is_resolved")),
    )


RECORDS = [
    '{"title": "On drifts of things", "author": [{"given": "Jane Mary", "family": "Bee"}, {"literal": "C Dee and E Eff"}], "container-title": ["J. Drift"], "volume": 3, "page": "12-15", "issued": {"date-parts": [[1999, 2]]}, "externalids": {"PubMed": "7", "DOI": "https://doi.org/10/x"}}',
    '{"title": ["A"], "authors": [{"name": "Ludwig van Beethoven"}, {"name": "Martin King, Jr."}, {"name": "Plato"}, {"name": "Four Th"}], "journal": {"name": "Ann. X", "volume": "9", "pages": "4"}, "year": "c. 2001", "publisher": "P"}',
    '{"author": "Marie Curie", "jname": "Nature", "jvol": "1", "jpage": "2", "date": "2003-04-05", "unique_id": {"arxiv_id": "arXiv:1234.5678", "semopenalex": "w1"}}', '{"title": " "}', "{}",
]


@case
def fx_references(spark: SparkSession, sf: str) -> DataFrame:
    """References of several shapes in one form."""
    df = spark.createDataFrame(list(enumerate(RECORDS)), "i int, x string").withColumn("v", F.try_parse_json("x"))
    made = df.select("i", reference.canonical(F.col("v")).alias("r"))
    names = ["Jane Mary Bee", "Bee, Jane Mary", "J. Bee Jr.", "Ludwig van Beethoven", "de la Cruz, Maria", "Plato", "  A  B ", None]
    ids = spark.createDataFrame([("a", {"doi": "1", "arxiv": "2"}, {"doi": "1"}), ("b", {"doi": "1"}, {"arxiv": "1"}), ("c", {}, None)], "k string, a map<string,string>, b map<string,string>")
    pool = F.try_parse_json(F.lit('{"ids": {"doi": "a", "mag": "m"}, "crossref_doi": "b", "contained_arXiv_ids": [{"id": "c"}]}'))
    fields = ("title", "year")
    merge = spark.createDataFrame([(("t", None), (None, 3)), (("t", 1), ("u", 2))], "old struct<title:string,year:int>, new struct<title:string,year:int>")
    return _union(
        *(_rows(made, "i", F.lit(f), F.col(f"r.{f}")) for f in ("title", "author", "journal", "journal_volume", "journal_page", "year", "publisher", "content", "unique_id")),
        _rows(made, "i", F.lit("keep"), reference.worth_keeping(F.col("r"))), _each(spark, names, short=reference.short_name),
        _rows(ids, "k", F.lit("same"), reference.same_ids(F.col("a"), F.col("b"))), _one(spark, recommended=reference.recommended_ids(pool)),
        _rows(merge, F.lit("filled"), F.coalesce(F.col("old.year").cast("string"), F.lit("none")), reference.filled(F.col("old"), F.col("new"), fields)), _rows(made.where("i = 0"), F.lit("flat"), "i", F.struct(*reference.flattened(F.col("r")))),
    )


@case
def fx_csl(spark: SparkSession, sf: str) -> DataFrame:
    """Records in the citation style language and BibTeX entries by kind."""
    df = spark.createDataFrame(list(enumerate([*RECORDS[:2], '{"author": ["Marie S. Curie", {"given": "Plato"}, {"name": "Group"}], "journal": "N", "type": "Book", "year": 5}'])), "i int, x string")
    bib = (
        '@comment{x}\n@Article{k1, title={On {D}rifts}, author="Bee, Jane and C. Dee", journal=J # " X", year=1999, publisher={P}, address={Q}}\n@book{k2, title={T}, editor={E}, publisher={P}, address={Q}, year={2000}, isbn={9}}\n@misc{k3, }'
    )
    e = spark.createDataFrame([(bib,)], "x string").select(F.posexplode(bibtex.bibtex_udf("x")).alias("pos", "e"))
    people = F.array(F.lit("J. Bee"), F.lit("C. Dee"), F.lit("E. Eff"))
    short = citations.short_citation(people, F.lit("J. X"), F.lit("3"), F.lit("12"), F.lit(1999))
    return _union(
        _rows(df, "i", F.lit("csl"), csl.csl(F.try_parse_json("x"))), _rows(e, "pos", F.lit("entry"), F.struct("e.type", "e.key", "e.author", "e.lacking")),
        _rows(e, "pos", F.lit("fields"), F.array_sort(F.map_entries(csl.kept_fields(F.col("e.type"), F.col("e.fields"), bibtex.REQUIRED)))),
        _one(spark, short=short, good=citations.good_for_citation(people, F.lit("J")), bad=citations.good_for_citation(F.array().cast("array<string>"), F.lit("J"))),
    )


@case
def fx_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of four sources brought to entities one source after the other."""
    crossref = spark.createDataFrame([("1", "10/a", None), ("2", "10/b", ["x", "y"]), ("3", None, None), ("4", "10/c", ["x", "x"])], "row_key string, DOI string, `alternative-id` array<string>")
    scholar = spark.createDataFrame([("1", {"DOI": "10/a", "MAG": "7", "CorpusId": "1"}), ("2", {"DOI": "10/a", "ArXiv": "1"}), ("3", {"DOI": "10/c", "MAG": "7"}), ("4", {"OpenAlex": "w5"}), ("5", {})], "row_key string, externalids map<string,string>")
    entry = "struct<bib_entry_raw:string,ids:map<string,string>>"
    papers = spark.createDataFrame([(1, {"b0": ("x", {"open_alex_id": "https://openalex.org/W5", "arxiv_id": "9"}), "b1": ("y", {"doi": ""})})], f"row_id bigint, bib_entries map<string,{entry}>")
    preprints = spark.createDataFrame([("1", "9", None), ("2", "8", "10/z")], "row_key string, id string, doi string")
    sources = [("CR", identity.crossref_ids(crossref)), ("UA.SS", identity.scholar_ids(scholar)), ("UA", identity.entry_ids(papers)), ("AX", identity.preprint_ids(preprints))]
    aliases, outcomes = identity.build(sources)
    parts = [_rows(df, F.lit(f"ids {name}"), "row_key", F.array_sort(F.map_entries("ids"))) for name, df in sources]
    order = identity.entity_of(spark.createDataFrame([("a", {"mag": "7", "doi": "10/c"})], "row_key string, ids map<string,string>"), aliases, ["doi", "mag"])
    return _union(
        *parts, _rows(aliases, F.lit("alias"), F.concat_ws(":", "type", "value"), F.col("entity_id")), _rows(outcomes, F.col("source"), "row_key", F.struct("entity_id", "outcome")),
        _rows(identity.conflicts(outcomes.where("source = 'UA.SS'"), sources[1][1], aliases), F.lit("conflict"), F.concat_ws(":", "row_key", "type"), F.col("entity_id")),
        _rows(identity.lookup(aliases, "doi:10/c"), F.lit("lookup"), "entity_id", F.col("aliases")), _rows(order, F.lit("first"), "row_key", F.col("entity_id")),
    )


@case
def fx_index(spark: SparkSession, sf: str) -> DataFrame:
    """An index loaded, brought up to date and enriched (Q2 to Q7)."""
    schema = "entity_id string, n int, title string, author array<string>, journal string, journal_volume string, journal_page string, year int"
    old = [("a", 1, None, None, None, None, None, 1999), ("a", 2, "T", ["X"], "J", None, None, None), ("b", 3, "B", None, None, None, None, 2000)]
    new = [("a", 1, "Other", None, None, "5", None, None), ("b", 2, None, None, None, None, None, 1), ("c", 3, None, None, None, None, None, 7), ("c", 4, "C", None, None, None, None, None), ("d", 5, None, None, None, None, None, 8), (None, 6, "N", None, None, None, None, None)]
    fields = ("title", "author", "journal", "journal_volume", "journal_page", "year")
    done = identity.upsert(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), fields, order="n")
    aliases = spark.createDataFrame([("j", ["J", "Journal"])], "venue string, names array<string>")
    index = spark.createDataFrame([("a", None), ("b", "has")], "entity_id string, short_content string")
    offer = spark.createDataFrame([("a", "S2", True), ("a", "S1", True), ("b", "S", True), ("z", "S", True), ("a", "S0", False)], "entity_id string, t string, good boolean")
    return _union(
        _rows(done, "entity_id", F.lit("upsert"), F.struct(*fields, "outcome")), _rows(retrieval.index_record(done, aliases), "entity_id", F.lit("record"), F.struct("author_0", "author_1", "journal")),
        _rows(identity.enriched(index, offer, F.col("t"), F.col("good")), "entity_id", F.lit("enriched"), F.col("short_content")),
        _rows(identity.enrichment_census(index, offer, F.col("t"), F.col("good")), F.lit("census"), "state", F.col("rows")),
    )


@case
def fx_citations(spark: SparkSession, sf: str) -> DataFrame:
    """Joined citations split, parsers' results merged, long texts cut."""
    a, b = "Aa bb cc dd ee ff gg hh ii jj kk", "Bb bb cc dd ee ff gg hh ii jj kk"
    values = [f"{a}; {b}", f"{a}; short; {b}", f"lead; {a}", f"{a}; tail", "only short", "doi one; two", f"{a}", None]
    refs = spark.createDataFrame([("p", 0, "x" * 20), ("p", 1, "y"), ("q", 0, "z")], "paper_id string, pos int, text string")
    parsers = {"anystyle": spark.createDataFrame([("p", 0, "r0"), ("p", 1, "r1")], "paper_id string, pos int, record string"), "grobid": spark.createDataFrame([("p", 0, "g0"), ("q", 0, "h0")], "paper_id string, pos int, record string")}
    merged = citations.merged_parsers(refs, parsers)
    return _union(
        _each(spark, values, split=citations.split_citations, valid=citations.is_citation, short=lambda x: citations.shortened(x, 10)),
        _rows(merged, "paper_id", "pos", F.struct("plain_text", "anystyle", "grobid", "status")),
    )


@case
def fx_retrieval(spark: SparkSession, sf: str) -> DataFrame:
    """Clauses of searches, weights, ratios, notes and states."""
    record = F.struct(
        F.array(*map(F.lit, ("J. Bee", "C. Dee", "E. Eff", "G. Gee"))).alias("author"), F.lit("3").alias("journal_volume"), F.lit(None).cast("string").alias("journal_page"), F.lit("On drifts").alias("title"),
        F.lit("J. X").alias("journal"), F.lit(1999).alias("year"), F.lit("whole text").alias("content"),
    )
    r = spark.range(1).select(record.alias("r"))
    pairs = [("kitten", "sitting"), ("same", "same"), ("", ""), ("a" * 150 + "b" * 60, "b" * 60 + "a" * 150), (None, "x")]
    ratios = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    notes = spark.createDataFrame([("n", "one two three four five six seven eight nine ten"), ("c", "A. Bee, J. X 3 (1999)")], "cite_id string, content string")
    search, note = retrieval.without_notes(notes)
    papers = spark.createDataFrame([("a", False, 0, False, False), ("b", True, 0, False, False), ("c", True, 1, False, False), ("d", True, 1, True, True), ("e", True, 1, True, False)], "paper_id string, has_text boolean, n_text int, has_structured boolean, is_done boolean")
    named = spark.createDataFrame([("x", "see arXiv:2101.00001 now", None), ("y", "none", None), ("z", "none", "g")], "cite_id string, content string, given string")
    weights = {"equal": scoring.numeric_weight("12a", "012"), "other": scoring.numeric_weight("1", "2"), "none": scoring.numeric_weight(None, "2")}
    return _union(
        *(_rows(r, F.lit("clauses"), F.lit(e), retrieval.clauses(F.col("r"), e)) for e in ("integrate", "v21", "sentence")), _rows(ratios, F.lit("ratio"), "i", scoring.ratio_udf("a", "b")),
        _rows(search, F.lit("search"), "cite_id", F.lit(True)), _rows(note, F.lit("note"), "cite_id", F.col("found_id")), _rows(retrieval.paper_status(papers), F.lit("status"), "paper_id", F.col("status")),
        _rows(retrieval.resolved_by_id(named, given="given"), F.lit("by_id"), "cite_id", F.col("found_id")), _one(spark, weights=F.lit(str(weights)), normal=F.lit(scoring.norm(" É–ø "))),
    )


@case
def fx_grades(spark: SparkSession, sf: str) -> DataFrame:
    """Levels of citations, checks and recommendations."""
    rows = [
        (1, "anystyle", 1.0, 0, "T", {}, False), (2, "anystyle", 0.97, 0, "T", {}, False), (3, "anystyle", 0.3, 0, "T", {}, False), (4, "anystyle", 0.7, 0, "T", {}, False),
        (5, "anystyle", 0.7, 0, "On the drift", {}, False), (5, "grobid", 0.6, 1, "On the drift", {}, False), (6, "anystyle", 0.7, 0, "On the drift", {}, False), (6, "grobid", 0.6, 1, "Other", {}, False),
        (7, "anystyle", 0.7, 0, "On the drift", {"doi": "1"}, False), (7, "grobid", 0.6, 1, "Other", {"doi": "1"}, False), (8, "anystyle", None, 0, None, {}, False), (9, "anystyle", 1.0, 0, "T", {}, True),
        (10, "anystyle", 0.5, 0, "T", {}, False), (10, "anystyle", 0.95, 1, "U", {}, False),
    ]
    schema = "cite int, engine string, score double, rank int, title string, ids map<string,string>, is_note boolean"
    graded = grading.grade(spark.createDataFrame(rows, schema), ["cite"])
    known = spark.createDataFrame([("p", "k1", "Bee, On drifts of things, 1999"), ("p", "k2", "Dee, Another work, 2001"), ("q", "k3", "Bee, On drifts of things, 1999")], "paper_id string, entry_id string, text string")
    asked = spark.createDataFrame([("p", "a", "Bee, On drifts of thing, 1999"), ("p", "b", "Nothing like it"), ("p", "c", "Bee, On drifts of things, 1999; more"), ("q", "d", "Bee On drifts of things 1999")], "paper_id string, query_id string, text string")
    found = spark.createDataFrame([("p", 0, {"doi": "1"}), ("p", 1, {"doi": "2"}), ("p", 2, {"doi": "3"})], "paper_id string, pos int, ids map<string,string>")
    other = spark.createDataFrame([("p", 0, {"doi": "1"}), ("p", 1, {"doi": "9"})], "paper_id string, pos int, ids map<string,string>")
    flags = spark.createDataFrame([("a", True), ("a", True), ("b", True), ("b", False), ("c", False)], "paper_id string, hit boolean")
    return _union(
        _rows(graded, F.lit("level"), "cite", F.col("retrieved_level")), _rows(grading.recommended(asked, known), "paper_id", "query_id", F.struct("ratio", "known_id")),
        _rows(grading.double_check(found, other, ["paper_id", "pos"]), F.lit("check"), "pos", F.col("check")), _rows(grading.coverage(flags, "paper_id", "hit"), F.lit("coverage"), "paper_id", F.struct("hits", "coverage")),
    )


@case
def fx_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Shards, failures, versions, lists and settings."""
    from paperloom import settings
    from paperloom.sources import lists

    items = spark.createDataFrame([(f"i{i}",) for i in range(10)], "id string")
    tried = spark.createDataFrame([("4",), ("x",), (None,)], "x string").select("x", batch.tried(lambda x: 1 / (int(x) - 4) if x != "x" else int(x), "double", {"ValueError": "NoNumber"})("x").alias("r"))
    a, b = (spark.createDataFrame(rows, "id string, v string") for rows in ([("a", "1"), ("b", "2"), ("c", None)], [("b", "2"), ("c", "3"), ("d", "4")]))
    guard = settings.Rounds(3)
    ended = 0
    try:
        while True:
            ended = guard.next()
    except settings.TooManyRounds:
        pass
    label = lists.reference_number(F.lit("Ref.3 of ArXiv:1512.03385"))
    return _union(
        _rows(batch.shard_of(items, "id", 3), F.lit("shard"), "id", F.col("shard")), _rows(tried, F.lit("tried"), F.coalesce("x", F.lit("null")), F.struct("r.status", F.col("r.error").isNotNull().alias("failed"))),
        _rows(batch.compared(a, b, "id", "v"), F.lit("compared"), "id", F.col("verdict")), _rows(batch.unfinished(a.select("id"), b), F.lit("unfinished"), "id", F.lit(True)),
        _rows(batch.remake_set(a.limit(0), a, b, "id"), F.lit("remake"), "id", F.lit(True)), _rows(batch.excluded(a, b, "id"), F.lit("excluded"), "id", F.lit(True)),
        _rows(batch.presence(a.select("id"), {"b": b}), F.lit("presence"), "id", F.col("b")), _rows(lists.with_update(a, b, "id"), F.lit("updated"), "id", F.col("v")),
        _rows(lists.point_read(b, a, "id"), F.lit("read"), "id", F.struct("v", "found")), _one(spark, rounds=F.lit(ended), pretty=F.lit(settings.pretty({"a": 1, "b": {"c": 2}})), label=label),
        _rows(lists.counted_against(spark.createDataFrame([("p", 0), ("p", 1), ("q", 0)], "paper_id string, pos int"), spark.createDataFrame([("p", 0), ("p", 1), ("q", 0), ("q", 1), ("r", 0)], "paper_id string, n int")), F.lit("counted"), "paper_id", F.col("status")),
    )


@case
def fx_colours(spark: SparkSession, sf: str) -> DataFrame:
    """Colours of words, in and out of the palette (V1 to V4)."""
    lit = F.lit
    return _one(
        spark, first=colour.palette(lit(0)), next_red=colour.palette(lit(2601)), last=colour.palette(lit(130049)), again=colour.palette(lit(130050)),
        plain=colour.is_inserted(F.array(lit(5), lit(0), lit(10))), odd=colour.is_inserted(F.array(lit(5), lit(1), lit(10))),
        before=colour.before(F.array(lit(5), lit(0), lit(10)), F.array(lit(5), lit(5), lit(0))), far=colour.box_distance(lit(0.0), lit(0.0), lit(3.0), lit(0.0)),
        coloured=colour.coloured(lit("a \\emph{bc} $d$"), lit(0)),
    )


def queries() -> dict[str, Query]:
    return dict(FOUND)


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def oracle_sql() -> dict[str, str]:
    """What each query is expected to give, as a list of values."""
    return {
        name: 'SELECT * FROM (VALUES ' + ", ".join("(" + ", ".join(map(_quoted, row)) + ")" for row in rows) + ') AS t("group", item, value)'
        for name, rows in EXPECTED.items() if name in FOUND
    }
