"""Documents, projects, unarXive conversion, sources, sinks and streams."""

import gzip
import io
import json
import tarfile

from pyspark.sql import functions as F

from paperloom.functions.document import extract
from paperloom.operators import documents, projects, unarxive
from paperloom.sources import lists, sinks
from paperloom.streaming import arrivals

XML = """<document xmlns="http://dlmf.nist.gov/LaTeXML"><title>On drifts</title><creator><personname>Jane Doe</personname></creator>
<abstract><p>We show it.</p></abstract>
<section labels="S1" xml:id="S1"><tags><tag role="refnum">1</tag></tags><title>Start</title>
<para><p>As <cite><bibref bibrefs="k1,k2"/></cite> shows, <Math tex="x^2" mode="inline"/> grows<note>A footnote.</note>. See <ref labelref="F1"/>.</p></para>
<equation labels="E1"><tags><tag role="refnum">(3)</tag></tags><Math tex="a=b" mode="display"/></equation>
<figure labels="F1"><graphics graphic="f.png" xml:id="g"/><caption><tag>Figure 2</tag>A plot.</caption></figure>
<table labels="T1"><caption><tag>Table 1</tag>Rows.</caption><tabular><tr><td>a</td><td>b</td></tr><tr><td>1</td><td>2</td></tr></tabular></table>
<subsection><tags><tag role="refnum">1.1</tag></tags><title>Inner</title><para><p>Text <text font="bold">bold</text> end.</p></para></subsection></section>
<acknowledgements>Thanks.</acknowledgements>
<bibliography><biblist><bibitem key="k1"><tags><tag role="key">K</tag></tags><bibblock>J. Doe, A work, 1999.</bibblock></bibitem></biblist></bibliography></document>"""
HTML = """<html><body><nav><ul><li>menu</ul></nav><article><h1>On jets</h1><p>First <b>bold</b> &amp; more<p>Second <a href="#r1" class="ltx_ref">x</a>
<section id="s1"><h2>Part</h2><p>Inner.</p></section><script>var x;</script></article></body></html>"""


def test_xml():
    d = extract(XML, "P", False)
    assert (d["status"], d["title"], d["author"], d["abstract"], d["acknowledge"]) == ("Finish", "On drifts", ["Jane Doe"], "We show it.", "Thanks.")
    assert [(r["key"], r["text"], r["is_note"]) for r in d["references"]] == [("k1", "J. Doe, A work, 1999.", False)]
    assert d["cited"] == {"k1": 1, "k2": 1, "F1": 1} and d["missing"] == ["k2"]
    assert d["labels"]["F1"] == {"type": "Figure", "label": "2"} and d["labels"]["E1"]["label"] == "3" and d["labels"]["S1"]["label"] == "1"
    assert d["media"]["T1"]["source"] == "| a | b |\n| --- | --- |\n| 1 | 2 |" and d["media"]["F1"]["caption"] == "A plot."
    text = "\n".join(b["text"] for b in d["blocks"])
    assert "$x^2$" in text and "[Figure.2 of P]" in text and "Ref.0" in text and "$$ a=b $$" in text and "**bold**" in text and "A footnote." in text
    assert [(b["path"], b["text"]) for b in d["blocks"] if b["kind"] == "heading"] == [([0], "Start"), ([0, 0], "Inner")]


def test_html():
    d = extract(HTML, "P", True)
    assert d["status"] == "Finish" and d["title"] == "On jets"
    assert [b["text"] for b in d["blocks"] if b["kind"] != "heading"][:1] == ["First **bold** & more"] and "menu" not in str(d["blocks"]) and "var x" not in str(d)


def test_statuses():
    long = "x" * 200
    assert extract(None, "P", False)["status"] == "NoXML" and extract("<a/>", "P", False)["status"] == "TooSmall"
    assert extract(long, "P", False)["status"] == "ParseError" and extract(f"<a>{long}", "P", False)["status"] == "Finish" and extract(f"<p>{long}", "P", True)["status"] == "NoArticle"
    assert extract("<article>" + "<div>" * 5000 + long, "P", True)["status"] in ("Finish", "TooDeep")


def test_tables_and_markdown(spark):
    df = spark.createDataFrame([("P", XML), ("Q", None), ("R", "<a>")], "paper_id string, content string")
    papers = documents.converted(df)
    assert {r.paper_id: r.status for r in papers.collect()} == {"P": "Finish", "Q": "NoXML", "R": "TooSmall"}
    assert [(r.key, r.in_context) for r in documents.references(papers).collect()] == [("k1", True)]
    assert {(r.key, r.n) for r in documents.citation_counts(papers).collect()} == {("k1", 1), ("k2", 1), ("F1", 1)}
    assert [(r.n, r.key) for r in documents.missing_citations(papers).collect()] == [(0, "k2")]
    md = documents.markdown(papers).collect()[0].markdown
    assert md.startswith("# Abstract\n\nWe show it.") and "## Start" in md and "### Inner" in md and "| a | b |" in md and "![g](f.png)" in md
    found = spark.createDataFrame([("P", 0, "doi:1"), ("P", 0, "doi:2")], "paper_id string, pos int, found_id string")
    assert documents.inline_results(papers, found).collect()[0].label in ("<doi:1,doi:2>", "<doi:2,doi:1>")


def files(spark, *rows):
    return spark.createDataFrame(rows, "paper_id string, name string, content string")


def test_projects(spark):
    doc = "\\begin{document}\\cite{x}\\bibliography{refs}"
    f = files(
        spark, ("a", "a/Main.tex", doc + "\\input{sec/Intro}"), ("a", "a/intro.tex", "x"), ("a", "a/refs.bbl", "\\bibitem{k} y"), ("b", "one.tex", "%\\begin{document}"),
        ("c", "x.tex", "\\begin{document}"), ("c", "y.tex", "\\begin{document}"), ("d", "p.pdf", None), ("e", "l.tex", "\\input{m}"), ("e", "m.tex", "\\input{l}"),
    )
    got = {r.paper_id: (r.status, r.root) for r in projects.root_files(f).collect()}
    assert got == {"a": ("root_file", "a/Main.tex"), "b": ("root_file", "one.tex"), "c": ("multifiles_case", None), "d": ("no_tex", None), "e": ("cannot_locate_main", None)}
    assert {r.paper_id: r.state for r in projects.bibliography_state(f).collect()} == {"a": "named_bbl", "b": "nothing", "c": "nothing", "d": "nothing", "e": "nothing"}
    assert {r.paper_id: r.status for r in projects.folder_class(f).collect()}["d"] == "NoTeX"
    made = projects.with_bibliography(f.where("name like '%ain.tex'"), f.where("name like '%bbl'")).collect()[0].content
    assert "\\bibitem{k} y" in made and "\\bibliography" not in made


def test_logs(spark):
    rows = [("a", "clean", i, x) for i, x in enumerate(["start", "Conversion complete: 3 warnings; 1 error", "missing file[odd.sty, my.sty]"])]
    rows += [("b", "clean", 0, "nothing"), ("b", "origin", 0, "Conversion complete: No obvious problems")]
    lines = spark.createDataFrame(rows, "paper_id string, mode string, pos int, line string")
    status = projects.log_status(lines)
    assert {(r.paper_id, r.mode): r.status for r in status.collect()} == {("a", "clean"): "Error", ("b", "clean"): "EmptyLog", ("b", "origin"): "Success"}
    assert {r.paper_id: r.passed for r in projects.modes_table(status).collect()} == {"a": False, "b": True}
    c = lines.where("pos = 1").select(projects.log_counts(F.col("line")).alias("c")).collect()[0].c
    assert (c.warnings, c.errors, c.macros, c.missing) == (3, 1, 0, 0)
    need = projects.needed_styles(lines, files(spark, ("a", "a/my.sty", "")))
    assert {(r.style, r.is_private) for r in need.collect()} == {("odd.sty", False), ("my.sty", True)}


def test_unarxive(spark):
    schema = (
        "row_id bigint, paper_id string, body_text array<struct<section:string,sec_number:string,text:string>>, "
        "bib_entries map<string,struct<bib_entry_raw:string,ids:map<string,string>>>, ref_entries map<string,struct<type:string,latex:string,caption:string>>"
    )
    body = [("In", "1", "As {{cite:a}} said $x$"), ("In", "1", "goes on {{formula:f}}."), ("In", "1", "New {{odd:q}}."), ("", "1-A", "App {{figure:g}}."), ("Z", "2", "References"), ("Z", "2", "Entry."), ("Z", "2", None)]
    row = (1, "p", body, {"a": ("A; B", {"doi": "x"}), "b": ("B", {"doi": " "}), "c": ("C", {"doi": "y"})}, {"f": ("formula", "e=1", None), "g": ("figure", None, "c")})
    df = spark.createDataFrame([row, (2, "q", None, None, None)], schema)
    s = {r.section_num: (r.section_title, r.section_content, r.is_appendix) for r in unarxive.sections(df).collect()}
    assert s == {
        "1": ("In", ["As [Ref.0 of ArXiv:p] said $x$ goes on $e=1$.", "New {{odd:q}}."], False), "1-A": ("Appendix 1A", ["App [Figure.0 of ArXiv:p]."], True),
    }
    assert {r.bib_key: r.is_resolved for r in unarxive.resolved_citations(df).collect()} == {"a": False, "b": False, "c": True}
    rows = spark.createDataFrame([(1, "1", i, "w " * n) for i, n in enumerate([300, 300, 100, 20])], "row_id bigint, section_num string, pos int, text string")
    assert sorted(r.n_words for r in unarxive.packed(rows).collect()) == [300, 420]


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path
    (p / "x.filelist").write_text("/a/b\n\n /c \n")
    (p / "x.arxivids").write_text("1\n2\n")
    assert [r.path for r in lists.work_list(spark, str(p / "x.filelist")).collect()] == ["/a/b", "/c"]
    assert [r.path for r in lists.work_list(spark, str(p / "x.arxivids"), "/d/").collect()] == ["/d/1", "/d/2"]
    assert [r.path for r in lists.work_list(spark, "1512.1", "/d").collect()] == ["/d/1512.1"]
    assert lists.work_list(spark, str(p)).count() == 2 and lists.text_lines(spark, str(p / "none")).count() == 0
    with gzip.open(p / "items.json.gz", "wt") as f:
        json.dump({"items": [{"DOI": "a"}, {"DOI": "b"}]}, f)
    assert lists.item_records(spark, str(p / "items.json.gz")).count() == 2
    (p / "r.jsonl").write_text('{"a": 1}\n{"a": \n\n')
    assert [r.record is None for r in lists.json_records(spark, str(p / "r.jsonl")).select("line", F.to_json("record").alias("record")).collect()] == [False, True]
    (p / "arch").mkdir()
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        for name, data in (("m.tex", b"\\documentclass"), ("f.png", b"x")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    (p / "arch/a.tar.gz").write_bytes(buf.getvalue())
    (p / "arch/b").write_bytes(gzip.compress(b"\\begin{document}"))
    (p / "arch/c.pdf").write_bytes(b"%PDF-1")
    (p / "arch/d.gz").write_bytes(b"\x1f\x8bxx")
    got = {(r.path[-8:], r.member, r.status) for r in lists.archive_members(spark, str(p / "arch")).collect()}
    assert {(m, s) for _, m, s in got} == {("m.tex", "member"), ("", "plain"), ("", "pdf"), ("", "broken")}
    (p / "t.tei.xml").write_text('<T xmlns="t"><biblStruct><title level="a">A</title><persName><forename>J</forename> <surname>D</surname></persName><title level="j">Jo</title></biblStruct><biblStruct/></T>')
    tei = lists.tei_records(spark, str(p / "t.tei.xml")).orderBy("pos").collect()
    assert [(r.pos, r.title, list(r.author), r.journal) for r in tei] == [(0, "A", ["J D"], "Jo"), (1, None, [], None)]
    df = spark.createDataFrame([("6101.1", "ok"), ("6101.1", "ok"), ("x", None)], "paper_id string, status string")
    sinks.write_by_month(df, str(p / "m"))
    sinks.write_status_lists(df, str(p / "s"), "paper_id")
    assert {r.yymm for r in spark.read.parquet(str(p / "m")).select(F.col("yymm").cast("string")).collect()} == {"6101", "none"}
    assert spark.read.text(str(p / "s/status=ok")).count() == 1
    assert sinks.write_index(df.withColumnRenamed("paper_id", "entity_id"), str(p / "i"), "1").count() == 0


def test_stream(spark, tmp_path, sf):
    rows = spark.read.parquet(f"{sf}/raw_rows.parquet")
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = arrivals.arriving(spark, str(tmp_path / "in"), rows.schema, 1)
    arrivals.run_to_end(stream.select("record_id"), str(tmp_path / "out"), str(tmp_path / "cp"))
    arrivals.run_to_end(stream.select("record_id"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()
    counted = arrivals.status_by_window(stream, "received_at", "feed")
    arrivals.run_to_end(counted, str(tmp_path / "n"), str(tmp_path / "cp2"))
    assert spark.read.parquet(str(tmp_path / "n")).count() > 0
