"""Text, TeX, BibTeX and colour functions by example."""

from pyspark.sql import functions as F

from paperloom.functions import bibtex, colour, tex, text


def one(spark, make, *values):
    df = spark.createDataFrame([values], [f"c{i}" for i in range(len(values))]) if all(v is not None for v in values) else spark.createDataFrame(
        [values], ", ".join(f"c{i} string" for i in range(len(values)))
    )
    return df.select(make(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).collect()[0].x


def test_notes(spark):
    words = "we thank the anonymous people for many very useful remarks"
    assert one(spark, text.is_note, words) is True
    assert one(spark, text.is_note, " ".join(words.split()[:9])) is False
    for mark in ("Smith 2001", "(Bo Li, 1999)", "hep-th/9901001", "A. B. Smith", "x@y.z", "http://x", "arXiv:1"):
        assert one(spark, text.is_note, f"{words} {mark}") is False
    assert one(spark, text.is_note, "") is False and one(spark, text.is_note, None) is None


def test_labels_and_citations(spark):
    def named(left):
        r = one(spark, lambda a, b, c: text.names_before(a, b, c), left, "3", "P")
        return r.left, r.label, r.hit

    assert named("as shown in Fig.") == ("as shown in ", " [Figure.3 of P]", True)
    assert named("see Refs") == ("see  ", " [Ref.3 of P]", True)
    assert named("by config") == ("by config", "3", False)
    r = one(spark, lambda a, b: text.without_brackets(a, b), "x (", ") y")
    assert (r.left, r.right) == ("x ", " y")

    def cite(left, right):
        return one(spark, lambda a, b, c, d: text.cited(a, b, c, d), left, "K", right, "P")

    assert cite("", "goes on") == "[Ref.K of P]"
    assert cite("as shown in", "and on") == "[Ref.K of P]"
    assert cite("a result", "Next") == "(See [Ref.K of P])."
    assert one(spark, lambda a, b: text.cited(a, F.lit("<1.2>"), b, F.lit("P")), "done.", "x") == "[1.2]"


def test_small_functions(spark):
    assert one(spark, text.single_spaced, " a\n\u3000b  c ") == "a b c"
    assert one(spark, text.formula_tokens, r"\frac{a}{b} + x_{1}") == 4
    assert one(spark, text.arxiv_id, "see ArXiv: 1512.03385v2 and") == "1512.03385v2"
    assert one(spark, text.arxiv_id, "none") is None
    assert one(spark, text.four_digits, "in 12345 or 1999") == 1999
    assert one(spark, text.shrunk_brackets, "[[1]]") == "[1]"
    assert one(spark, lambda c: text.last_match(c, "ab"), "ab xab y") == 4
    assert one(spark, text.merged_authors, "author = {A B}\n author = {C D}\n title = {x}") == "author = {A B, C D}\n title = {x}"


def test_tex(spark):
    assert [one(spark, tex.file_class, n) for n in ("A.TEX", "x", "y.sty", "z.pdf", "r.txt")] == ["hard", "soft", "component", "other", "soft"]
    assert one(spark, tex.uncommented, "a % c\n% all\nb \\% d") == "a \nb \\% d"
    assert one(spark, tex.bibliography_names, r"\bibliography{a, b}\bibliography{c}") == ["a", "b"]
    assert one(spark, tex.bibliography_names, "none") == []
    assert one(spark, tex.cited_keys, r"\cite{a,b} \citep[p.~3]{c}") == ["a", "b", "c"]
    items = one(spark, tex.bib_items, "\\bibitem[X(1)]{k1} One\n two\\bibitem{k2}Three\\end{thebibliography}")
    assert [(i.label, i.key, i.content) for i in items] == [("X(1)", "k1", "One two"), (None, "k2", "Three")]
    assert one(spark, tex.plain_entry, r"\newblock {\em A title}, \textbf{3} <x>") == "A title, 3"
    assert one(spark, tex.renamed_packages, r"\usepackage[x]{amssym}") == r"\usepackage[x]{amssymb}"
    assert one(spark, tex.before_analysis, "/a/b/analysis.tex/c") == "/a/b"
    assert one(spark, tex.has_drawing, None) == "NoSource"


def test_tex_blocks():
    assert [r"a{b{c}}\{d{e"[a:b] for a, b in tex.braces(r"a{b{c}}\{d{e")] == ["{b{c}}"]
    assert tex.without_packages(r"\usepackage[o]{a, tikz}\usepackage{tikz}", frozenset(["tikz"])) == (r"\usepackage[o]{a}", ["tikz", "tikz"])
    made = tex.comment_out("\\documentclass{a}\n\\odd[x]{y{z}}\n\\newcommand{\\q}[1]{w}\n", frozenset(tex.KEPT_COMMANDS))
    assert "%\\odd[x]{y{z}}" in made and "%\\newcommand" not in made and "%\\documentclass" not in made
    fig = "\\begin{figure}x\\caption{A {b} c}\\label{f}\\end{figure}"
    assert tex.captions_only(fig, ["figure"]).splitlines()[-2:] == ["\\caption{A {b} c}", "\\label{f}"]
    done, gone = tex.standardised("\\documentclass{x}\\usepackage{tikz}\n\\begin{document}a % c\n\\end{document}", "revtex", frozenset(["tikz"]))
    assert gone == ["tikz"] and done.startswith(f"% \\documentclass{{x}}\n{tex.PLAIN_CLASS}\n") and "tikz" not in done and "% c" not in done


def test_bibtex(spark):
    src = '@article{k, author = {Doe, Jane and Max {van} Roe}, title = "A " # {b {C}}, journal={J}, year=1999}\n@comment{x}\n@book{b, title={T}}'
    got = one(spark, bibtex.bibtex_udf, src)
    assert [(e.type, e.key, e.lacking) for e in got] == [("article", "k", []), ("book", "b", ["author/editor", "publisher", "year"])]
    assert [(a.family, a.given) for a in got[0].author] == [("Doe", "Jane"), ("Roe", "Max van")] and got[0].fields["title"] == "A b C"
    assert one(spark, bibtex.bibtex_udf, "no entry") == []


def test_colours(spark):
    df = spark.range(0, 130050, 50000).select(colour.palette(F.col("id")).alias("c"))
    assert [list(r.c) for r in df.collect()] == [[5, 0, 0], [100, 55, 100], [195, 110, 200]]
    assert spark.range(1).select(colour.box_distance(F.lit(0), F.lit(0), F.lit(3), F.lit(4), 1.0).alias("d")).collect()[0].d == 5.0
