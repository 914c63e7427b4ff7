"""Markup: kinds and clean text by example, edge cases."""

import pytest
from pyspark.sql import functions as F

from paperloom.llm import markup

CASES = [
    ("a <b>bold</b> word", {"html"}, "a bold word"), ("x&nbsp;y &lt; 3 &#62; 2", {"html"}, "x\u00a0y < 3 > 2"), ("t <!-- note --> u", {"html"}, "t  u"),
    ("<ul><li>one<li>two</ul>", {"html"}, "- one\n- two"), ("<h2>Results</h2>text", {"html"}, "# Results\ntext"),
    ("<pre><code>for k:\n    run(*k*)</code></pre>", {"html"}, "```\nfor k:\n    run(*k*)\n```"),
    ("a **bold** and *soft* one", {"markdown"}, "a bold and soft one"), ("# Head\ntext", {"markdown"}, "# Head\ntext"),
    ("Head\n====\ntext", {"markdown"}, "# Head\ntext"), ("* one\n* two", {"markdown"}, "- one\n- two"), ("1. one\n2. two", {"markdown"}, "1. one\n2. two"),
    ("[t](https://x.y/z) ![alt](f.png)", {"markdown"}, "t alt"), ("> said", {"markdown"}, "said"), ("fact.[^3]\n\n[^3]: note", {"markdown"}, "fact.\n\nnote"),
    ("| a | b |\n|---|---|\n| 1 | 2 |", {"markdown"}, "| a | b |\n| 1 | 2 |"), ("```c\nx = <b>\n```", {"markdown"}, "```c\nx = <b>\n```"), ("a `code` b", {"markdown"}, "a `code` b"),
    ("'''bold''' ''soft''", {"wiki"}, "bold soft"), ("== Head ==\nt", {"wiki"}, "# Head\nt"), ("a [[File:p.png|thumb|cap]] [[b|c]] [[d]]", {"wiki"}, "a cap c d"),
    ("v {{val|1.5|u=K}}{{cite|x}}", {"wiki"}, "v 1.5 K"), ("__NOTOC__\ntext", {"wiki"}, "text"), ("{| class=w\n! h\n|-\n| 1\n|}", {"wiki"}, "| h |\n| 1 |"),
    (r"a \emph{b \textbf{c}} d", {"latex"}, "a b c d"), (r"\section{Head} t", {"latex"}, "# Head\n t"), (r"23\% off", {"latex"}, "23% off"),
    ("\\begin{itemize}\n\\item x\n\\item y\n\\end{itemize}", {"latex"}, "- x\n- y"), ("\\begin{equation}\nx = 1 \\label{e}\n\\end{equation}", {"latex"}, "$$x = 1$$"),
    (r"as \cite{k1} shows", {"latex"}, "as [k1] shows"),
    ("a &#8212; b&#x2014;c &eacute;t&eacute; &copy; 1", {"html"}, "a — b—c été © 1"), (r"rate \frac{a}{b} holds", {"latex"}, r"rate $\frac{a}{b}$ holds"),
    (r"\section{A {\bf b} c}", {"latex"}, "# A b c"), (r"\emph{\textbf{\textit{\textsc{d}}}} e", {"latex"}, "d e"),
    ("<pre>x = 1\ny = 2", {"html"}, "```\nx = 1\ny = 2\n```"), ("see [[A|b [[c]]]] d", {"wiki"}, "see b c d"),
    (r"of \delta and \Omega in \LaTeX", {"latex"}, r"of $\delta$ and $\Omega$ in LaTeX"), (r"so \[ x_{1} \] holds", {"latex"}, "so $$x_{1}$$ holds"),
]
PLAIN = [
    "Here a < b and c > 9 hold.", "(p<0.04)", "A grid of 74 * 8 points * 2", "The flag max_cluster_size is off.", "Files sit in C:\\data\\prior.", "C# 6 is slower",
    "Sample #17 was lost [sic].", "We test a == b before.", "The R&D budget", "uses the <unk> token", "For |x| < 1 and |y| > 2", "[Ref.56 of ArXiv:6010.07903]",
    r"grows as $\sigma^{6}$ and $a_{1} < \gamma \le b^{*}$", "$$\\int_0^{1} x dx = \\frac{1}{5}$$", "it's and it's", "3. We find", "",
]


def run(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [(set(r.k), r.c) for r in df.select("i", markup.kinds(F.col("text")).alias("k"), markup.clean(F.col("text")).alias("c")).orderBy("i").collect()]


def test_cases(spark):
    got = run(spark, [c[0] for c in CASES])
    bad = [(c, g) for c, g in zip(CASES, got, strict=True) if g != (c[1], c[2])]
    assert not bad, bad


def test_plain_text_has_no_kind_and_stays(spark):
    got = run(spark, PLAIN)
    assert [(p, g) for p, g in zip(PLAIN, got, strict=True) if g != (set(), p.strip())] == []


def test_rows(spark):
    rows = [(1, ["<b>x</b>", None, "", "  ", "**y**"], 0), (1, ["<b>x</b>", None, "", "  ", "**y**"], 0), (2, None, 0), (3, [], 0)]
    df = spark.createDataFrame(rows, "section_id bigint, section_content array<string>, kind int")
    assert sorted(map(tuple, markup.residue(df).collect())) == [(1, 0, "html"), (1, 4, "markdown")]
    assert sorted((r.section_id, r.para_pos) for r in markup.cleaned(df).collect()) == [(1, i) for i in range(5)]
    assert markup.residue(df.limit(0)).count() == 0


@pytest.mark.parametrize("unit", ["<b>", "*a", "[[", "{{", "\\x{", "$", "`", "''", "| "])
def test_long_odd_texts_end(spark, unit):
    run(spark, [unit * 3000])
