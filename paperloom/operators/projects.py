"""TeX projects: the root file of each, the state of its compilation, and its bibliography."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.tex import bibliography_names, file_class, uncommented

#: Modes of a compilation in order of preference (fixed values).
MODES = ("clean", "nopackage", "nofigure", "preamble", "revtex", "origin")


def _stem(name: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"^.*/", ""), r"(?i)\.[a-z0-9]+$", ""))


def include_edges(files: DataFrame) -> DataFrame:
    """Which file of a project takes in which: paper_id, src, dst (stems in lower case) (F1)."""
    pattern = r"\\(?:input|include|subfile)\s*\{?\s*([^\s{}\\%]+)\s*\}?"
    named = files.select(
        "paper_id", _stem(F.col("name")).alias("src"),
        F.explode(F.regexp_extract_all(uncommented(F.col("content")), F.lit(pattern), F.lit(1))).alias("target"),
    )
    return named.select("paper_id", "src", _stem(F.col("target")).alias("dst")).where("src <> dst").distinct()


def root_candidates(files: DataFrame, with_content: bool = False, needs_includes: bool = False) -> DataFrame:
    """Files that no other takes in: paper_id, name, stem (F1, F2).

    ``with_content`` keeps those that open a document, ``needs_includes`` those that take in others.
    """
    tex = files.where(file_class(F.col("name")).isin("hard", "soft")).withColumn("stem", _stem(F.col("name")))
    edges = include_edges(files)
    roots = tex.join(edges.select("paper_id", F.col("dst").alias("stem")).distinct(), ["paper_id", "stem"], "left_anti")
    if with_content:
        roots = roots.where(F.coalesce(F.contains(uncommented(F.col("content")), F.lit("\\begin{document}")), F.lit(False)))
    if needs_includes:
        roots = roots.join(edges.select("paper_id", F.col("src").alias("stem")).distinct(), ["paper_id", "stem"], "left_semi")
    return roots.select("paper_id", "name", "stem")


#: Names of supplements, and what their names hold (fixed values).
SUPPLEMENTS = ("supp", "appendix", "supplementary", "app")
SUPPLEMENT_MARKS = ("supplement", "appendix")


def is_supplement(stem: Column) -> Column:
    """Whether a file name is that of a supplement."""
    return stem.isin(*SUPPLEMENTS) | stem.rlike("|".join(SUPPLEMENT_MARKS)) | F.endswith(stem, F.lit("suppl"))


def root_files(files: DataFrame) -> DataFrame:
    """The root file of each project: paper_id, status, root.

    In order: the only candidate; one named main; the only one with a ``.bbl`` twin; the only one that
    is no supplement; the only one that opens a document. Else the project is a
    multifiles_case, or cannot_locate_main without candidate, or no_tex without TeX file.
    """
    twins = files.where(F.lower("name").endswith(".bbl")).select("paper_id", _stem(F.col("name")).alias("stem"), F.lit(True).alias("twin")).distinct()
    opens = root_candidates(files, with_content=True).select("paper_id", "stem", F.lit(True).alias("opens")).distinct()
    c = root_candidates(files).join(twins, ["paper_id", "stem"], "left").join(opens, ["paper_id", "stem"], "left")
    main = F.col("stem") == "main"

    def only(condition: Column, name: str) -> list[Column]:
        return [F.count_if(condition).alias(f"n_{name}"), F.min(F.when(condition, F.col("name"))).alias(name)]

    marks = {"all_": F.lit(True), "main": main, "twin": F.col("twin"), "body": ~is_supplement(F.col("stem")), "opens": F.col("opens")}
    counts = c.groupBy("paper_id").agg(*(x for k, v in marks.items() for x in only(F.coalesce(v, F.lit(False)), f"r_{k}")))
    root = F.coalesce(*(F.when(F.col(f"n_r_{k}") == 1, F.col(f"r_{k}")) for k in marks))
    tex = files.groupBy("paper_id").agg(F.count_if(file_class(F.col("name")).isin("hard", "soft")).alias("n_tex"))
    joined = tex.join(counts.withColumn("root", root), "paper_id", "left")
    status = (
        F.when(F.col("n_tex") == 0, "no_tex").when(F.col("root").isNotNull(), "root_file")
        .when(F.coalesce("n_r_all_", F.lit(0)) == 0, "cannot_locate_main").otherwise("multifiles_case")
    )
    return joined.select("paper_id", status.alias("status"), "root")


def folder_class(files: DataFrame) -> DataFrame:
    """isTeX, isPlainTeX or NoTeX of each project, the first that holds."""
    kind = file_class(F.col("name"))
    flags = files.groupBy("paper_id").agg(F.bool_or(kind == "hard").alias("hard"), F.bool_or(kind == "soft").alias("soft"))
    return flags.select("paper_id", F.when(F.col("hard"), "isTeX").when(F.col("soft"), "isPlainTeX").otherwise("NoTeX").alias("status"))


def log_counts(text: Column) -> Column:
    """Warnings, errors, undefined macros and missing files that a log line counts."""
    def before(words: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(text, rf"(?i)(\d+)\s+{words}", 1), F.lit("")).try_cast("int"), F.lit(0))

    return F.struct(
        before("warnings?").alias("warnings"), before("errors?").alias("errors"), before("undefined macros?").alias("macros"), before("missing files?").alias("missing")
    )


def missing_names(text: Column) -> Column:
    """Files that a log names as missing."""
    listed = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)missing files?\s*\[([^\]]*)\]"), F.lit(1)), lambda x: F.split(x, r"\s*,\s*")))
    found = F.regexp_extract_all(text, F.lit(r"(?i)(?:can't find|cannot find|not found)[^\n]*?([\w.-]+\.(?:sty|cls|tex))"), F.lit(1))
    return F.array_distinct(F.filter(F.concat(listed, found), lambda x: F.trim(x) != ""))


def log_window(lines: DataFrame, head: int = 3, tail: int = 10) -> DataFrame:
    """The first and last lines of each log, in file order (A11, G11). ``lines`` has paper_id, mode, pos, line."""
    n = lines.groupBy("paper_id", "mode").agg((F.max("pos") + 1).alias("n"))
    return lines.join(n, ["paper_id", "mode"]).where((F.col("pos") < head) | (F.col("pos") >= F.col("n") - tail)).drop("n")


def log_status(lines: DataFrame) -> DataFrame:
    """How each compilation ended: paper_id, mode, status, by the last line that tells of the conversion.

    EmptyLog without such a line, else Error, timeout, Warning or Success.
    """
    told = log_window(lines).where(F.contains("line", F.lit("Conversion ")))
    last = told.groupBy("paper_id", "mode").agg(F.max_by("line", "pos").alias("line"))
    every = lines.select("paper_id", "mode").distinct().join(last, ["paper_id", "mode"], "left")
    low = F.lower("line")
    status = (
        F.when(F.col("line").isNull(), "EmptyLog").when(low.rlike("error|fatal|failed"), "Error").when(low.contains("timeout") | low.contains("timed out"), "timeout")
        .when(low.contains("warning"), "Warning").otherwise("Success")
    )
    return every.select("paper_id", "mode", status.alias("status"))


def modes_table(status: DataFrame) -> DataFrame:
    """One row per project with the status of each mode, and whether any passed."""
    wide = status.groupBy("paper_id").pivot("mode", list(MODES)).agg(F.min("status"))
    passed = F.array_intersect(F.array_compact(F.array(*(F.col(m) for m in MODES))), F.array(F.lit("Success"), F.lit("Warning")))
    return wide.withColumn("passed", F.size(passed) > 0)


def needed_styles(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Missing style files, private if the project holds them: style, is_private, papers."""
    named = lines.select("paper_id", F.explode(missing_names(F.col("line"))).alias("style")).where("style rlike '(?i)[.](sty|cls)$'").distinct()
    own = files.select("paper_id", F.regexp_replace("name", r"^.*/", "").alias("style")).distinct().withColumn("own", F.lit(True))
    held = named.join(own, ["paper_id", "style"], "left")
    return held.groupBy("style", F.coalesce("own", F.lit(False)).alias("is_private")).agg(F.count("*").alias("papers"))


def bibliography_state(files: DataFrame) -> DataFrame:
    """What a project without references has to recover them from: paper_id, state (H8).

    named_bbl, named_bib, single_bbl, single_bib, many_bbl, many_bib, inline, cites_only or nothing.
    """
    stem = _stem(F.col("name"))
    low = F.lower("name")
    tex = files.where(file_class(F.col("name")).isin("hard", "soft"))
    named = tex.select("paper_id", F.explode(F.transform(bibliography_names(F.col("content")), _stem)).alias("stem")).distinct()
    bbl = files.where(low.endswith(".bbl")).select("paper_id", stem.alias("stem"), F.lit(1).alias("bbl"), F.lit(0).alias("bib"))
    bib = files.where(low.endswith(".bib")).select("paper_id", stem.alias("stem"), F.lit(0).alias("bbl"), F.lit(1).alias("bib"))
    kept = bbl.unionByName(bib).join(named.withColumn("named", F.lit(True)), ["paper_id", "stem"], "left")
    sums = kept.groupBy("paper_id").agg(
        F.sum("bbl").alias("bbl"), F.sum("bib").alias("bib"),
        F.bool_or(F.col("named") & (F.col("bbl") == 1)).alias("named_bbl"), F.bool_or(F.col("named") & (F.col("bib") == 1)).alias("named_bib"),
    )
    marks = tex.groupBy("paper_id").agg(
        F.bool_or(F.contains("content", F.lit("\\bibitem"))).alias("inline"), F.bool_or(F.contains("content", F.lit("\\cite"))).alias("cites")
    )
    joined = files.select("paper_id").distinct().join(sums, "paper_id", "left").join(marks, "paper_id", "left")
    state = (
        F.when(F.col("inline"), "inline").when(F.col("named_bbl"), "named_bbl").when(F.col("named_bib"), "named_bib")
        .when(F.col("bbl") == 1, "single_bbl").when(F.col("bbl") > 1, "many_bbl").when(F.col("bib") == 1, "single_bib")
        .when(F.col("bib") > 1, "many_bib").when(F.col("cites"), "cites_only").otherwise("nothing")
    )
    return joined.select("paper_id", state.alias("state"))


def with_bibliography(tex: DataFrame, bbl: DataFrame) -> DataFrame:
    """Sources with their compiled bibliography put in place of the command, or before the end (H5).

    Both have paper_id and content; a project without bibliography stays as it is.
    """
    joined = tex.join(bbl.groupBy("paper_id").agg(F.min("content").alias("bbl")), "paper_id", "left")
    command = r"\\bibliography\s*\{[^}]*\}"
    cut = F.split("content", command, 2)
    replaced = F.concat(F.get(cut, F.lit(0)), F.col("bbl"), F.coalesce(F.get(cut, F.lit(1)), F.lit("")))
    end = F.split("content", r"\\end\{document\}", 2)
    appended = F.concat(F.get(end, F.lit(0)), F.col("bbl"), F.lit("\n\\end{document}"), F.coalesce(F.get(end, F.lit(1)), F.lit("")))
    made = F.when(F.col("bbl").isNull(), F.col("content")).when(F.col("content").rlike(command), replaced).otherwise(appended)
    return joined.withColumn("content", made).drop("bbl")


def good_files(files: DataFrame, modes: tuple[str, ...] = MODES) -> DataFrame:
    """TeX files of each project without those that a mode has made; a lone one of these stands for its original.

    Status good, renamed, none or ErrorCaseI (several made ones and no original): paper_id, status, names.
    """
    made = F.lower("name").rlike(rf"\.(?:{'|'.join(modes)})\.tex$")
    bare = F.regexp_replace("name", rf"(?i)\.(?:{'|'.join(modes)})(?=\.tex$)", "")
    tex = files.where(F.lower("name").endswith(".tex")).select("paper_id", "name", made.alias("made"), bare.alias("bare"))
    held = tex.groupBy("paper_id").agg(
        F.array_sort(F.collect_set(F.when(~F.col("made"), F.col("name")))).alias("own"), F.array_sort(F.collect_set(F.when(F.col("made"), F.col("bare")))).alias("others"),
        F.count_if("made").alias("n_made"),
    )
    every = files.select("paper_id").distinct().join(held, "paper_id", "left")
    status = (
        F.when(F.size("own") > 0, "good").when(F.col("n_made") == 1, "renamed").when(F.coalesce("n_made", F.lit(0)) == 0, "none").otherwise("ErrorCaseI")
    )
    none = F.array().cast("array<string>")
    names = F.when(F.size("own") > 0, F.col("own")).when(F.col("n_made") == 1, F.col("others")).otherwise(none)
    return every.select("paper_id", status.alias("status"), names.alias("names"))


def remake_buckets(files: DataFrame) -> DataFrame:
    """Projects by what can be made of them again: paper_id, bucket (remake, multi, missing), root."""
    tex = files.where(F.lower("name").endswith(".tex"))
    n = tex.groupBy("paper_id").agg(F.count("*").alias("n"), F.min("name").alias("only"))
    roots = root_candidates(tex, with_content=True).groupBy("paper_id").agg(F.count("*").alias("n_roots"), F.min("name").alias("root"))
    joined = files.select("paper_id").distinct().join(n, "paper_id", "left").join(roots, "paper_id", "left")
    one, none = F.col("n") == 1, F.coalesce("n", F.lit(0)) == 0
    bucket = F.when(none, "missing").when(one, "remake").when(F.col("n_roots") > 1, "multi").when(F.col("n_roots") == 1, "remake").otherwise("missing")
    return joined.select("paper_id", bucket.alias("bucket"), F.when(bucket == "remake", F.when(one, F.col("only")).otherwise(F.col("root"))).alias("root"))


#: Endings of files that a TeX project needs (fixed values).
NEEDED = (".tex", ".ps", ".bbl", ".sty", ".cls", ".bst", ".bib", ".bbx", ".tikz", ".csv", ".clo", ".cbx", ".dtx", ".fls")


def needed_files(listing: DataFrame, flag: str, line: str = "line") -> DataFrame:
    """Paths of a listing that carry a flag and end as needed files do: path, the second word of the line."""
    t = F.trim(line)
    ends = F.lower(t).rlike("(?:" + "|".join(e.replace(".", r"\.") for e in NEEDED) + ")$")
    return listing.where(F.contains(line, F.lit(flag)) & ends).select(F.get(F.split(t, r"\s+"), F.lit(1)).alias("path"))


#: Lists of bibliographies that are no bibliography of the paper (fixed values).
COMMON_BIBLIOGRAPHIES = ("IEEEabrv", "anthology")


def reference_triage(roots: DataFrame, files: DataFrame, missing: DataFrame) -> DataFrame:
    """Papers without references by what they can be recovered from: paper_id, bucket (H8, ten buckets).

    ``roots`` has paper_id, name and content of the root file, ``missing`` paper_id and n of cited keys
    that no reference has. Buckets tell whether the source names bibliographies (noref or ref), and which
    of them, compiled (bbl) or not (bib), are there.
    """
    own = F.regexp_replace("name", r"(?i)\.tex$", "")
    named = F.filter(bibliography_names(uncommented(F.col("content"))), lambda x: ~x.isin(*COMMON_BIBLIOGRAPHIES))
    asked = roots.select("paper_id", own.alias("own"), named.alias("names"))
    have = files.groupBy("paper_id").agg(F.collect_set(F.regexp_replace("name", r"^.*/", "")).alias("have"))
    miss = missing.select("paper_id", F.col("n").alias("n_missing"))
    t = asked.join(have, "paper_id", "left").join(miss, "paper_id", "left")

    def there(name: Column, ending: str) -> Column:
        return F.coalesce(F.array_contains("have", F.concat(F.regexp_replace(name, r"\.(?:bib|bbl)$", ""), F.lit(ending))), F.lit(False))

    bbl = F.size(F.filter("names", lambda x: there(x, ".bbl")))
    bib = F.size(F.filter("names", lambda x: ~there(x, ".bbl") & there(x, ".bib")))
    t = t.withColumns({"n": F.size("names"), "bbl": bbl, "bib": bib, "root_bbl": there(F.col("own"), ".bbl"), "root_bib": there(F.col("own"), ".bib")})
    whole = F.col("n") == F.col("bbl") + F.col("bib")
    bucket = (
        F.when((F.col("n") == 0) & F.col("root_bbl"), "noref_but_bbl").when((F.col("n") == 0) & F.col("root_bib"), "noref_but_bib")
        .when((F.col("n") == 0) & (F.coalesce("n_missing", F.lit(0)) == 0), "noref_no_cite").when(F.col("n") == 0, "noref_other_bib")
        .when((F.col("bbl") == F.col("n")) | F.col("root_bbl"), "ref_bbl_complete")
        .when(whole & (F.col("bbl") > 0), "ref_part_bbl").when(whole, "ref_only_bib")
        .when(F.col("bbl") > 0, "ref_incomplete_bbl").when(F.col("bib") > 0, "ref_incomplete_bib").otherwise("ref_no_bib")
    )
    return t.select("paper_id", bucket.alias("bucket"))


def reference_readiness(papers: DataFrame) -> DataFrame:
    """Papers by their reference text: pass, empty_reference or no_reference (H9). ``papers`` has paper_id, text."""
    status = F.when(F.col("text").isNull(), "no_reference").when(F.length("text") > 0, "pass").otherwise("empty_reference")
    return papers.select("paper_id", status.alias("status"))


def allowed_failures(counts: DataFrame) -> DataFrame:
    """Failed conversions whose errors all come from undefined macros and missing files (G8). ``counts`` has errors, macros, missing."""
    return counts.withColumn("is_allowed", (F.col("errors") > 0) & (F.col("errors") <= F.col("macros") + F.col("missing")))


def moved(states: DataFrame) -> DataFrame:
    """Where a converted project belongs: done, or kept aside without a bibliography (G12). ``states`` has paper_id, passed, has_bib."""
    return states.select("paper_id", F.when(F.col("passed") & F.col("has_bib"), "done").when(F.col("passed"), "without_bibliography").otherwise("unprocessed").alias("place"))


def cleaned_listing(files: DataFrame) -> DataFrame:
    """Files to keep of each project, with plain endings; prints and pictures go, and projects without TeX are named."""
    low = F.lower("name")
    name = F.regexp_replace("name", r"\.TEX$", ".tex")
    kept = files.where(~low.rlike(r"\.(?:ps|pdf|eps)$")).select("paper_id", name.alias("name"))
    has = kept.groupBy("paper_id").agg(F.bool_or(F.endswith(F.col("name"), F.lit(".tex"))).alias("has_tex"))
    every = files.select("paper_id").distinct().join(has, "paper_id", "left").select("paper_id", F.coalesce("has_tex", F.lit(False)).alias("has_tex"))
    return every.join(kept.groupBy("paper_id").agg(F.array_sort(F.collect_set("name")).alias("names")), "paper_id", "left")
