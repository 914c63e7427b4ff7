"""Queries of the engine's own operators over the test tables, and the SQL that they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import bibtex, colour, reference, scoring, tex, text
from paperloom.operators import batch, citations, documents, grading, identity, retrieval, unarxive
from paperloom.session import persist_table, table

Query = Callable[[SparkSession, str], DataFrame]
SQL: dict[str, str] = {}
FOUND: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL if there is one."""
    def add(f: Query) -> Query:
        FOUND[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _raw_entries(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "papers").select("row_id", "paper_id", F.posexplode(F.map_entries("bib_entries")).alias("pos", "e"))
    return rows.select("row_id", "paper_id", "pos", F.col("e.key").alias("bib_key"), F.col("e.value.bib_entry_raw").alias("text"))


_ENTRIES = (
    "(SELECT row_id, paper_id, unnest(range(len(l))) AS pos, unnest(l).key AS bib_key, unnest(l).value.bib_entry_raw AS text "
    "FROM (SELECT row_id, paper_id, map_entries(bib_entries) AS l FROM papers))"
)


# Scans, projection, filters

@query("SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en' AND n_chars > 1000")
def a_scan_filter(spark: SparkSession, sf: str) -> DataFrame:
    """A scan that reads three columns and pushes both conditions down."""
    return table(spark, sf, "documents").where("lang = 'en' and n_chars > 1000").select("doc_id", "lang", "n_chars")


@query("SELECT record_id, json_valid(line) AND line IS NOT NULL AND trim(line) <> '' AS ok FROM raw_rows WHERE line IS NOT NULL AND trim(line) <> ''")
def a_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines read with varying shapes; whether each is whole."""
    rows = table(spark, sf, "raw_rows").where("line is not null and trim(line) <> ''")
    return unarxive.json_lines(rows).select("record_id", (~F.col("is_broken")).alias("ok"))


@query("SELECT paper_id, regexp_extract(paper_id, '(\\d{4})', 1) AS yymm, count(*) AS deliveries FROM papers GROUP BY ALL")
def b_month_folders(spark: SparkSession, sf: str) -> DataFrame:
    """The month folder of each paper."""
    papers = table(spark, sf, "papers")
    return papers.groupBy("paper_id", text.yymm(F.col("paper_id")).alias("yymm")).agg(F.count("*").alias("deliveries"))


# Batches

@query("""
WITH r AS (SELECT paper_id, row_number() OVER (ORDER BY paper_id) - 1 AS k, count(*) OVER () AS n FROM (SELECT DISTINCT paper_id FROM papers))
SELECT r.paper_id, max(s.i)::int AS shard FROM r, range(7) s(i) WHERE r.k >= floor(s.i * r.n / 7.0) GROUP BY r.paper_id""")
def c1_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Range shards of the papers."""
    return batch.shard_of(table(spark, sf, "papers").select("paper_id").distinct(), "paper_id", 7)


@query("""
SELECT CASE WHEN text IS NULL THEN 'none' WHEN trim(text, chr(32)||chr(9)||chr(10)||chr(13)) = '' THEN 'blank' WHEN length(text) < 100 THEN 'small' ELSE 'Finish' END AS status,
  count(*) AS items FROM documents GROUP BY 1""")
def c4_status_census(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by status."""
    blank = F.btrim("text", F.lit(" \t\n\r")) == ""
    status = batch.case_of((F.col("text").isNull(), "none"), (blank, "blank"), (F.length("text") < 100, "small"), other="Finish")
    return batch.status_census(table(spark, sf, "documents").withColumn("status", status))


@query("SELECT DISTINCT paper_id FROM papers WHERE paper_id NOT IN (SELECT paper_id FROM sections WHERE paper_id IS NOT NULL)")
def c5_unfinished(spark: SparkSession, sf: str) -> DataFrame:
    """Papers that have no converted sections yet."""
    papers, done = table(spark, sf, "papers").select("paper_id").distinct(), table(spark, sf, "sections")
    return batch.unfinished(papers, done, "paper_id")


@query("""
WITH o AS (SELECT paper_id, count(*) AS n FROM papers GROUP BY 1), n AS (SELECT paper_id, count(*) AS n FROM sections WHERE paper_id IS NOT NULL GROUP BY 1)
SELECT coalesce(o.paper_id, n.paper_id) AS paper_id, CASE WHEN o.paper_id IS NULL THEN 'new' WHEN n.paper_id IS NULL THEN 'gone'
  WHEN o.n = n.n THEN 'same' ELSE 'different' END AS verdict FROM o FULL JOIN n ON o.paper_id = n.paper_id""")
def u1_compared(spark: SparkSession, sf: str) -> DataFrame:
    """Old and new lists of papers compared."""
    old = table(spark, sf, "papers").groupBy("paper_id").agg(F.count("*").alias("n"))
    new = table(spark, sf, "sections").where("paper_id is not null").groupBy("paper_id").agg(F.count("*").alias("n"))
    return batch.compared(old, new, "paper_id", "n")


@query("""
SELECT DISTINCT p.paper_id, p.paper_id IN (SELECT paper_id FROM sections WHERE paper_id IS NOT NULL) AS has_sections,
  p.paper_id IN (SELECT paper_id FROM documents WHERE paper_id IS NOT NULL) AS has_documents FROM papers p""")
def u6_presence(spark: SparkSession, sf: str) -> DataFrame:
    """Which outputs of each paper exist."""
    papers = table(spark, sf, "papers").select("paper_id").distinct()
    outputs = {"has_sections": table(spark, sf, "sections"), "has_documents": table(spark, sf, "documents")}
    return batch.presence(papers, {k: v.where("paper_id is not null") for k, v in outputs.items()}, "paper_id")


# Text functions

@query("SELECT doc_id, trim(regexp_replace(text, '[\\s\\x{A0}\\x{85}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{1680}\\x0B]+', ' ', 'g')) AS text FROM documents")
def l1_single_spaced(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with single blanks."""
    return table(spark, sf, "documents").select("doc_id", text.single_spaced(F.col("text")).alias("text"))


@query(f"""
SELECT row_id, bib_key, regexp_matches(text, '\\b(?:17|18|19|20)\\d{{2}}(?:\\D|$)') AS has_year,
  nullif(regexp_extract(lower(text), 'arxiv:? *\\s*(\\d{{4}}\\.\\d{{4,5}}(?:v\\d+)?)', 1), '') AS arxiv,
  try_cast(nullif(regexp_extract(text, '\\b(\\d{{4}})\\b', 1), '') AS int) AS number FROM {_ENTRIES}""")
def l10_citation_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Marks of citations in bibliography texts."""
    t = F.col("text")
    return _raw_entries(spark, sf).select(
        "row_id", "bib_key", text.has_year(t).alias("has_year"), text.arxiv_id(t).alias("arxiv"), text.four_digits(t).alias("number")
    )


_WORDS = "[\\p{L}\\p{N}_\\s]"


@query(f"""
SELECT row_id, bib_key, NOT regexp_matches(text, '\\b(?:17|18|19|20)\\d{{2}}(?:\\D|$)')
  AND NOT regexp_matches(text, '\\({_WORDS}+, \\d{{4}}\\)|\\({_WORDS}+ \\d+\\)|\\(\\d{{4}}, {_WORDS}+\\)')
  AND NOT regexp_matches(text, '/\\d{{6,7}}\\b') AND NOT regexp_matches(text, '@|http|arXiv:')
  AND NOT regexp_matches(text, '\\b(?:[A-Z].?\\s+)+[A-Z][a-z]+(?:\\s?-?\\s?[A-Z][a-z]+)*\\b')
  AND len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) >= 10 AS is_note FROM {_ENTRIES}""")
def l9_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Bibliography texts that are notes."""
    return _raw_entries(spark, sf).select("row_id", "bib_key", text.is_note(F.col("text")).alias("is_note"))


@query("""
SELECT section_id, para_pos, len(regexp_extract_all(text, '\\\\[a-zA-Z]+\\{[^}]*\\}|\\\\[a-zA-Z]+|\\w(?:_\\{[^}]*\\}|\\^\\{[^}]*\\})?|[\\w+-/*]'))::int AS tokens
FROM (SELECT section_id, unnest(range(len(section_content))) AS para_pos, unnest(section_content) AS text FROM sections) WHERE text IS NOT NULL""")
def l3_formula_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Effective TeX tokens of paragraphs."""
    rows = table(spark, sf, "sections").select("section_id", F.posexplode("section_content").alias("para_pos", "text"))
    return rows.where("text is not null").select("section_id", F.col("para_pos").cast("bigint").alias("para_pos"), text.formula_tokens(F.col("text")).alias("tokens"))


@query("""
SELECT section_id, para_pos, k AS pos, key FROM (SELECT section_id, para_pos, unnest(range(len(ks))) AS k, unnest(ks) AS key FROM (
  SELECT section_id, para_pos, list_filter(flatten(list_transform(regexp_extract_all(text, '\\\\cite[a-zA-Z]*\\*?(?:\\[[^\\]]*\\])*\\{([^}]*)\\}', 1),
    lambda x: list_transform(string_split(x, ','), lambda y: trim(y)))), lambda x: x <> '') AS ks
  FROM (SELECT section_id, unnest(range(len(section_content))) AS para_pos, unnest(section_content) AS text FROM sections) WHERE text IS NOT NULL))""")
def h2_cited_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of cite commands in paragraphs."""
    rows = table(spark, sf, "sections").select("section_id", F.posexplode("section_content").alias("para_pos", "text"))
    found = rows.select("section_id", F.col("para_pos").cast("bigint").alias("para_pos"), F.posexplode(tex.cited_keys(F.col("text"))).alias("pos", "key"))
    return found.withColumn("pos", F.col("pos").cast("bigint"))


# unarXive conversion

@query("""
WITH r AS (SELECT row_id, unnest(range(len(l))) AS pos, unnest(l).key AS entry_key, lower(trim(unnest(l).value.type)) AS kind, unnest(l).value.latex AS latex
  FROM (SELECT row_id, map_entries(ref_entries) AS l FROM papers)),
b AS (SELECT row_id, unnest(range(len(l))) AS pos, unnest(l).key AS entry_key, 'cite' AS kind, NULL AS latex FROM (SELECT row_id, map_entries(bib_entries) AS l FROM papers)),
n AS (SELECT *, row_number() OVER (PARTITION BY row_id, kind ORDER BY pos) - 1 AS n FROM (SELECT * FROM r UNION ALL SELECT * FROM b))
SELECT row_id, entry_key, kind, n, CASE WHEN kind = 'formula' THEN '$' || coalesce(latex, '') || '$' ELSE coalesce('[' ||
  CASE kind WHEN 'figure' THEN 'Figure' WHEN 'table' THEN 'Table' WHEN 'cite' THEN 'Ref' END || '.' || n || ' of ArXiv:' || paper_id || ']', '') END AS value
FROM n JOIN papers USING (row_id)""")
def m12_entry_values(spark: SparkSession, sf: str) -> DataFrame:
    """What each mark stands for."""
    return unarxive.entry_values(table(spark, sf, "papers")).select("row_id", "entry_key", "kind", F.col("n").cast("bigint").alias("n"), "value")


@query()
def m9_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs of deliveries with marks resolved and joined."""
    return unarxive.joined_paragraphs(unarxive.paragraphs(table(spark, sf, "papers")))


@query()
def m14_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Sections of deliveries."""
    return unarxive.sections(table(spark, sf, "papers"))


@query()
def m8_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs packed by words."""
    return unarxive.packed(unarxive.paragraphs(table(spark, sf, "papers")).where("zone = 'body'"))


@query(f"""
SELECT row_id, bib_key, coalesce(len(list_filter(map_values(p.bib_entries[bib_key].ids), lambda x: coalesce(trim(x), '') <> '')) > 0, false)
  AND NOT coalesce(contains(text, ';'), false) AS is_resolved FROM {_ENTRIES} JOIN papers p USING (row_id)""")
def m13_resolved(spark: SparkSession, sf: str) -> DataFrame:
    """Bibliography entries with an id of their own."""
    return unarxive.resolved_citations(table(spark, sf, "papers")).select("row_id", "bib_key", "is_resolved")


# References and identity

def _records(spark: SparkSession, sf: str) -> DataFrame:
    s2 = table(spark, sf, "s2_rows")
    return s2.select("corpus_id", F.try_parse_json(F.to_json(F.struct("externalids", "title", "authors", "journal", "year"))).alias("v"))


@query("""
SELECT corpus_id, CASE WHEN len(regexp_split_to_array(t, '\\s+')) > 1 OR length(t) >= 3 THEN t END AS title,
  nullif(trim(journal.name), '') AS journal, nullif(trim(journal.volume), '') AS journal_volume, year
FROM (SELECT *, nullif(trim(title), '') AS t FROM s2_rows)""")
def n1_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue rows in canonical form."""
    r = reference.canonical(F.col("v"))
    return _records(spark, sf).select("corpus_id", r.alias("r")).select("corpus_id", "r.title", "r.journal", "r.journal_volume", "r.year")


_NAME = """
CASE WHEN NOT contains(t, ' ') THEN t ELSE array_to_string(list_transform(list_filter(string_split(trim(left(t, length(t) - length(z))), ' '), lambda g: g <> ''),
  lambda g: upper(left(g, 1)) || '.'), ' ') || CASE WHEN trim(left(t, length(t) - length(z))) = '' THEN '' ELSE ' ' END || z END"""


@query(f"""
WITH a AS (SELECT corpus_id, unnest(range(1, len(authors) + 1)) AS i, unnest(authors).name AS name FROM s2_rows),
f AS (SELECT corpus_id, i, regexp_replace(trim(regexp_replace(name, '\\s+', ' ', 'g')), '(?i),?\\s+(?:{'|'.join(reference.SUFFIXES.split())})\\.?$', '') AS f FROM a),
t AS (SELECT corpus_id, i, CASE WHEN contains(f, ',') THEN regexp_replace(f, '^([^,]+),\\s*(.+)$', '\\2 \\1') ELSE f END AS t FROM f),
z AS (SELECT *, regexp_extract(t, '(?i)((?:\\b(?:{'|'.join(reference.PARTICLES.split())})\\s+)*\\S+)$', 1) AS z FROM t),
n AS (SELECT corpus_id, i, {_NAME} AS n FROM z),
k AS (SELECT corpus_id, n, row_number() OVER (PARTITION BY corpus_id ORDER BY i) AS k FROM n WHERE coalesce(trim(n), '') <> ''),
l AS (SELECT corpus_id, list(n ORDER BY k) AS author FROM k WHERE k <= 3 GROUP BY 1)
SELECT corpus_id, author FROM s2_rows LEFT JOIN l USING (corpus_id)""")
def n7_authors(spark: SparkSession, sf: str) -> DataFrame:
    """Short names of the first authors."""
    return _records(spark, sf).select("corpus_id", reference.authors(F.col("v")).alias("author"))


@query("""
SELECT graded_id, c.title IS NOT NULL OR (c.author IS NOT NULL AND c.journal IS NOT NULL AND c.year IS NOT NULL)
  OR (c.journal IS NOT NULL AND c.journal_volume IS NOT NULL AND c.journal_page IS NOT NULL AND c.year IS NOT NULL) AS keep
FROM (SELECT graded_id, candidate AS c FROM graded)""")
def n15_worth_keeping(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates that say enough for an index."""
    return table(spark, sf, "graded").select("graded_id", reference.worth_keeping(F.col("candidate")).alias("keep"))


def _identified(spark: SparkSession, sf: str) -> list[tuple[str, DataFrame]]:
    graded = table(spark, sf, "graded")
    kinds = ("doi", "arxiv", "dblp", "mag", "pubmed")
    ids = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, kinds)), F.array(*(F.col(f"candidate.{k}") for k in kinds))), lambda _, v: v.isNotNull())
    name = F.col("candidate.from_structure")
    engine = F.lower(F.trim(name))
    rows = graded.select(F.col("graded_id").alias("row_key"), engine.alias("engine"), ids.alias("ids"))
    return [("AN", rows.where("engine = 'anystyle'")), ("GR", rows.where("engine = 'grobid'")), ("PT", rows.where("coalesce(engine, '') not in ('anystyle', 'grobid')"))]


def _pass(n: int, prefix: str, where: str, known: str) -> str:
    """SQL of one source's pass: rows grouped by shared identifiers, named after what ``known`` knows of them."""
    return f"""
i{n} AS (SELECT DISTINCT graded_id AS r, t, v FROM ids WHERE {where}),
g{n}(r, g) AS (SELECT r, r FROM (SELECT DISTINCT r FROM i{n}) UNION SELECT y.r, g{n}.g FROM g{n} JOIN i{n} x ON x.r = g{n}.r JOIN i{n} y ON y.t = x.t AND y.v = x.v WHERE g{n}.g <= y.r),
m{n} AS (SELECT r, min(g) AS g FROM g{n} GROUP BY 1),
k{n} AS (SELECT g, min(e) AS lo, max(e) AS hi FROM m{n} JOIN i{n} USING (r) LEFT JOIN ({known}) k USING (t, v) GROUP BY 1),
o{n} AS (SELECT r, CASE WHEN lo IS NULL THEN '{prefix}.' || g WHEN lo = hi THEN lo END AS e, CASE WHEN lo IS NULL THEN 'new' WHEN lo = hi THEN 'known' ELSE 'conflict' END AS outcome FROM m{n} JOIN k{n} USING (g)),
a{n} AS (SELECT * FROM ({known}) k UNION ALL SELECT t, v, min(e) AS e FROM i{n} JOIN o{n} USING (r) WHERE e IS NOT NULL AND (t, v) NOT IN (SELECT (t, v) FROM ({known}) k) GROUP BY ALL)"""


_ENGINE = "coalesce(lower(trim(candidate.from_structure)), '')"
_PASSES = ((1, "AN", "engine = 'anystyle'"), (2, "GR", "engine = 'grobid'"), (3, "PT", "engine NOT IN ('anystyle', 'grobid')"))
_IDENTITY = (
    "WITH RECURSIVE ids AS (SELECT graded_id, " + _ENGINE + " AS engine, t, trim(v) AS v FROM ("
    + " UNION ALL ".join(f"SELECT graded_id, candidate, '{k}' AS t, candidate.{k} AS v FROM graded" for k in ("doi", "arxiv", "dblp", "mag", "pubmed")) + ") WHERE trim(v) <> ''),"
    + ",".join(_pass(n, p, w, f"SELECT t, v, e FROM a{n - 1}" if n > 1 else "SELECT '' AS t, '' AS v, '' AS e WHERE false") for n, p, w in _PASSES)
)


@query(
    _IDENTITY + " SELECT graded_id AS row_key, e AS entity_id, coalesce(outcome, 'no_ids') AS outcome, CASE engine WHEN 'anystyle' THEN 'AN' WHEN 'grobid' THEN 'GR' ELSE 'PT' END AS source "
    f"FROM (SELECT graded_id, {_ENGINE} AS engine FROM graded) LEFT JOIN (SELECT * FROM o1 UNION ALL SELECT * FROM o2 UNION ALL SELECT * FROM o3) o ON o.r = graded_id"
)
def p4_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of three sources resolved to entities, source after source."""
    return identity.build(_identified(spark, sf))[1]


@query(_IDENTITY + " SELECT t AS type, v AS value, e AS entity_id FROM a3")
def p2_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """The alias table of the three sources."""
    return identity.build(_identified(spark, sf))[0]


_FIELDS = ("title", "author", "journal", "journal_volume", "journal_page", "year")


def _firsts(name: str, where: str) -> str:
    """SQL of the rows of one key merged in the order of their ids."""
    return f"{name} AS (SELECT id, " + ", ".join(f"arg_min(c.{f}, graded_id) FILTER (c.{f} IS NOT NULL) AS {f}" for f in _FIELDS) + f" FROM r WHERE {where} GROUP BY 1)"


@query(f"""
WITH r AS (SELECT graded_id, candidate.doi AS id, candidate AS c, lower(trim(candidate.from_structure)) AS engine FROM graded WHERE candidate.doi IS NOT NULL),
{_firsts('a', "engine = 'anystyle'")}, {_firsts('b', "coalesce(engine, '') <> 'anystyle'")},
j AS (SELECT coalesce(a.id, b.id) AS entity_id, {', '.join(f'coalesce(a.{f}, b.{f}) AS {f}' for f in _FIELDS)}, a.id AS ia, b.id AS ib,
  {' OR '.join(f'(a.{f} IS NULL AND b.{f} IS NOT NULL)' for f in _FIELDS)} AS fills,
  b.title IS NOT NULL OR (b.author IS NOT NULL AND b.journal IS NOT NULL AND b.year IS NOT NULL)
    OR (b.journal IS NOT NULL AND b.journal_volume IS NOT NULL AND b.journal_page IS NOT NULL AND b.year IS NOT NULL) AS worth
  FROM a FULL JOIN b ON a.id = b.id)
SELECT entity_id, {', '.join(_FIELDS)}, CASE WHEN ib IS NULL THEN 'kept' WHEN ia IS NULL AND worth THEN 'inserted' WHEN ia IS NULL THEN 'too_little'
  WHEN fills THEN 'filled' ELSE 'nothing_new' END AS outcome FROM j""")
def q4_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """An index of one engine's records brought up to date by those of the others."""
    graded = table(spark, sf, "graded").where("candidate.doi is not null")
    flat = graded.select("graded_id", F.col("candidate.doi").alias("entity_id"), F.lower(F.trim("candidate.from_structure")).alias("engine"), *(F.col(f"candidate.{f}").alias(f) for f in _FIELDS))
    return identity.upsert(flat.where("engine = 'anystyle'"), flat.where("coalesce(engine, '') <> 'anystyle'"), _FIELDS, order="graded_id")


@query("""
WITH c AS (SELECT candidate.doi AS id, candidate.author AS author, candidate.journal AS journal, candidate.short_content AS short FROM graded),
i AS (SELECT id, max(short) AS short FROM c WHERE id IS NOT NULL GROUP BY 1)
SELECT CASE WHEN NOT coalesce(len(author) > 0, false) OR coalesce(trim(journal), '') = '' THEN 'not_good' WHEN c.id IS NULL THEN 'unresolved'
  WHEN i.short IS NOT NULL THEN 'present' ELSE 'added' END AS state, count(*) AS rows FROM c LEFT JOIN i ON c.id = i.id GROUP BY 1""")
def q6_short_citations(spark: SparkSession, sf: str) -> DataFrame:
    """What happens to the short citation of each record."""
    c = table(spark, sf, "graded").select(F.col("candidate.doi").alias("entity_id"), "candidate.*")
    index = c.where("entity_id is not null").groupBy("entity_id").agg(F.max("short_content").alias("short_content"))
    made = citations.short_citation(F.col("author"), F.col("journal"), F.col("journal_volume"), F.col("journal_page"), F.col("year"))
    return identity.enrichment_census(index, c, made, citations.good_for_citation(F.col("author"), F.col("journal")))


# Citations, retrieval, grading

_VALID = "regexp_matches({0}, '^\\p{{Lu}}') AND len(list_filter(regexp_split_to_array({0}, '\\s+'), lambda w: w <> '')) > 10 AND NOT starts_with(lower({0}), 'doi')"
_STRIPPED = "trim({0}, ' .;:,!?')"


@query(f"""
WITH e AS (SELECT row_id, bib_key, list_transform(string_split(trim(text, ' .;:,'), ';'), lambda x: trim(x, ' .;:,!?')) AS l FROM {_ENTRIES}),
f AS (SELECT row_id, bib_key, string_split(list_reduce(list_prepend('', l), lambda acc, x: CASE WHEN {_VALID.format('x')} THEN CASE WHEN acc = '' THEN x ELSE acc || chr(30) || x END
  ELSE acc || x || ';' END), chr(30)) AS p FROM e WHERE l IS NOT NULL),
g AS (SELECT row_id, bib_key, CASE WHEN {_VALID.format(_STRIPPED.format('p[-1]'))} THEN p ELSE p[:-2] END AS p FROM f),
u AS (SELECT row_id, bib_key, list_filter(p, lambda x: x <> '') AS p FROM g)
SELECT row_id, bib_key, unnest(range(len(p)))::int AS piece_pos, unnest(p) AS text FROM u
UNION ALL SELECT row_id, bib_key, NULL, NULL FROM e LEFT JOIN u USING (row_id, bib_key) WHERE coalesce(len(p), 0) = 0""")
def r1_split(spark: SparkSession, sf: str) -> DataFrame:
    """Bibliography texts split at semicolons."""
    return citations.split_rows(_raw_entries(spark, sf).select("row_id", "bib_key", "text"))


@query(f"SELECT row_id, bib_key, CASE WHEN length(text) > 200 THEN left(text, 100) || '....' || right(text, 100) ELSE text END AS text FROM {_ENTRIES}")
def r8_shortened(spark: SparkSession, sf: str) -> DataFrame:
    """Bibliography texts cut in the middle."""
    return _raw_entries(spark, sf).select("row_id", "bib_key", citations.shortened(F.col("text"), 200).alias("text"))


@query("""
WITH q AS (SELECT graded_id AS query_id, unnest(regexp_extract_all(lower(candidate.title), '[\\p{L}\\p{N}]+')) AS token FROM graded
    WHERE graded_id % 100 = 0 AND candidate.title IS NOT NULL),
d AS (SELECT corpus_id AS entity_id, regexp_extract_all(lower(title), '[\\p{L}\\p{N}]+') AS w FROM s2_rows WHERE title IS NOT NULL),
p AS (SELECT entity_id, len(w) AS len, token, count(*) AS tf FROM (SELECT entity_id, w, unnest(w) AS token FROM d) GROUP BY ALL),
z AS (SELECT (SELECT count(*) FROM s2_rows) AS n, (SELECT avg(len(w)) FROM d WHERE len(w) > 0) AS avg_len),
f AS (SELECT token, count(*) AS df FROM p GROUP BY 1),
u AS (SELECT DISTINCT query_id, token, df FROM q JOIN f USING (token)),
c AS (SELECT DISTINCT query_id, entity_id FROM u JOIN p USING (token)),
s AS (SELECT query_id, entity_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))), 6) AS bm25
  FROM c JOIN u USING (query_id) JOIN p USING (entity_id, token), z GROUP BY ALL)
SELECT * FROM (SELECT query_id, entity_id, bm25, row_number() OVER (PARTITION BY query_id ORDER BY bm25 DESC, entity_id) AS hit_rank FROM s) WHERE hit_rank <= 5""")
def s6_bm25(spark: SparkSession, sf: str) -> DataFrame:
    """The five best catalogue titles for every hundredth candidate title."""
    asked = table(spark, sf, "graded").where("graded_id % 100 = 0 and candidate.title is not null").select(F.col("graded_id").alias("query_id"), F.col("candidate.title").alias("title"))
    docs = table(spark, sf, "s2_rows").select(F.col("corpus_id").alias("entity_id"), "title")
    return retrieval.bm25(asked, docs, ["title"], 5)


@query()
def s13_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """The score of each candidate against the row of its group ranked first by score."""
    c = table(spark, sf, "graded").select(
        "graded_id", "paper_id", "pos", F.col("candidate.score").alias("score"),
        F.struct(*(F.col(f"candidate.{f}").alias(f) for f in ("title", "author", "journal", "journal_volume", "journal_page", "year", "content"))).alias("r"),
    )
    best = c.groupBy("paper_id", "pos").agg(F.max_by("r", F.struct(F.coalesce("score", F.lit(-1.0)), -F.col("graded_id"))).alias("q"))
    pairs = c.join(best, ["paper_id", "pos"])
    return pairs.select("graded_id", scoring.similarity_udf("r", "q").alias("similarity"))


#: Parsers in the order in which they are asked; rows of any other engine are read as the last (fixed values).
_PARSERS = ("anystyle", "grobid", "plain_text")


def _parsed_citations(graded: DataFrame) -> DataFrame:
    """The record of each parser for the citations of every hundredth row: that row itself, or the latest of the other parsers."""
    engine = F.lower(F.trim(F.coalesce("candidate.from_structure", F.lit(""))))
    rows = graded.select(
        "graded_id", "paper_id", "pos", "retrieved_at", F.when(engine.isin(*_PARSERS), engine).otherwise(_PARSERS[-1]).alias("parser"), "candidate"
    )
    asked = rows.where("graded_id % 100 = 0")
    others = rows.join(asked.select(F.col("graded_id").alias("cite_id"), "paper_id", "pos"), ["paper_id", "pos"])
    every = others.unionByName(asked.withColumn("cite_id", F.col("graded_id"))).withColumn("own", F.col("graded_id") == F.col("cite_id"))
    best = every.groupBy("cite_id", "parser").agg(F.max_by("candidate", F.struct("own", F.col("retrieved_at"), -F.col("graded_id"))).alias("c"))
    return best.select(
        "cite_id", "parser", *(F.col(f"c.{f}").alias(f) for f in (*retrieval.ENGINES["integrate"], "content")),
        F.nullif(F.trim("c.arxiv"), F.lit("")).alias("given"),
    )


@query()
def s8_staged(spark: SparkSession, sf: str) -> DataFrame:
    """Staged retrieval of catalogue works for the citations of every hundredth row, from each parser's own record."""
    c = _parsed_citations(table(spark, sf, "graded"))
    docs = persist_table(table(spark, sf, "s2_rows").select(
        F.col("corpus_id").alias("entity_id"), "title", F.transform("authors", lambda a: a["name"]).alias("author"), F.col("journal.name").alias("journal"),
        F.col("journal.volume").alias("journal_volume"), F.col("journal.pages").alias("journal_page"), "year", F.lit(None).cast("string").alias("content"),
    ), "docs")
    record = F.struct(*(F.col(f) for f in ("title", "author", "journal", "journal_volume", "journal_page", "year", "content")))
    return retrieval.staged(c, docs, retrieval.ENGINES["integrate"], record, record, _PARSERS, given="given")


_GRADED_SQL = """
WITH c AS (SELECT paper_id, pos, graded_id, retrieved_level, lower(trim(coalesce(candidate.from_structure, ''))) AS engine,
  CASE WHEN NOT isnan(candidate.score) AND candidate.score BETWEEN 0 AND 1 THEN candidate.score END AS score FROM graded),
b AS (SELECT paper_id, pos, bool_or(retrieved_level = -1) AS note, max(score) AS best, count(DISTINCT engine) AS n FROM c GROUP BY ALL)
SELECT paper_id, pos, CASE WHEN coalesce(note, false) THEN -1 WHEN best IS NULL THEN 0 WHEN best = 1 THEN 5 WHEN best > 0.95 THEN 4
  WHEN best < 0.5 THEN 0 WHEN n = 1 THEN 2 ELSE 99 END AS grade FROM b"""


@query(_GRADED_SQL)
def t1_grades(spark: SparkSession, sf: str) -> DataFrame:
    """The grade of each citation; where engines must be compared, 99 stands for levels 1 and 3."""
    graded = _grades(spark, sf)
    return graded.select("paper_id", "pos", F.when(F.col("retrieved_level").isin(1, 3), 99).otherwise(F.col("retrieved_level")).alias("grade"))


def _grades(spark: SparkSession, sf: str) -> DataFrame:
    score = F.col("candidate.score")
    ids = F.map_from_arrays(F.array(F.lit("doi"), F.lit("arxiv")), F.array("candidate.doi", "candidate.arxiv"))
    rows = table(spark, sf, "graded").select(
        "paper_id", "pos", F.lower(F.trim(F.coalesce("candidate.from_structure", F.lit("")))).alias("engine"),
        F.when(~F.isnan(score) & score.between(0, 1), score).alias("score"), F.col("graded_id").alias("rank"), F.col("candidate.title").alias("title"),
        F.map_filter(ids, lambda _, v: v.isNotNull()).alias("ids"), (F.col("retrieved_level") == -1).alias("is_note"),
    )
    return grading.grade(rows, ["paper_id", "pos"])


@query()
def t1_levels(spark: SparkSession, sf: str) -> DataFrame:
    """The level of each citation with its best candidate."""
    return _grades(spark, sf)


@query("""
SELECT paper_id, hits, "all", CASE WHEN hits = "all" THEN 'Full' WHEN hits > 0 THEN 'Part' ELSE 'None' END AS coverage FROM (
  SELECT paper_id, count(*) FILTER (WHERE retrieved_level >= 3) AS hits, count(*) AS "all" FROM graded GROUP BY 1)""")
def t6_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """How much of each paper's citations was found."""
    flags = table(spark, sf, "graded").select("paper_id", (F.coalesce("retrieved_level", F.lit(0)) >= 3).alias("hit"))
    return grading.coverage(flags, "paper_id", "hit")


# TeX, BibTeX and converted documents, over texts of the tables

_PARAGRAPHS = "(SELECT section_id, unnest(range(len(section_content))) AS para_pos, unnest(section_content) AS text FROM sections)"


@query(f"""
SELECT section_id, para_pos, CASE WHEN text IS NULL THEN 'NoSource' WHEN {" OR ".join(f"contains(text, '{x}')" for x in ("tikz-cd", "sty_jtana_tikzit", "auxTikzDefs", "tikzit", "tikz-timing", "tikzpicture"))} THEN 'HasTIKZ' ELSE 'NoTIKZ' END AS status
FROM {_PARAGRAPHS}""")
def a20_drawings(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs with drawings in their source."""
    rows = table(spark, sf, "sections").select("section_id", F.posexplode("section_content").alias("para_pos", "text"))
    return rows.select("section_id", F.col("para_pos").cast("bigint").alias("para_pos"), tex.has_drawing(F.col("text")).alias("status"))


@query(f"""
SELECT section_id, para_pos::int AS para_pos, regexp_replace(regexp_replace(text, '(?m)^[ \\t]*%.*(?:\\r?\\n|$)', '', 'g'), '(?m)(^|[^\\\\])%.*$', '\\1', 'g') AS text FROM {_PARAGRAPHS}""")
def e1_uncommented(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs without TeX comments."""
    rows = table(spark, sf, "sections").select("section_id", F.posexplode("section_content").alias("para_pos", "text"))
    return rows.select("section_id", "para_pos", tex.uncommented(F.col("text")).alias("text"))


@query("""
SELECT corpus_id, 'article' AS kind, 'k' || corpus_id AS key, CAST(year AS varchar) AS year, CASE WHEN year IS NULL THEN ['author', 'year'] ELSE ['author'] END AS lacking
FROM s2_rows WHERE title IS NOT NULL AND trim(title) <> '' AND journal.name IS NOT NULL AND NOT regexp_matches(title, '[{}]') AND NOT regexp_matches(journal.name, '[{}]')""")
def o3_bibtex(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue rows written as BibTeX and read back, with the fields that they lack."""
    whole = "title is not null and trim(title) <> '' and journal.name is not null and not title rlike '[{}]' and not journal.name rlike '[{}]'"
    rows = table(spark, sf, "s2_rows").where(whole)
    year = F.when(F.col("year").isNotNull(), F.concat(F.lit(", year="), F.col("year").cast("string"))).otherwise(F.lit(""))
    text = F.concat(F.lit("@Article{k"), "corpus_id", F.lit(", title={"), "title", F.lit('}, journal="'), F.replace("journal.name", F.lit('"'), F.lit("")), F.lit('"'), year, F.lit("}"))
    e = rows.select("corpus_id", F.explode(bibtex.bibtex_udf(text)).alias("e"))
    return e.select("corpus_id", F.col("e.type").alias("kind"), "e.key", F.col("e.fields")["year"].alias("year"), "e.lacking")


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "sections").where("section_content is not null").dropDuplicates(["section_id"])
    body = F.array_join(F.transform(F.filter("section_content", lambda x: x.isNotNull()), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "\n")
    page = F.concat(F.lit("<html><body><article><h1>"), F.coalesce("section_title", F.lit("")), F.lit("</h1>"), body, F.lit("</article></body></html>"))
    return rows.select(F.col("section_id").cast("string").alias("paper_id"), page.alias("content"))


@query()
def j21_html(spark: SparkSession, sf: str) -> DataFrame:
    """Sections as HTML pages taken apart: status, title and number of blocks."""
    return documents.converted(_pages(spark, sf), html=True).select("paper_id", "status", "title", F.size("blocks").alias("n_blocks"))


@query()
def v7_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Sections as HTML pages written as Markdown."""
    return documents.markdown(documents.converted(_pages(spark, sf), html=True))


# Layout helpers

@query("""
SELECT doc_id, [(k // 2601 + 1) * 5, (k // 51) % 51 * 5, k % 51 * 5]::int[] AS colour FROM (SELECT doc_id, doc_id % 130050 AS k FROM documents)""")
def v1_palette(spark: SparkSession, sf: str) -> DataFrame:
    """A colour for each document."""
    return table(spark, sf, "documents").select("doc_id", colour.palette(F.col("doc_id")).alias("colour"))


@query("""
SELECT section_id::varchar AS paper_id, '## ' || trim(regexp_replace(section_title, '\\s+', ' ', 'g')) || chr(10) || chr(10) || 'x' AS markdown
FROM (SELECT section_id, max(section_title) AS section_title FROM sections WHERE regexp_matches(section_title, '^[A-Za-z0-9 ,.:-]*[A-Za-z0-9]$') AND length(section_title) < 200 GROUP BY 1)""")
def v5_headings(spark: SparkSession, sf: str) -> DataFrame:
    """Sections with plain titles as papers of one section, written as Markdown by the renderer."""
    plain = "section_title rlike '^[A-Za-z0-9 ,.:-]*[A-Za-z0-9]$' and length(section_title) < 200"
    rows = table(spark, sf, "sections").where(plain).groupBy("section_id").agg(F.max("section_title").alias("t"))
    page = F.concat(F.lit("<html><body><article><section class='ltx_section'><h2>"), "t", F.lit("</h2><p class='ltx_p'>x</p></section></article></body></html>"))
    return documents.markdown(documents.converted(rows.select(F.col("section_id").cast("string").alias("paper_id"), page.alias("content")), html=True))


# Relational operators on the star schema, as a sanity check of plans

@query("""
SELECT n_name, sum(l_extendedprice * (1 - l_discount)) AS revenue, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_quantity > 25 GROUP BY 1""")
def x_join_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    """Joins with small sides broadcast by their statistics, and one aggregation."""
    t = {n: table(spark, sf, n) for n in ("lineitem", "orders", "customer", "nation")}
    return (
        t["lineitem"].where("l_quantity > 25").join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"), F.count("*").alias("n"))
    )


@query("SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n, avg(value) AS mean FROM events GROUP BY ALL")
def x_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Events by hour."""
    return table(spark, sf, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"), F.avg("value").alias("mean"))


def queries() -> dict[str, Query]:
    return dict(FOUND)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
