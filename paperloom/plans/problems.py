"""Queries of the general problems on nested records, packed fields and orphans."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import orphans, packed, shred
from paperloom.session import persist_table, table

Query = Callable[[SparkSession, str], DataFrame]


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every JSON object at or below metadata and body_text, with its parent."""
    return p4_entities(spark, sf).select("record_id", "node_path", "parent_path")


def p4_entities(spark: SparkSession, sf: str) -> DataFrame:
    """The same with scalar fields that sections and spans have, and the number of scalars of each object."""
    nodes = persist_table(p4_nodes(spark, sf), "nodes")
    made = shred.entities(nodes, ("section", "sec_number", "text", "start", "end", "ref_id"))
    return made.where("n_scalars >= 0")  # the join is part of the operator, so it is no join to be left out


def p4_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """The whole adjacency table."""
    return shred.shred(table(spark, sf, "raw_rows"))


#: Labels under which sections lie inside sections (fixed values).
SECTION_LABELS = ("body_text", "subsections", "children", "content")


def p4_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Sections at any depth with their scalar fields and the section around them."""
    nodes = persist_table(p4_nodes(spark, sf), "nodes")
    return shred.entity(nodes, SECTION_LABELS, ("section", "sec_number", "text"))


def p4_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Citation spans with the section that holds them."""
    nodes = persist_table(p4_nodes(spark, sf), "nodes")
    return shred.entity(nodes, ("cite_spans",), ("start", "end", "ref_id"))


def p4_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Records that are no complete JSON object."""
    return shred.shred_rejects(table(spark, sf, "raw_rows"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Citations of the entries that hold several."""
    return packed.packed_entries(table(spark, sf, "papers"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Marks whose entry is not there."""
    return orphans.missing_entries(table(spark, sf, "papers"), table(spark, sf, "entry_changes"))


def p7_report(spark: SparkSession, sf: str) -> DataFrame:
    """Direct and inherited orphans per table and month."""
    return orphans.orphan_report(table(spark, sf, "papers"), table(spark, sf, "entry_changes"))


def p7_months(spark: SparkSession, sf: str) -> DataFrame:
    """Missing keys per entry table and month of delivery."""
    papers = table(spark, sf, "papers")
    when = papers.select("row_id", F.date_format("delivered_at", "yyyy-MM").alias("month"))
    return p7_found(spark, sf).join(when, "row_id").groupBy("entry_table", "month").agg(F.count("*").alias("orphans"))


def queries() -> dict[str, Query]:
    found = (p4_found, p4_entities, p4_nodes, p4_sections, p4_spans, p4_rejects, p6_found, p7_found, p7_report, p7_months)
    return {f.__name__: f for f in found}


_P7 = r"""
WITH said AS (
  SELECT row_id, paper_id, delivered_at, unnest([x.section, x.text]) AS t
  FROM (SELECT row_id, paper_id, delivered_at, unnest(body_text) AS x FROM papers)),
m AS (
  SELECT row_id, paper_id, delivered_at, unnest(regexp_extract_all(t, '\{\{\s*[A-Za-z]+\s*:[^{}]*\}\}')) AS m FROM said WHERE t IS NOT NULL),
k AS (
  SELECT row_id, paper_id, delivered_at, lower(regexp_extract(m, '\{\{\s*([A-Za-z]+)\s*:', 1)) AS kind,
    lower(trim(unnest(string_split(regexp_extract(m, ':([^{}]*)\}\}', 1), ',')), chr(32) || chr(9) || chr(10) || chr(13))) AS entry_key FROM m),
refs AS (
  SELECT DISTINCT row_id, paper_id, delivered_at, entry_key,
    CASE kind WHEN 'cite' THEN 'bib_entries' WHEN 'figure' THEN 'ref_entries' WHEN 'table' THEN 'ref_entries'
      WHEN 'formula' THEN 'ref_entries' END AS entry_table FROM k WHERE entry_key <> ''),
log AS (
  SELECT r.row_id, r.entry_table, r.entry_key,
    arg_max(c.change_kind, (c.changed_at, c.received_at, c.change_kind = 'add')) AS last
  FROM refs r JOIN entry_changes c ON c.paper_id = r.paper_id AND c.entry_table = r.entry_table
    AND lower(trim(c.entry_key)) = r.entry_key AND c.changed_at <= r.delivered_at GROUP BY ALL),
own AS (
  SELECT row_id, 'bib_entries' AS entry_table, lower(trim(e.key)) AS entry_key FROM (
    SELECT row_id, unnest(map_entries(bib_entries)) AS e FROM papers) WHERE e.value IS NOT NULL
  UNION SELECT row_id, 'ref_entries', lower(trim(e.key)) FROM (
    SELECT row_id, unnest(map_entries(ref_entries)) AS e FROM papers) WHERE e.value IS NOT NULL)
"""
_P7_FOUND = _P7 + """
SELECT DISTINCT r.row_id, r.entry_table, r.entry_key FROM refs r
LEFT JOIN log USING (row_id, entry_table, entry_key)
LEFT JOIN own o ON o.row_id = r.row_id AND o.entry_table = r.entry_table AND o.entry_key = r.entry_key
WHERE r.entry_table IS NOT NULL AND coalesce(last = 'delete', o.row_id IS NULL)
"""


_P4 = """
WITH RECURSIVE j AS (SELECT record_id, line::json AS line FROM (SELECT record_id, line FROM raw_rows WHERE line IS NOT NULL AND trim(line) <> '' AND json_valid(line)) WHERE json_type(line) = 'OBJECT'),
r AS (SELECT record_id, 'metadata' AS root, line->'metadata' AS v FROM j UNION ALL SELECT record_id, 'body_text', line->'body_text' FROM j),
w AS (SELECT record_id, root, v FROM r WHERE v IS NOT NULL UNION ALL SELECT record_id, root, (v->>'$')::json FROM w WHERE json_type(v) = 'VARCHAR' AND json_valid(v->>'$') AND json_type(v->>'$') IN ('OBJECT', 'ARRAY', 'VARCHAR')),
t AS (SELECT record_id, root, v FROM w WHERE NOT (json_type(v) = 'VARCHAR' AND json_valid(v->>'$') AND json_type(v->>'$') IN ('OBJECT', 'ARRAY', 'VARCHAR'))),
n AS (SELECT t.record_id, t.root, x.id, x.parent, x.key, x.type, x.atom FROM (SELECT record_id, root, v FROM t) t, json_tree(t.v) x),
p AS (SELECT record_id, root, id, root AS node_path, '' AS object_path, root AS label, NULL::int AS ordinal, type, atom, NULL::varchar AS parent_path FROM n WHERE parent IS NULL
  UNION ALL SELECT n.record_id, n.root, n.id, p.node_path || '/' || n.key, CASE WHEN p.type = 'OBJECT' THEN p.node_path ELSE p.object_path END,
    CASE WHEN p.type = 'OBJECT' THEN n.key ELSE p.label END, CASE WHEN p.type = 'ARRAY' THEN n.key::int END, n.type, n.atom, p.node_path
  FROM n JOIN p ON n.record_id = p.record_id AND n.root = p.root AND n.parent = p.id)"""
_P4_REJECTS = """
SELECT record_id, CASE WHEN line IS NULL THEN 'null' WHEN trim(line, chr(32)||chr(9)||chr(10)||chr(13)) = '' THEN 'blank' WHEN NOT json_valid(line) THEN 'broken' ELSE 'no object' END AS reason
FROM raw_rows WHERE line IS NULL OR trim(line, chr(32)||chr(9)||chr(10)||chr(13)) = '' OR NOT json_valid(line) OR json_type(line) <> 'OBJECT'"""


def _entity_sql(labels: Sequence[str], fields: Sequence[str]) -> str:
    """SQL of the objects under some labels with their scalar fields."""
    wide = ", ".join(f"max(atom->>'$') FILTER (label = '{f}') AS \"{f}\"" for f in fields)
    direct = ", ".join(f'f."{f}"' for f in fields)
    return _P4 + f"""
SELECT o.record_id, o.node_path, o.object_path AS parent_path, o.label, {direct} FROM p o
LEFT JOIN (SELECT record_id, object_path, {wide} FROM p WHERE type NOT IN ('OBJECT', 'ARRAY') AND node_path = object_path || '/' || label GROUP BY 1, 2) f
  ON f.record_id = o.record_id AND f.object_path = o.node_path
WHERE o.type = 'OBJECT' AND o.label IN ({', '.join(f"'{x}'" for x in labels)})"""


_P7_REPORT = _P7.replace("WITH said", "WITH RECURSIVE said") + """,
sec AS (SELECT row_id, delivered_at, pos, num, nullif(regexp_extract(num, '^(.+)[.-][^.-]+$', 1), '') AS outer_num FROM (
  SELECT row_id, delivered_at, unnest(range(len(body_text))) AS pos, nullif(trim(unnest(body_text).sec_number), '') AS num FROM papers)),
smark AS (SELECT DISTINCT row_id, paper_id, delivered_at, pos, entry_table, entry_key FROM (
  SELECT row_id, paper_id, delivered_at, pos, CASE lower(regexp_extract(m, '\\{\\{\\s*([A-Za-z]+)\\s*:', 1)) WHEN 'cite' THEN 'bib_entries' WHEN 'figure' THEN 'ref_entries' WHEN 'table' THEN 'ref_entries'
      WHEN 'formula' THEN 'ref_entries' END AS entry_table,
    lower(trim(unnest(string_split(regexp_extract(m, ':([^{}]*)\\}\\}', 1), ',')), chr(32) || chr(9) || chr(10) || chr(13))) AS entry_key FROM (
    SELECT row_id, paper_id, delivered_at, pos, unnest(regexp_extract_all(concat_ws(chr(10), x.section, x.text), '\\{\\{\\s*[A-Za-z]+\\s*:[^{}]*\\}\\}')) AS m
    FROM (SELECT row_id, paper_id, delivered_at, unnest(range(len(body_text))) AS pos, unnest(body_text) AS x FROM papers)))
  WHERE entry_table IS NOT NULL AND entry_key <> ''),
direct AS (SELECT * FROM smark WHERE (row_id, entry_table, entry_key) IN (SELECT (r.row_id, r.entry_table, r.entry_key) FROM refs r
  LEFT JOIN log USING (row_id, entry_table, entry_key) LEFT JOIN own o ON o.row_id = r.row_id AND o.entry_table = r.entry_table AND o.entry_key = r.entry_key
  WHERE r.entry_table IS NOT NULL AND coalesce(last = 'delete', o.row_id IS NULL))),
lost(row_id, pos, level) AS (
  SELECT row_id, pos, 0 FROM sec s WHERE outer_num IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sec o WHERE o.row_id = s.row_id AND o.num = s.outer_num)
  UNION SELECT s.row_id, s.pos, 1 FROM lost JOIN sec o ON o.row_id = lost.row_id AND o.pos = lost.pos JOIN sec s ON s.row_id = o.row_id AND s.outer_num = o.num),
lev AS (SELECT row_id, pos, min(level) AS level FROM lost GROUP BY 1, 2)
SELECT orphan_table, strftime(delivered_at, '%Y-%m') AS month, count(*) FILTER (level = 0) AS direct, count(*) FILTER (level > 0) AS inherited FROM (
  SELECT entry_table AS orphan_table, delivered_at, 0 AS level FROM direct
  UNION ALL SELECT entry_table, delivered_at, 1 FROM smark m WHERE (row_id, pos) IN (SELECT (row_id, pos) FROM lev)
    AND (row_id, pos, entry_table, entry_key) NOT IN (SELECT (row_id, pos, entry_table, entry_key) FROM direct)
  UNION ALL SELECT 'sections', delivered_at, level FROM lev JOIN sec USING (row_id, pos)) GROUP BY 1, 2"""


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": _P4 + " SELECT record_id, node_path, object_path AS parent_path FROM p WHERE type = 'OBJECT'",
        "p4_rejects": _P4_REJECTS,
        "p4_sections": _entity_sql(SECTION_LABELS, ("section", "sec_number", "text")),
        "p4_spans": _entity_sql(("cite_spans",), ("start", "end", "ref_id")),
        "p7_report": _P7_REPORT,
        "p7_found": _P7_FOUND,
        "p7_months": "SELECT entry_table, strftime(delivered_at, '%Y-%m') AS month, count(*) AS orphans FROM ("
        + _P7_FOUND + ") JOIN papers USING (row_id) GROUP BY ALL",
    }
