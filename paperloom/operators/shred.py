"""Adjacency-table shredding of nested JSON records into linked flat tables.

Every JSON value becomes one row (node, parent, label, ordinal, kind, scalar). Entity tables
are made by joining object nodes with their scalar children and pivoting the labels.

Defined results
---------------
* null, empty, broken or truncated lines, and lines whose value is no object: no nodes; they
  appear in :func:`shred_rejects` with a reason.
* ``NaN``/``Infinity`` are no JSON: the line is rejected. Of repeated names the last holds.
* A root that is a string of JSON (object or array) is read as if written in place.
* Repeated lines with distinct record ids give nodes for each; extra columns are ignored;
  an empty table gives an empty table.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODE_SCHEMA = (
    "record_id bigint, node_path string, parent_path string, object_path string, "
    "label string, ordinal int, kind string, scalar string"
)
#: Nodes put into one Arrow batch at most, so that one huge record can't fill a worker.
BATCH_NODES = 20_000


def _refuse(name: str) -> float:
    raise ValueError(f"{name} is no JSON")


def parse_object(line: str | None) -> tuple[dict | None, str | None]:
    """The object a line holds and null, or null and the reason for which it is refused."""
    if line is None:
        return None, "null"
    if not line.strip():
        return None, "blank"
    try:
        value = json.loads(line, parse_constant=_refuse)
    except RecursionError:
        return None, "too deep"
    except ValueError:
        return None, "broken"
    return (value, None) if isinstance(value, dict) else (None, "no object")


def unwrap(value: object) -> object:
    """A root value; a string that holds a JSON object or array stands for that content."""
    while isinstance(value, str):
        try:
            inner = json.loads(value, parse_constant=_refuse)
        except (ValueError, RecursionError):
            return value
        if not isinstance(inner, (dict, list, str)):
            return value
        value = inner
    return value


def _kind(value: object) -> str:
    if isinstance(value, dict):
        return "object"
    if isinstance(value, list):
        return "array"
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    return "string" if isinstance(value, str) else "number"


def _scalar(value: object) -> str | None:
    if isinstance(value, str) or value is None:
        return value
    return json.dumps(value)


def walk(root: object, name: str) -> Iterator[tuple]:
    """Nodes of a tree in document order, without recursion.

    Each is (path, parent path, path of the nearest enclosing object, label, ordinal, kind, scalar).
    The label of an array element is that of its array.
    """
    stack: list[tuple] = [(root, name, "", "", name, None)]
    while stack:
        value, path, parent, owner, label, ordinal = stack.pop()
        kind = _kind(value)
        nested = kind in ("object", "array")
        yield path, parent, owner, label, ordinal, kind, None if nested else _scalar(value)
        if kind == "object":
            stack += [(v, f"{path}/{k}", path, path, k, None) for k, v in reversed(value.items())]
        elif kind == "array":
            stack += [(value[i], f"{path}/{i}", path, owner, label, i) for i in range(len(value) - 1, -1, -1)]


def shred(
    df: DataFrame,
    id_col: str = "record_id",
    line_col: str = "line",
    roots: Sequence[str] = ("metadata", "body_text"),
    kinds: Sequence[str] | None = None,
) -> DataFrame:
    """The adjacency table of the ``roots`` of every record: one row per JSON value.

    ``kinds`` keeps only nodes of some kinds and spares the transfer of the others.
    """
    keep, roots = set(kinds or ()), tuple(roots)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["record_id", *(c.split()[0] for c in NODE_SCHEMA.split(", ")[1:])]
        rows: list[tuple] = []
        for pdf in batches:
            for record_id, line in zip(pdf["id"], pdf["line"], strict=True):
                value, _ = parse_object(line)
                for root in roots if value else ():
                    if root not in value:
                        continue
                    for node in walk(unwrap(value[root]), root):
                        if not keep or node[5] in keep:
                            rows.append((record_id, *node))
                        if len(rows) >= BATCH_NODES:
                            yield _frame(rows, columns)
                            rows = []
        yield _frame(rows, columns)

    slim = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(line_col).alias("line"))
    return slim.where(F.length(F.trim("line")) > 0).mapInPandas(run, NODE_SCHEMA)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=columns)
    pdf["ordinal"] = pdf["ordinal"].astype("Int32")
    return pdf


def shred_rejects(df: DataFrame, id_col: str = "record_id", line_col: str = "line") -> DataFrame:
    """Records that have no nodes because their line is no complete JSON object, with the reason."""

    def reasons(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf.assign(reason=[parse_object(x)[1] for x in pdf["line"]])
            yield out.loc[out["reason"].notna(), ["record_id", "reason"]]

    slim = df.select(F.col(id_col).cast("bigint").alias("record_id"), F.col(line_col).alias("line"))
    return slim.mapInPandas(reasons, "record_id bigint, reason string")


def objects(nodes: DataFrame) -> DataFrame:
    """Object nodes joined with the object around them (empty at the top): record_id, node_path, parent_path, label, depth.

    The adjacency table is joined with itself on (record, path): a child whose parent is no object of
    the table would have no row. ``nodes`` is read from storage.
    """
    held = nodes.where("kind = 'object'")
    top = held.where("object_path = ''").select("record_id", "node_path", F.lit("").alias("parent_path"), "label")
    parents = held.select("record_id", F.col("node_path").alias("parent_path")).hint("merge")
    inner = held.where("object_path <> ''").select("record_id", F.col("object_path").alias("parent_path"), "node_path", "label")
    linked = inner.join(parents, ["record_id", "parent_path"]).select("record_id", "node_path", "parent_path", "label")
    return top.unionByName(linked)


def entities(nodes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Every object with its parent, its scalar ``fields`` as columns and the number of all its scalars (n_scalars).

    Object nodes are joined with their scalar children on (record, object), and the labels pivoted.
    """
    scalar = ~F.col("kind").isin("object", "array")
    wide = nodes.where(scalar & (F.col("object_path") != "")).groupBy("record_id", F.col("object_path").alias("node_path")).agg(
        F.count("*").alias("n_scalars"), *(F.max(F.when((F.col("label") == f) & F.col("ordinal").isNull(), F.col("scalar"))).alias(f) for f in fields)
    )
    return objects(nodes).join(wide.hint("merge"), ["record_id", "node_path"], "left").fillna(0, ["n_scalars"])


def entity(nodes: DataFrame, labels: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per object whose label is among ``labels``, its scalar ``fields`` as columns.

    Object nodes are joined with their scalar children on (record, object) and the labels pivoted.
    An object without a field has null there; a field that is an object or array is null too, and
    is found as an entity of its own. Children name their parent by ``parent_path``.
    """
    owners = nodes.where(F.col("kind").eqNullSafe("object") & F.col("label").isin(list(labels))).select(
        "record_id", "node_path", F.col("object_path").alias("parent_path"), "label"
    )
    direct = F.col("node_path") == F.concat("object_path", F.lit("/"), "label")
    wide = (
        nodes.where(F.col("label").isin(list(fields)) & ~F.col("kind").isin("object", "array") & direct)
        .groupBy("record_id", F.col("object_path").alias("node_path"))
        .agg(*(F.max(F.when(F.col("label") == f, F.col("scalar"))).alias(f) for f in fields))
    )
    return owners.join(wide, ["record_id", "node_path"], "left")
