"""Shredding: against a recursive walk, and the defined edge cases."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.operators import shred

JSON = st.recursive(
    st.none() | st.booleans() | st.integers() | st.text(max_size=3),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("ab", max_size=2), x, max_size=3), max_leaves=12,
)


def brute(value, path, owner):
    out = []
    if isinstance(value, dict):
        out.append((path, owner))
        for k, v in value.items():
            out += brute(v, f"{path}/{k}", path)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            out += brute(v, f"{path}/{i}", owner)
    return out


@settings(max_examples=200, deadline=None)
@given(JSON)
def test_walk_is_the_recursive_walk(value):
    got = [(n[0], n[2]) for n in shred.walk(value, "r") if n[5] == "object"]
    assert sorted(got) == sorted(brute(value, "r", ""))


def lines(spark, *rows):
    return spark.createDataFrame([(i, x, "x") for i, x in enumerate(rows)], "record_id bigint, line string, kind string")


def test_objects_and_rejects(spark):
    deep = {"metadata": {}, "body_text": [None, {"a": [[{"b": 1}]]}, "s"], "other": {"x": {}}}
    df = lines(
        spark, json.dumps(deep), None, "", "  ", '{"metadata": {', "[1]", '{"metadata": NaN}', '{"body_text": "[{\\"s\\": 1}]", "metadata": "plain"}',
        json.dumps(deep),
    )
    got = {tuple(r) for r in shred.objects(shred.shred(df)).select("record_id", "node_path", "parent_path").collect()}
    one = {("metadata", ""), ("body_text/1", ""), ("body_text/1/a/0/0", "body_text/1")}
    assert got == {(i, *x) for i in (0, 8) for x in one} | {(7, "body_text/0", "")}
    why = {r.record_id: r.reason for r in shred.shred_rejects(df).collect()}
    assert why == {1: "null", 2: "blank", 3: "blank", 4: "broken", 5: "no object", 6: "broken"}


def test_entities_keep_their_parents(spark):
    row = {"body_text": [{"section": "A", "sec_number": 1, "children": [{"section": "B", "text": None}]}, {}]}
    nodes = shred.shred(lines(spark, json.dumps(row)))
    got = {r.node_path: (r.parent_path, r.section, r.sec_number, r.text) for r in shred.entity(nodes, ("body_text", "children"), ("section", "sec_number", "text")).collect()}
    assert got == {
        "body_text/0": ("", "A", "1", None), "body_text/0/children/0": ("body_text/0", "B", None, None), "body_text/1": ("", None, None, None),
    }


def test_empty_table(spark):
    assert shred.shred(lines(spark, "x").limit(0)).count() == 0


def test_many_nodes_in_one_record(spark):
    row = {"body_text": [{"i": i} for i in range(shred.BATCH_NODES + 5)]}
    assert shred.shred(lines(spark, json.dumps(row)), kinds=("object",)).count() == shred.BATCH_NODES + 5
