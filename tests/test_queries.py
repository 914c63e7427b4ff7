"""The engine's queries against SQL, and that all of them run."""

import __spark_entry__
from paperloom.plans import problems, reference
from tests.compare import differences


def test_against_sql(spark, sf):
    assert differences(spark, sf, problems.queries() | reference.queries(), problems.oracle_sql() | reference.oracle_sql()) == {}


def test_the_rest_runs(spark, sf):
    known = problems.queries() | reference.queries()
    checked = problems.oracle_sql() | reference.oracle_sql()
    counts = {n: known[n](spark, sf).count() for n in known if n not in checked}
    counts.pop("p4_rejects")  # the smallest table has no broken line
    assert all(counts.values()), counts


def test_entry(spark, sf):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
