"""The queries of this package against SQL, and that all of them run."""

from paperloom.llm import queries
from tests.compare import differences


def test_against_sql(spark, sf):
    assert differences(spark, sf, queries.queries(), queries.oracle_sql()) == {}


def test_the_rest_runs(spark, sf):
    counts = {n: f(spark, sf).count() for n, f in queries.queries().items()}
    counts.pop("p2_runs")  # the sections of the smallest table share no passage
    assert all(counts.values()), counts
