"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"cluster_districts"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_only_iterative_queries_lack_an_oracle():
    own = {name for name, query in queries().items() if not query.__module__.startswith("beatgrid.llm")}
    assert own - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


def plan_faults(df):
    """Operators that do not scale: all pairs, row-wise Python, one-task windows."""
    text = df._jdf.queryExecution().executedPlan().toString()
    faults = [word for word in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas") if word in text]
    lines = [line.strip(" :+-*()0123456789") for line in text.splitlines()]
    at = [i for i, line in enumerate(lines) if line.startswith("Window ")]
    return faults + [lines[i] for i in at if any("SinglePartition" in line for line in lines[i + 1:i + 4])]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    result = queries()[name](spark, SF)
    assert plan_faults(result) == []
    assert difference(result, duck, oracle_sql()[name]) is None


def test_clusters_cover_the_districts_with_five_groups(spark):
    rows = queries()["cluster_districts"](spark, SF).collect()
    assert rows and {r["cluster"] for r in rows} == {1, 2, 3, 4, 5}


def test_entry_has_rows(spark):
    result = entry(spark)
    assert result.columns == ["area_name", "year", "count"]
    assert result.count() > 0
