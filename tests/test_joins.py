"""A third of all rows under one key, for every join operator."""

import pytest
from pyspark.sql import functions as F

from beatgrid.operators import joins, rollup

ON = ["name", "year"]


@pytest.fixture(scope="module")
def tables(spark):
    key = "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS name"
    year = "CAST(CASE WHEN id % 3 = 0 THEN 1 ELSE id % 7 END AS INT) AS year"
    many = spark.range(60_000).selectExpr(key, year, "CAST(id AS STRING) AS v").repartition(6)
    one = many.filter("CAST(v AS INT) % 2 = 0").groupBy(*ON).agg(F.count(F.lit(1)).alias("count"))
    lonely = spark.range(10).selectExpr("CONCAT('only-', id) AS name", "1 AS year", "1L AS count")
    return many, one.unionByName(lonely)


CASES = {
    "inner": (lambda many, one: joins.inner_on(many, one, ON), 20_000 + 20_000),
    "left": (lambda many, one: joins.left_from_skeleton(many, one, ON), 60_000),
    "full_outer": (lambda many, one: joins.full_outer_on(many, one, ON), 60_000 + 10),
    "first_match": (lambda many, one: joins.first_match(many, one, ON, ["count"], ["count"]), 60_000),
    "semi": (lambda many, one: joins.semi_known(many, one, "name"), 20_000 + 20_000),
    "parents": (lambda many, one: rollup.attach_parents(
        many.selectExpr("name AS area_code", "CAST(year AS STRING) AS area_name", "v"),
        one.selectExpr("name AS small_code", "CAST(year AS STRING) AS small_name", "'m' AS mid_code",
                       "'M' AS mid_name", "'d' AS district_code", "'D' AS district_name")), 60_000),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_hot_key_is_split_at_run_time(spark, small_skew, tables, name):
    build, expected = CASES[name]
    out = build(*tables)
    assert len(out.collect()) == expected
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_missing_keys_match_nothing(spark):
    left = spark.createDataFrame([(None, 1), ("A", 1), ("A", None)], "name string, year int")
    right = spark.createDataFrame([(None, 1, 5), ("A", 1, 6), ("A", None, 7)], "name string, year int, count int")
    got = sorted(map(tuple, joins.left_from_skeleton(left, right, ON).collect()), key=str)
    assert got == sorted([(None, 1, None), ("A", 1, 6), ("A", None, None)], key=str)
    assert [tuple(r) for r in joins.inner_on(left, right, ON).collect()] == [("A", 1, 6)]


@pytest.mark.parametrize("name", ["left", "full_outer"])
def test_sides_of_about_one_size_are_not_broadcast(spark, name):
    """A few names spread over years look small to Spark, however many rows they become."""
    spread = spark.range(50).selectExpr("CAST(id AS STRING) AS name", "explode(sequence(1, 40)) AS year")
    out = CASES[name][0](spread.selectExpr("name", "year", "'v' AS v"), spread.selectExpr("name", "year", "1L AS count"))
    assert out.count() == 2000
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
