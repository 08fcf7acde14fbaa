import math
import random

import numpy as np
import pytest

from beatgrid.functions import grid
from beatgrid.operators import geometry, joins, layers
from beatgrid.plans import mapping as plan
from beatgrid.vocabulary import (
    COUNT_BAND_COLOURS,
    CYCLE_COLOURS,
    EQUAL_WIDTH_COLOURS,
    FIXED_BAND_COLOURS,
    RATE_BAND_COLOURS,
)


def degrees(d, m, s):
    return d + m / 60 + s / 3600


def test_published_worked_example(spark):
    """A triangulation point with published grid and satellite coordinates.

    The seven-parameter shift is good to a few metres (1e-4 degrees is 11 m)."""
    df = spark.createDataFrame([(651409.903, 313177.270)], "x double, y double")
    row = grid.reproject(df).first()
    assert row["lat"] == pytest.approx(degrees(52, 39, 28.723), abs=1e-4)
    assert row["lon"] == pytest.approx(degrees(1, 42, 57.787), abs=1e-4)


def test_true_origin_falls_on_its_meridian(spark):
    df = spark.createDataFrame([(400000.0, -100000.0), (400000.0, 650000.0)], "x double, y double")
    rows = grid.reproject(df).collect()
    assert rows[0]["lat"] == pytest.approx(49.0, abs=2e-3) and rows[0]["lon"] == pytest.approx(-2.0, abs=2e-3)
    assert rows[1]["lat"] > 55 and rows[1]["lon"] == pytest.approx(-2.0, abs=2e-3)


def test_reprojection_stays_in_generated_code(spark):
    df = spark.range(10).selectExpr("400000D + id AS x", "200000D + id AS y")
    text = grid.reproject(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text and "*(1) Project" in text


def test_rings_follow_the_vertex_order_in_bounded_pieces(spark):
    rng = random.Random(1)
    points = [(1, "One", s, float(s), -float(s)) for s in range(250)] + [(2, "Two", 10 * s, 1.0, 2.0) for s in range(5)]
    rng.shuffle(points)
    vertices = spark.createDataFrame(points, "shape_id bigint, name string, seq bigint, lat double, lon double")
    whole = {r["shape_id"]: r for r in geometry.assemble_rings(vertices).collect()}
    assert whole[1]["lats"] == [float(s) for s in range(250)] and whole[1]["piece"] == 0
    assert len(whole[2]["longs"]) == 5
    pieces = geometry.assemble_rings(vertices, piece_span=100)
    rows = sorted((r for r in pieces.collect() if r["shape_id"] == 1), key=lambda r: r["piece"])
    assert [len(r["lats"]) for r in rows] == [100, 100, 50]
    assert sum((r["lats"] for r in rows), []) == whole[1]["lats"]
    flat = geometry.flatten_rings(pieces).select("shape_id", "name", "seq", "lat", "lon")
    assert sorted(map(tuple, flat.collect())) == sorted(points)


def test_colours_cycle_by_shape_id(spark):
    shapes = spark.createDataFrame([(i * 3, f"S{i}") for i in range(14)], "shape_id bigint, name string")
    rows = geometry.cycle_colours(shapes).orderBy("shape_id").collect()
    assert [r["color"] for r in rows] == [CYCLE_COLOURS[i % 6] for i in range(14)]
    assert geometry.distinct_names(shapes).first()["names"] == 14


def test_first_match_takes_the_first_row_or_nothing(spark):
    left = spark.createDataFrame([("A",), ("B",), ("A",)], "name string")
    right = spark.createDataFrame([("A", 2012, 5.0), ("A", 2011, None), ("C", 2011, 1.0)],
                                  "name string, year int, rate double")
    rows = joins.first_match(left, right, ["name"], ["rate"], ["year"]).collect()
    assert sorted(map(tuple, rows), key=str) == [("A", None), ("A", None), ("B", None)]
    again = joins.first_match(left, right.dropna(), ["name"], ["rate"], ["year"]).collect()
    assert sorted(map(tuple, again), key=str) == [("A", 5.0), ("A", 5.0), ("B", None)]


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(2)
    rows = [(i, f"S{i}", 2011 + i % 3, None if i % 9 == 0 else round(rng.uniform(0.1, 20), 1), rng.randint(1, 500))
            for i in range(90)]
    return spark.createDataFrame(rows, "shape_id bigint, name string, year int, rate double, count bigint")


def banded(value, mean, sd, colours):
    if value is None:
        return "black"
    return colours[sum(value >= limit for limit in (mean - sd, mean, mean + sd))]


def test_pooled_bands(values):
    rows = values.collect()
    by_year = [[r["rate"] for r in rows if r["year"] == y and r["rate"] is not None] for y in (2011, 2012, 2013)]
    mean, sd = np.mean([np.mean(g) for g in by_year]), np.mean([np.std(g) for g in by_year])
    stats = layers.mean_sd(values, "rate", "year").first()
    assert (stats["mean"], stats["sd"]) == pytest.approx((mean, sd))
    for r in plan.classify_pooled(values).collect():
        assert r["color"] == banded(r["rate"], mean, sd, RATE_BAND_COLOURS)


def test_limits_are_computed_without_a_join(values):
    text = plan.classify_pooled(values)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Subquery" in text


def test_count_and_fixed_bands(values):
    counts = [r["count"] for r in values.collect()]
    for r in layers.classify_counts_half_sd(values, "count").collect():
        assert r["color"] == banded(r["count"], np.mean(counts), np.std(counts) / 2, COUNT_BAND_COLOURS)
    for r in layers.classify_by_breaks(values, "rate").collect():
        assert r["color"] == banded(r["rate"], 6.7, 2.9, FIXED_BAND_COLOURS)


def test_fixed_limits_are_mean_plus_minus_deviation_in_double_arithmetic(spark):
    """6.7 - 2.9 lies just above 3.8, so a rate of 3.8 is in the lowest class."""
    df = spark.createDataFrame([(3.8,), (9.6,)], "rate double")
    got = [r["color"] for r in layers.classify_by_breaks(df, "rate").collect()]
    assert got == [FIXED_BAND_COLOURS[0], FIXED_BAND_COLOURS[3]]


def test_equal_width_truncates_toward_zero_and_caps(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.7, 1.8, 3.8, 5.9, 15.8, 99.0, None, math.nan)], "rate double")
    got = [r["color"] for r in layers.classify_equal_width(df, "rate").collect()]
    expected = [EQUAL_WIDTH_COLOURS[min(int(v / 2 - 0.9), 7)] for v in (0.0, 1.7, 1.8, 3.8, 5.9, 15.8, 99.0)]
    assert got == [*expected, "black", "black"]


def test_cluster_colours(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, None)], "cluster int")
    got = [r["color"] for r in layers.classify_clusters(df).collect()]
    assert got == [*COUNT_BAND_COLOURS, "black", "white"]


def test_min_max_by_year(values):
    rows = {r["year"]: (r["min_rate"], r["max_rate"]) for r in layers.min_max_by(values, "rate", "year").collect()}
    mine = [r["rate"] for r in values.collect() if r["year"] == 2012 and r["rate"] is not None]
    assert rows[2012] == (min(mine), max(mine))


def test_yearly_layer_has_a_row_per_shape_and_year(spark):
    vertices = spark.createDataFrame(
        [(i, f"S{i}", s, 400000.0 + 1000 * s, 300000.0 + 500 * i) for i in range(4) for s in range(6)],
        "shape_id bigint, name string, seq bigint, x double, y double")
    rates = spark.createDataFrame([("S0", 2011, 5.0), ("S1", 2011, 9.0), ("S0", 2012, 6.0)],
                                  "district string, year int, rate double")
    counts = spark.createDataFrame([("S0", 2011, 50), ("S9", 2011, 1)], "district string, year int, count bigint")
    rows = plan.yearly_layer(vertices, rates, counts, [2011, 2012]).collect()
    assert len(rows) == 8 and all(len(r["lats"]) == 6 for r in rows)
    at = {(r["name"], r["year"]): r for r in rows}
    assert at["S0", 2011]["rate"] == 5.0 and at["S0", 2011]["count"] == 50
    assert at["S2", 2012]["rate"] is None and at["S2", 2012]["color"] == "black"
    clusters = spark.createDataFrame([("S0", 5.0, 50.0, 2), ("S1", 1.0, 1.0, 5)],
                                     "district string, rate double, crime double, cluster int")
    colours = {r["name"]: r["color"] for r in plan.cluster_layer(vertices, clusters).collect()}
    assert colours == {"S0": COUNT_BAND_COLOURS[1], "S1": "black", "S2": "white", "S3": "white"}


def test_only_known_districts_stay(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "district string, v int")
    known = spark.createDataFrame([("A",), ("A",)], "name string")
    assert [tuple(r) for r in joins.semi_known(df, known, "district", "name").collect()] == [("A", 1)]
