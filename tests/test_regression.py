import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatgrid.functions.folds import hash_fold
from beatgrid.functions.tails import _fraction_steps, f_tail, incomplete_beta, t_tail, t_tail_column
from beatgrid.operators import joins, ranking, regression
from beatgrid.plans import modelling as plan

YEARS = (2011, 2012, 2013)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    out = []
    for i in range(240):
        year, rate, pop = YEARS[i % 3], float(rng.uniform(2, 12)), float(rng.uniform(50_000, 400_000))
        count = -500 + 800 * (year == 2012) + 300 * (year == 2013) + 90 * rate + 0.01 * pop + rng.normal(0, 200)
        out.append((f"D{i}", year, round(count, 3), round(rate, 2), round(pop)))
    return out


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(
        [(d, y, c, r, float(p)) for d, y, c, r, p in data],
        "district string, year int, count double, rate double, population double").repartition(5).cache()


def matrix(rows):
    x = np.array([[1, y == 2012, y == 2013, r, p] for _, y, _, r, p in rows], dtype=float)
    return x, np.array([c for _, _, c, _, _ in rows])


def fit(x, y):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    return beta, float(((y - x @ beta) ** 2).sum())


def test_coefficients_errors_and_p_values(frame, data):
    result = regression.ols(frame, "count", plan.PREDICTORS, "year")
    rows = {r["term"]: r for r in regression.coefficients(result).collect()}
    x, y = matrix(data)
    beta, sse = fit(x, y)
    errors = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * sse / (len(y) - 5))
    for term, b, e in zip(("intercept", "year_2012", "year_2013", "rate", "population"), beta, errors):
        assert rows[term]["estimate"] == pytest.approx(b, rel=1e-6)
        assert rows[term]["std_error"] == pytest.approx(e, rel=1e-6)
        assert rows[term]["t"] == pytest.approx(b / e, rel=1e-6)
        assert rows[term]["p"] == pytest.approx(t_tail(b / e, len(y) - 5), rel=1e-6, abs=1e-12)
    assert rows["rate"]["stars"] == "***"


def test_summary_measures_and_quartiles(frame, data):
    row = regression.ols_summary(regression.ols(frame, "count", plan.PREDICTORS, "year")).first()
    x, y = matrix(data)
    beta, sse = fit(x, y)
    sst = float(((y - y.mean()) ** 2).sum())
    assert (row["n"], row["k"], row["df_residual"]) == (240, 4, 235)
    assert row["r2"] == pytest.approx(1 - sse / sst)
    assert row["adj_r2"] == pytest.approx(1 - (sse / 235) / (sst / 239))
    assert row["f_value"] == pytest.approx(((sst - sse) / 4) / (sse / 235))
    assert row["residual_error"] == pytest.approx(math.sqrt(sse / 235))
    quartiles = np.quantile(y - x @ beta, [0, 0.25, 0.5, 0.75, 1])
    assert [row[c] for c in ("res_min", "res_q1", "res_median", "res_q3", "res_max")] == pytest.approx(list(quartiles))


def test_cross_validation_equals_refitting_each_fold(frame, data, spark):
    k = 5
    folds = {r["district"]: r["fold"] for r in frame.select(
        "district", hash_fold(plan.district_year_key(), k).alias("fold")).collect()}
    got = {r["fold"]: r for r in plan.validate_counts(frame, k).collect()}
    errors = []
    for fold in range(k):
        x, y = matrix([r for r in data if folds[r[0]] != fold])
        tx, ty = matrix([r for r in data if folds[r[0]] == fold])
        beta, sse = fit(x, y)
        errors.append(float(((ty - tx @ beta) ** 2).mean()))
        adjusted = 1 - (sse / (len(y) - 5)) / (((y - y.mean()) ** 2).sum() / (len(y) - 1))
        row = got[fold]
        assert row["n_test"] == len(ty)
        assert row["test_mse"] == pytest.approx(errors[-1], rel=1e-8)
        assert row["adj_r2"] == pytest.approx(adjusted, rel=1e-8)
        assert [row[c] for c in ("intercept", "year_2012", "year_2013", "rate", "population")] == pytest.approx(list(beta), rel=1e-6)
    assert got[-1]["test_mse"] == pytest.approx(np.mean(errors), rel=1e-8)
    assert got[-1]["n_test"] == len(data)


def test_cross_validation_reads_the_frame_once(frame, spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("cv", "cv")
    regression.kfold_cv(frame, "count", plan.PREDICTORS, "year", plan.district_year_key(), 5)
    jobs = tracker.getJobIdsForGroup("cv")
    spark.sparkContext.setJobGroup("other", "other")
    assert 1 <= len(jobs) <= 4  # shuffle stages of one aggregate and its fetch


def test_simple_regression(frame, data):
    row = regression.simple_regression(frame, "rate", "count").first()
    x, y = np.array([r[3] for r in data]), np.array([r[2] for r in data])
    slope, intercept = np.polyfit(x, y, 1)
    assert (row["slope"], row["intercept"]) == pytest.approx((slope, intercept))
    assert row["r"] == pytest.approx(np.corrcoef(x, y)[0, 1])
    error = math.sqrt(((y - intercept - slope * x) ** 2).sum() / 238 / ((x - x.mean()) ** 2).sum())
    assert row["std_error"] == pytest.approx(error)
    assert regression.slope_p_value(regression.simple_regression(frame, "rate", "count")) == pytest.approx(
        t_tail(slope / error, 238))


def test_tails_at_published_points():
    assert t_tail(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert t_tail(12.7062, 1) == pytest.approx(0.05, abs=1e-6)
    assert f_tail(4.964603, 1, 10) == pytest.approx(0.05, abs=1e-6)
    assert f_tail(3.325835, 5, 10) == pytest.approx(0.05, abs=1e-6)
    assert incomplete_beta(2, 3, 0.4) == pytest.approx(0.5248)
    assert f_tail(2047.428, 6, 1503) < 1e-300 or f_tail(2047.428, 6, 1503) == pytest.approx(0, abs=1e-12)


def test_frame_keeps_complete_skeleton_rows(spark):
    counts = spark.createDataFrame([("A", 2011, 5), ("A", 2012, 6), ("B", 2011, 7), ("Z", 2011, 1)],
                                   "district string, year int, count bigint")
    rates = spark.createDataFrame(
        [("A", 2011, "7.5", "100"), ("A", 2012, "!", "100"), ("B", 2011, "n/a", "90"), ("C", 2011, "4.0", "80"),
         ("Column Total", 2011, "5", "1")], "district string, year int, rate string, population string")
    skeleton = spark.createDataFrame(
        [(d, y) for d in ("A", "B", "C", "D", "Column Total") for y in (2011, 2012)], "district string, year int")
    out = regression.regression_frame(counts, rates, skeleton).collect()
    assert [tuple(r) for r in out] == [("A", 2011, 5.0, 7.5, 100.0)]
    plan_text = regression.regression_frame(counts, rates, skeleton)._jdf.queryExecution().optimizedPlan().toString()
    assert "Outer" not in plan_text and plan_text.count("Join Inner") == 2


def test_full_outer_keeps_both_sides(spark):
    left = spark.createDataFrame([("A", 1, 10), ("A", 1, 11), ("B", 1, 12), (None, 1, 13)], "k string, y int, a int")
    right = spark.createDataFrame([("A", 1, "x"), ("A", 1, "z"), ("C", 2, "w"), (None, 1, "n")], "k string, y int, b string")
    got = sorted(map(tuple, joins.full_outer_on(left, right, ["k", "y"]).collect()), key=str)
    assert got == sorted(map(tuple, left.join(right, ["k", "y"], "full_outer").collect()), key=str)
    assert len(got) == 4 + 2 + 2


@pytest.mark.parametrize("span", [7, 1000])
def test_exact_quantiles_over_many_ranges(spark, span):
    values = [float((i * 37) % 101) / 3 for i in range(500)] + [4.0] * 260
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(6)
    probabilities = [0, 0.1, 0.25, 0.5, 0.77, 1]
    got = ranking.exact_quantiles(df, "v", probabilities, rows_per_range=span)
    assert got == pytest.approx(list(np.quantile(values, probabilities)))


@pytest.mark.parametrize("span", [9, 1000])
def test_global_index_over_many_ranges(spark, span):
    ids = sorted({(i * i * 7919) % 100_003 for i in range(300)})
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(6)
    got = {r["id"]: r["index"] for r in ranking.global_index(df, "id", rows_per_range=span).collect()}
    assert got == {v: n for n, v in enumerate(ids)}


def test_clusters_separate_far_groups(spark):
    rows = [(f"D{i}", float(i % 5) * 100 + i * 0.01, float(i % 5) * -50 + i * 0.01) for i in range(100)]
    rows.append(("gap", None, 1.0))
    df = spark.createDataFrame(rows, "district string, rate double, crime double")
    out = regression.cluster(df, ["rate", "crime"]).collect()
    groups = {}
    assert [r["cluster"] for r in out if r["district"] == "gap"] == [None]
    for r in out:
        if r["district"] == "gap":
            continue
        groups.setdefault(int(r["district"][1:]) % 5, set()).add(r["cluster"])
    assert len(out) == 101
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == 5


def test_pairwise_correlations(frame, data):
    row = regression.pairwise_corr(frame, ["year", "count", "rate"]).first()
    expected = np.corrcoef([r[1] for r in data], [r[2] for r in data])[0, 1]
    assert row["year_count"] == pytest.approx(expected)
    assert set(row.asDict()) == {"year_count", "year_rate", "count_rate"}


def test_folds_are_known_values(spark):
    got = spark.sql("SELECT 'k1' AS k").select(hash_fold(F.col("k"), 10)).first()[0]
    assert got == 6


def test_tail_columns_equal_the_numbers(spark):
    points = [(t, d) for t in (-40.0, -2.5, 0.0, 1e-3, 0.5, 1.6, 1.8, 3.0, 12.7) for d in (1, 2, 3, 7, 30, 99, 101, 1503, 20_000)]
    df = spark.createDataFrame([(t, d) for t, d in points] + [(None, 3), (1.0, None), (1.0, 0)], "t double, d int")
    got = {(r["t"], r["d"]): r["p"] for r in df.select("t", "d", t_tail_column(F.col("t"), F.col("d")).alias("p")).collect()}
    for t, d in points:
        assert got[t, d] == pytest.approx(t_tail(t, d), rel=1e-8, abs=1e-13)
    assert got[None, 3] is None and got[1.0, None] is None and got[1.0, 0] is None


def many_levels(n):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(n):
        for _ in range(3):
            x = rng.uniform(0, 10, 2)
            rows.append((f"L{i:05d}", float(x[0]), float(x[1]), float(i % 17 + 2 * x[0] - 3 * x[1] + rng.normal())))
    return rows


def test_fit_of_thousands_of_levels(spark):
    rows = many_levels(5000)
    df = spark.createDataFrame(rows + [("L00001", None, 1.0, 1.0), (None, 1.0, 1.0, 1.0), ("L00002", float("nan"), 1.0, 1.0)],
                               "place string, a double, b double, y double").repartition(4)
    fitted = regression.ols(df, "y", ["a", "b"], "place")
    got = {r["term"]: r for r in regression.coefficients(fitted).collect()}
    assert len(got) == 5002 and fitted.df_residual == 15_000 - 5002
    x, y = np.array([r[1:3] for r in rows]), np.array([r[3] for r in rows])
    centred = lambda v: v - np.repeat(v.reshape(5000, 3, -1).mean(axis=1), 3, axis=0).reshape(v.shape)
    cx, cy = centred(x), centred(y)
    slopes = np.linalg.lstsq(cx, cy, rcond=None)[0]
    variance = ((cy - cx @ slopes) ** 2).sum() / fitted.df_residual
    inverse = np.linalg.inv(cx.T @ cx)
    assert [got[c]["estimate"] for c in "ab"] == pytest.approx(list(slopes))
    assert [got[c]["std_error"] for c in "ab"] == pytest.approx(list(np.sqrt(np.diag(inverse) * variance)))
    mean_x, mean_y = x.reshape(5000, 3, 2).mean(axis=1), y.reshape(5000, 3).mean(axis=1)
    effects = mean_y - mean_x @ slopes
    apart = mean_x[4321] - mean_x[0]
    assert got["place_L04321"]["estimate"] == pytest.approx(effects[4321] - effects[0])
    assert got["place_L04321"]["std_error"] == pytest.approx(math.sqrt(variance * (2 / 3 + apart @ inverse @ apart)))
    assert got["intercept"]["std_error"] == pytest.approx(math.sqrt(variance * (1 / 3 + mean_x[0] @ inverse @ mean_x[0])))
    assert regression.residuals(fitted).agg(F.sum(F.col("residual") ** 2)).first()[0] == pytest.approx(fitted.sse)


def test_validation_of_thousands_of_levels(spark):
    rows = many_levels(4200)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, place string, a double, b double, y double").repartition(4)
    key = F.col("id").cast("string")
    found = regression.kfold_fits(df, "y", ["a", "b"], "place", key, 3)
    folds = {r["id"]: r["fold"] for r in df.select("id", hash_fold(key, 3).alias("fold")).collect()}
    for row in found.folds().collect():
        train = [r for i, r in enumerate(rows) if folds[i] != row["fold"]]
        groups = {}
        for r in train:
            groups.setdefault(r[0], []).append(r[1:])
        means = {g: np.mean(v, axis=0) for g, v in groups.items()}
        c = np.array([np.array(r[1:]) - means[r[0]] for r in train])
        assert [row["a"], row["b"]] == pytest.approx(list(np.linalg.lstsq(c[:, :2], c[:, 2], rcond=None)[0]))
        assert math.isnan(row["test_mse"])  # some place has all its rows in one fold
    seen = [r for r in many_levels(400) for _ in range(4)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(seen)], "id int, place string, a double, b double, y double")
    found = regression.kfold_fits(df, "y", ["a", "b"], "place", key, 2)
    effects = {(r["fold"], r["level"]): r["effect"] for r in found.effects().collect()}
    folds = {r["id"]: r["fold"] for r in df.select("id", hash_fold(key, 2).alias("fold")).collect()}
    for row in found.folds().collect():
        own = [r for i, r in enumerate(seen) if folds[i] == row["fold"]]
        errors = [(r[3] - effects[row["fold"], r[0]] - row["a"] * r[1] - row["b"] * r[2]) ** 2 for r in own]
        assert row["n_test"] == len(own) and row["test_mse"] == pytest.approx(np.mean(errors))


@pytest.mark.parametrize("scale", ["spread", "one far value", "signed"])
def test_exact_quantiles_of_uneven_values(spark, scale):
    rng = np.random.default_rng(3)
    values = {"spread": 10.0 ** rng.uniform(-40, 40, 3000), "one far value": np.r_[rng.normal(size=3000), 1e308, -1e308],
              "signed": np.r_[rng.normal(size=1500) * 1e9, np.zeros(1500), [math.inf]]}[scale]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
    if scale == "signed":
        df = df.filter("v < 1e300 OR v IS NULL")
        values = values[:-1]
    probabilities = [0, 0.013, 0.5, 0.9, 1]
    assert ranking.exact_quantiles(df, "v", probabilities, rows_per_range=50, bins=64) == pytest.approx(list(np.quantile(values, probabilities)))


def test_index_of_an_input_that_is_written_once(spark):
    df = spark.createDataFrame([(i * 7 % 1000,) for i in range(1000)], "id int").repartition(3)
    assert all(r["id"] == r["index"] for r in ranking.global_index(df, "id").collect())
    assert ranking.global_index(df.limit(0), "id").collect() == []


def test_clusters_do_not_depend_on_the_order_of_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(400, 2)) * [3, 50])]
    schema = "id int, a double, b double"
    first = {r["id"]: r["cluster"] for r in regression.cluster(spark.createDataFrame(rows, schema).repartition(7), ["a", "b"], 4).collect()}
    second = regression.fit_clusters(spark.createDataFrame(rows[::-1], schema).repartition(3, "id"), ["a", "b"], 4)
    assert first == {r["id"]: r["cluster"] for r in second.rows.collect()}
    z = np.array([r[1:] for r in rows])
    z = (z - z.mean(axis=0)) / z.std(axis=0, ddof=1)
    centres = np.array([z[[i for i in first if first[i] == c]].mean(axis=0) for c in range(1, 5)])
    assert (((z[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1) + 1 == [first[i] for i in range(400)]).all()
    assert tuple(second.facts().first()) == (400, 0, 4, 0, 0)


def test_clusters_of_few_equal_or_no_rows(spark):
    schema = "id int, a double, b double"
    got = regression.fit_clusters(spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 2.0), (3, None, 1.0)], schema), ["a", "b"])
    assert sorted((r["id"], r["cluster"]) for r in got.rows.collect() if r["id"] < 3) == [(1, 1), (2, 1)]
    assert tuple(got.facts().first()) == (3, 1, 1, 0, 0)
    assert tuple(regression.fit_clusters(spark.createDataFrame([(3, None, 1.0)], schema), ["a", "b"]).facts().first()) == (1, 1, 0, 0, 0)
    assert regression.cluster(spark.createDataFrame([], schema), ["a", "b"]).collect() == []


def test_tails_of_millions_of_degrees_take_few_steps(spark):
    points = [t / 100 for t in range(5, 700, 15)] + [1.7320, 1.7321, 30.0, -2.0]
    df = spark.createDataFrame([(t, d) for t in points for d in (1, 2, 5, 40_000, 30_000_000)], "t double, d int")
    x, a = F.col("d") / (F.col("d") + F.col("t") ** 2), F.col("d") / 2
    steps = _fraction_steps(F.col("t"), x < (a + 1) / (a + 2.5))
    for r in df.select("t", "d", t_tail_column(F.col("t"), F.col("d")).alias("p"), steps.alias("steps")).collect():
        expected = math.erfc(abs(r["t"]) / math.sqrt(2)) if r["d"] > 10**6 else t_tail(r["t"], r["d"])
        assert r["p"] == pytest.approx(expected, rel=1e-5 if r["d"] > 10**6 else 1e-9, abs=1e-13)
        assert r["steps"] <= 200
