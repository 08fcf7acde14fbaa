"""Rate-table, regression and cross-validation queries."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.operators import joins, regression
from beatgrid.operators.counts import year_slice
from beatgrid.operators.geometry import shapes_of
from beatgrid.plans import modelling as plan
from beatgrid.sources.tables import clean_rate_table
from workload import views as v
from workload.view_sql import with_views

ONE_YEAR = 1997
K = 10


def _rates(spark: SparkSession, sf: str) -> DataFrame:
    return clean_rate_table(v.rates_raw(spark, sf))


def _frame(spark: SparkSession, sf: str) -> DataFrame:
    return regression.regression_frame(
        v.district_counts(spark, sf), v.rates_text(spark, sf), v.skeleton(spark, sf))


def _rounded(df: DataFrame, digits: int, *keep: str) -> DataFrame:
    """Round measures, and turn a negative zero into zero."""
    return df.select(*[
        F.col(f"`{c}`") if c in keep else (F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c)
        for c in df.columns
    ])


def inner_rate_crime(spark: SparkSession, sf: str) -> DataFrame:
    """One year's counts against every year of rates, as a merge by name gives."""
    counts = year_slice(v.district_counts(spark, sf), [ONE_YEAR]).select("district", "count")
    return joins.inner_on(_rates(spark, sf), counts, ["district"])


def full_outer_rate_crime(spark: SparkSession, sf: str) -> DataFrame:
    return joins.full_outer_on(
        v.rates_text(spark, sf), v.district_counts(spark, sf), ["district", "year"])


def left_skeleton_rates(spark: SparkSession, sf: str) -> DataFrame:
    return joins.left_from_skeleton(
        v.skeleton(spark, sf), full_outer_rate_crime(spark, sf), ["district", "year"])


def simple_regression(spark: SparkSession, sf: str) -> DataFrame:
    rates = year_slice(_rates(spark, sf), [ONE_YEAR])
    counts = year_slice(v.district_counts(spark, sf), [ONE_YEAR]).select("district", "count")
    merged = joins.inner_on(rates, counts, ["district"]).dropna(subset=["rate", "count"])
    return _rounded(regression.simple_regression(merged, "rate", "count"), 6, "n")


def _fit(spark: SparkSession, sf: str) -> regression.Fit:
    return plan.fit_counts(v.district_counts(spark, sf), v.rates_text(spark, sf), v.skeleton(spark, sf))


def ols_multi(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(regression.coefficients(_fit(spark, sf)), 6, "term", "stars")


def ols_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(regression.ols_summary(_fit(spark, sf)), 5, "n", "k", "df_residual")


def ols_many_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Every district a level of its own: counts on rate and population within districts."""
    fit = regression.ols(_frame(spark, sf), "count", plan.PREDICTORS, "district")
    return _rounded(regression.coefficients(fit).filter("term <> 'intercept'").select("term", "estimate", "std_error", "t", "stars"), 5, "term", "stars")


def design_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Label and dummy-coded features of every row of the frame."""
    built = regression.design(_frame(spark, sf), "count", plan.PREDICTORS, "year", v.YEARS)
    return built.select("label", F.array_join(F.transform(vector_to_array("features"), lambda x: F.round(x, 3)), ",").alias("features"))


def ols_kfold_cv(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(plan.validate_counts(_frame(spark, sf), K), 6, "fold", "n_test")


def pairwise_corr(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(regression.pairwise_corr(
        _frame(spark, sf), ["year", "count", "population", "rate"]), 8)


def _district_means(spark: SparkSession, sf: str) -> DataFrame:
    return _frame(spark, sf).groupBy("district").agg(F.avg("rate").alias("rate"), F.sum("count").alias("crime"))


def cluster_districts(spark: SparkSession, sf: str) -> DataFrame:
    return regression.cluster(_district_means(spark, sf), ["rate", "crime"], k=5)


def cluster_facts(spark: SparkSession, sf: str) -> DataFrame:
    """All districts of the skeleton, those without a complete year included, and whether the groups hold."""
    districts = v.skeleton(spark, sf).select("district").distinct()
    whole = joins.left_from_skeleton(districts, _district_means(spark, sf), ["district"])
    return regression.fit_clusters(whole, ["rate", "crime"], k=5).facts()


QUERIES = {
    "rate_table_clean": _rates,
    "semi_known_districts": lambda s, d: joins.semi_known(
        _rates(s, d), shapes_of(v.boundary(s, d)), "district", "name"),
    "inner_rate_crime": inner_rate_crime,
    "full_outer_rate_crime": full_outer_rate_crime,
    "left_skeleton_rates": left_skeleton_rates,
    "regression_frame": _frame,
    "simple_regression": simple_regression,
    "ols_multi": ols_multi,
    "ols_summary": ols_summary,
    "ols_kfold_cv": ols_kfold_cv,
    "pairwise_corr": pairwise_corr,
    "cluster_districts": cluster_districts,
    "cluster_facts": cluster_facts,
    "ols_many_levels": ols_many_levels,
    "design_vectors": design_vectors,
}

# Tails in closed form: finite sums, since the degrees of freedom are whole numbers and F has an even number of them above.
_T_TAIL = """
    CASE WHEN {df} % 2 = 0 THEN 1 - abs({t}) / sqrt({df} + {t} * {t}) * list_sum(list_transform(range(0, {df} // 2),
              lambda k: exp(lgamma(k + 0.5) - ln(pi()) / 2 - lgamma(k + 1.0) + k * ln({df} / ({df} + {t} * {t})))))
         ELSE 1 - 2 / pi() * (atan(abs({t}) / sqrt({df})) + abs({t}) * sqrt({df}) / ({df} + {t} * {t})
              * coalesce(list_sum(list_transform(range(0, ({df} - 1) // 2),
              lambda k: exp(ln(pi()) / 2 - ln(2) + lgamma(k + 1.0) - lgamma(k + 1.5) + k * ln({df} / ({df} + {t} * {t}))))), 0)) END"""
_F_TAIL = """
    list_sum(list_transform(range(0, {above} // 2), lambda j: exp(lgamma({below} / 2 + j) - lgamma({below} / 2) - lgamma(j + 1.0)
             + {below} / 2 * ln({below} / ({below} + {above} * {f})) + j * ln({above} * {f} / ({below} + {above} * {f})))))"""
_STARS = "CASE WHEN p < 0.01 THEN '***' WHEN p < 0.05 THEN '**' WHEN p < 0.1 THEN '*' ELSE '' END AS stars"

# Year effects are removed by centring within years, which leaves two slopes.
_CENTRED = """
    SELECT *, rate - avg(rate) OVER w AS x1, population - avg(population) OVER w AS x2,
           "count" - avg("count") OVER w AS yc
    FROM {source} WINDOW w AS (PARTITION BY {by})"""
_SUMS = """
    SELECT {lead} sum(x1 * x1) AS s11, sum(x1 * x2) AS s12, sum(x2 * x2) AS s22,
           sum(x1 * yc) AS s1y, sum(x2 * yc) AS s2y, sum(yc * yc) AS syy, count(*) AS n,
           count(DISTINCT year) AS levels, var_pop("count") * count(*) AS sst
    FROM centred {group}"""
_SLOPES = """
    SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
           (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2
    FROM sums"""
_FIT = {
    "centred": _CENTRED.format(source="frame", by="year"),
    "sums": _SUMS.format(lead="", group=""),
    "slopes": _SLOPES,
    "effects": """
        SELECT year, avg("count") - any_value(b1) * avg(rate) - any_value(b2) * avg(population) AS a
        FROM frame, slopes GROUP BY year""",
    "base": "SELECT a AS a0 FROM effects ORDER BY year LIMIT 1",
}
# Error of a level: 1/n and the quadratic form of its means (their distance from the base's) with the inverse of the sums.
_INFERENCE = {
    "inverse": """
        SELECT s22 / d AS i11, -s12 / d AS i12, s11 / d AS i22, n - levels - 2 AS df,
               (syy - b1 * s1y - b2 * s2y) / (n - levels - 2) AS v
        FROM (SELECT *, s11 * s22 - s12 * s12 AS d FROM slopes)""",
    "means": "SELECT {by} AS level, count(*) AS nl, avg(rate) AS m1, avg(population) AS m2, avg(\"count\") AS my FROM frame GROUP BY {by}",
    "first": "SELECT nl AS n0, m1 AS f1, m2 AS f2, my - b1 * m1 - b2 * m2 AS a0 FROM means, slopes ORDER BY level LIMIT 1",
    "terms": """
        SELECT 'intercept' AS term, a0 AS estimate,
               sqrt(v * (1.0 / n0 + f1 * f1 * i11 + 2 * f1 * f2 * i12 + f2 * f2 * i22)) AS std_error FROM first, inverse
        UNION ALL
        SELECT '{by}_' || CAST(level AS VARCHAR), my - b1 * m1 - b2 * m2 - a0,
               sqrt(v * (1.0 / nl + 1.0 / n0 + (m1 - f1) ** 2 * i11 + 2 * (m1 - f1) * (m2 - f2) * i12 + (m2 - f2) ** 2 * i22))
        FROM means, slopes, first, inverse WHERE level > (SELECT min(level) FROM means)
        UNION ALL SELECT 'rate', b1, sqrt(v * i11) FROM slopes, inverse
        UNION ALL SELECT 'population', b2, sqrt(v * i22) FROM slopes, inverse""",
    "tested": "SELECT term, estimate, std_error, estimate / std_error AS t, " + _T_TAIL.format(t="(estimate / std_error)", df="df") + " AS p FROM terms, inverse",
}


def _inference(by: str) -> dict[str, str]:
    centred = {"centred": _CENTRED.format(source="frame", by=by), "sums": _SUMS.format(lead="", group="").replace("DISTINCT year", f"DISTINCT {by}"), "slopes": _SLOPES}
    return {**centred, **{name: text.replace("{by}", by) for name, text in _INFERENCE.items()}}


def _measures(names: str, digits: int) -> str:
    return ", ".join(f"round({m}, {digits}) + 0.0 AS {m}" for m in names.split())

_FOLD = """
    SELECT *, CAST(('0x' || substr(md5(district || '|' || CAST(year AS VARCHAR)), 1, 8))::BIGINT % 10
                   AS INTEGER) AS own
    FROM frame"""
_CV = {
    "folded": _FOLD,
    "train": "SELECT f.fold, t.* FROM range(0, 10) f(fold) JOIN folded t ON t.own <> f.fold",
    "centred": _CENTRED.format(source="train", by="fold, year"),
    "sums": _SUMS.format(lead="fold,", group="GROUP BY fold"),
    "slopes": _SLOPES,
    "effects": """
        SELECT fold, year,
               avg("count") - any_value(b1) * avg(rate) - any_value(b2) * avg(population) AS a
        FROM train JOIN slopes USING (fold) GROUP BY fold, year""",
    "tested": """
        SELECT t.own AS fold, count(*) AS n_test,
               avg(("count" - a - b1 * rate - b2 * population) ** 2) AS test_mse
        FROM folded t JOIN effects e ON e.fold = t.own AND e.year = t.year
             JOIN slopes s ON s.fold = t.own GROUP BY t.own""",
    "wide_effects": "SELECT fold, " + ", ".join(
        f"max(a) FILTER (WHERE year = {y}) AS a{y}" for y in v.YEARS) + " FROM effects GROUP BY fold",
    "folds": "SELECT CAST(fold AS INTEGER) AS fold, CAST(n_test AS BIGINT) AS n_test, test_mse, "
             "1 - ((syy - b1 * s1y - b2 * s2y) / (n - levels - 2)) / (sst / (n - 1)) AS adj_r2, "
             f"a{v.YEARS[0]} AS intercept, "
             + ", ".join(f"a{y} - a{v.YEARS[0]} AS year_{y}" for y in v.YEARS[1:])
             + ", b1 AS rate, b2 AS population "
               "FROM tested JOIN slopes USING (fold) JOIN wide_effects USING (fold)",
}
_CV_METRICS = ["test_mse", "adj_r2", "intercept", *[f"year_{y}" for y in v.YEARS[1:]], "rate", "population"]

_PAIRS = f"""
            SELECT r.rate AS x, CAST(c."count" AS DOUBLE) AS y
            FROM rates r JOIN dcounts c ON r.district = c.district AND r.year = c.year
            WHERE r.year = {ONE_YEAR} AND r.rate IS NOT NULL"""

ORACLES = {
    "rate_table_clean": with_views("rates", "SELECT * FROM rates"),
    "semi_known_districts": with_views(
        "rates boundary", "SELECT * FROM rates WHERE district IN (SELECT name FROM boundary)"),
    "inner_rate_crime": with_views("rates dcounts", f"""
        SELECT r.*, c."count" FROM rates r JOIN dcounts c ON r.district = c.district
        WHERE c.year = {ONE_YEAR}"""),
    "full_outer_rate_crime": with_views("merged", "SELECT * FROM merged"),
    "left_skeleton_rates": with_views("skel merged", "SELECT * FROM skel LEFT JOIN merged USING (district, year)"),
    "regression_frame": with_views("frame", "SELECT * FROM frame"),
    "simple_regression": with_views("rates dcounts", """
        SELECT CAST(regr_count(y, x) AS BIGINT) AS n, round(regr_slope(y, x), 6) + 0.0 AS slope,
               round(regr_intercept(y, x), 6) + 0.0 AS intercept, round(corr(y, x), 6) + 0.0 AS r,
               round(sqrt((regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x))
                          / (regr_count(y, x) - 2) / regr_sxx(y, x)), 6) + 0.0 AS std_error,
               (SELECT round(""" + _T_TAIL.format(t="t", df="df") + """, 6) + 0.0 FROM slope_t) AS p
        FROM pairs""", {"pairs": _PAIRS, "slope_t": """
            SELECT CAST(regr_count(y, x) - 2 AS BIGINT) AS df, regr_slope(y, x) / sqrt((regr_syy(y, x) - regr_slope(y, x)
                   * regr_sxy(y, x)) / (regr_count(y, x) - 2) / regr_sxx(y, x)) AS t FROM pairs"""}),
    "ols_multi": with_views("frame", f"SELECT term, {_measures('estimate std_error t p', 6)}, {_STARS} FROM tested", _inference("year")),
    "ols_many_levels": with_views("frame", f"""
        SELECT term, {_measures('estimate std_error t', 5)}, {_STARS} FROM tested WHERE term <> 'intercept'""", _inference("district")),
    "design_vectors": with_views("frame", """
        SELECT "count" AS label, array_to_string(list_transform(list_concat(
                   list_transform(range(1996, 2002), lambda y: CASE WHEN y = year THEN 1.0 ELSE 0.0 END),
                   [rate, population]), lambda x: CAST(round(CAST(x AS DOUBLE), 3) AS VARCHAR)), ',') AS features
        FROM frame"""),
    "cluster_facts": with_views("skel frame", """
        SELECT count(*) AS rows, count(*) FILTER (WHERE district NOT IN (SELECT district FROM frame)) AS unlabelled,
               CAST(5 AS BIGINT) AS groups, CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS moved
        FROM (SELECT DISTINCT district FROM skel)"""),
    "ols_summary": with_views("frame", """
        SELECT n, CAST(k AS INTEGER) AS k, CAST(n - k - 1 AS INTEGER) AS df_residual,
               round(1 - sse / sst, 5) + 0.0 AS r2,
               round(1 - (sse / (n - k - 1)) / (sst / (n - 1)), 5) + 0.0 AS adj_r2,
               round(((sst - sse) / k) / (sse / (n - k - 1)), 5) + 0.0 AS f_value,
               round(""" + _F_TAIL.format(above="k", below="(n - k - 1)", f="(((sst - sse) / k) / (sse / (n - k - 1)))") + """, 5) + 0.0 AS f_p,
               round(sqrt(sse / (n - k - 1)), 5) + 0.0 AS residual_error,
               round(q[1], 5) + 0.0 AS res_min, round(q[2], 5) + 0.0 AS res_q1,
               round(q[3], 5) + 0.0 AS res_median, round(q[4], 5) + 0.0 AS res_q3,
               round(q[5], 5) + 0.0 AS res_max
        FROM measures, residuals""", {**_FIT,
            "measures": "SELECT n, levels + 1 AS k, sst, syy - b1 * s1y - b2 * s2y AS sse FROM slopes",
            "residuals": """
                SELECT quantile_cont("count" - a - b1 * rate - b2 * population, [0, 0.25, 0.5, 0.75, 1]) AS q
                FROM frame JOIN effects USING (year), slopes"""}),
    "ols_kfold_cv": with_views("frame",
        "SELECT fold, n_test, " + ", ".join(f"round({m}, 6) + 0.0 AS {m}" for m in _CV_METRICS)
        + " FROM folds UNION ALL SELECT -1, CAST(sum(n_test) AS BIGINT), "
        + ", ".join(f"round(avg({m}), 6) + 0.0" for m in _CV_METRICS) + " FROM folds", _CV),
    "pairwise_corr": with_views("frame", """
        SELECT round(corr(year, "count"), 8) + 0.0 AS year_count,
               round(corr(year, population), 8) + 0.0 AS year_population,
               round(corr(year, rate), 8) + 0.0 AS year_rate,
               round(corr("count", population), 8) + 0.0 AS count_population,
               round(corr("count", rate), 8) + 0.0 AS count_rate,
               round(corr(population, rate), 8) + 0.0 AS population_rate
        FROM frame"""),
}
