"""Regression frame, least squares, cross-validation, correlation, clusters.

Fits work on district-by-year frames, but nothing assumes that they are small:
sums are distributed, and the driver only sees model-sized results.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations, combinations_with_replacement

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from beatgrid.functions.folds import hash_fold
from beatgrid.functions.tails import f_tail, stars, t_tail, t_tail_column
from beatgrid.functions.text import is_number, to_double
from beatgrid.operators.joins import join_reduced, left_from_skeleton
from beatgrid.operators.ranking import exact_quantiles
from beatgrid.sources.staging import materialise
from beatgrid.sources.tables import drop_markers, drop_named_row
from beatgrid.vocabulary import RATE_MARKERS, RATE_TOTAL_ROW

# --- frame --------------------------------------------------------------------

def regression_frame(counts: DataFrame, rates: DataFrame, skeleton: DataFrame,
                     on: Sequence[str] = ("district", "year"), rate: str = "rate",
                     population: str = "population", count: str = "count",
                     markers=RATE_MARKERS, total_row: str = RATE_TOTAL_ROW) -> DataFrame:
    """One complete row per skeleton district and year.

    ``rates`` holds text; marker and summary rows are dropped after the joins,
    the rest is cast, and rows with anything missing go. Since the skeleton
    decides the rows, counts and rates are attached to it one after the other
    instead of being merged first. Completeness is one condition per column,
    which lets the optimizer turn the outer joins into inner ones and filter
    both inputs before the shuffle.
    """
    frame = left_from_skeleton(left_from_skeleton(skeleton, counts, on), rates, on)
    frame = drop_named_row(drop_markers(frame, rate, markers), on[0], total_row)
    numbers = frame.select(
        *on,
        F.col(count).cast("double").alias(count),
        to_double(rate).alias(rate),
        to_double(population).alias(population),
    )
    return numbers.filter(is_number(count) & is_number(rate) & is_number(population))


# --- one predictor --------------------------------------------------------------

def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept, correlation, slope error and its two-sided p-value of ``y`` on ``x``, one row."""
    sums = df.agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_sxx(F.col(y), F.col(x)).alias("sxx"),
        F.regr_syy(F.col(y), F.col(x)).alias("syy"),
        F.regr_sxy(F.col(y), F.col(x)).alias("sxy"),
    )
    residual = F.col("syy") - F.col("slope") * F.col("sxy")
    measures = sums.select(
        "n", "slope", "intercept",
        (F.col("sxy") / F.sqrt(F.col("sxx") * F.col("syy"))).alias("r"),
        F.sqrt(residual / (F.col("n") - 2) / F.col("sxx")).alias("std_error"),
    )
    return measures.withColumn("p", t_tail_column(F.col("slope") / F.col("std_error"), F.col("n") - 2))


def slope_p_value(result: DataFrame) -> float:
    """Two-sided p-value of the slope in a ``simple_regression`` result."""
    row = result.first()
    return t_tail(row["slope"] / row["std_error"], row["n"] - 2)


# --- moments ----------------------------------------------------------------------

def complete_rows(df: DataFrame, y: str, xs: Sequence[str], factor: str) -> DataFrame:
    """Rows in which the factor is given and all measures are numbers."""
    whole = F.col(factor).isNotNull()
    for c in (y, *xs):
        whole &= F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.filter(whole)


def cross_moments(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Count, means and centred cross products per group."""
    names = [*xs, y]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(v).alias(f"mean_{i}") for i, v in enumerate(names)],
        *[(F.covar_pop(F.col(names[i]).cast("double"), F.col(names[j]).cast("double")) * F.count(F.lit(1))).alias(f"c_{i}_{j}")
          for i, j in _upper(len(names))],
    )


def _upper(size: int) -> list[tuple[int, int]]:
    return list(combinations_with_replacement(range(size), 2))


def _matrix(row, size: int, prefix: str) -> np.ndarray:
    """The symmetric matrix in the columns ``<prefix>_i_j`` of a row."""
    out = np.zeros((size, size))
    for i, j in _upper(size):
        out[i, j] = out[j, i] = row[f"{prefix}_{i}_{j}"]
    return out


def _inverse(square: np.ndarray) -> np.ndarray:
    """Inverse of a matrix of cross products, scaled first as its columns may differ by many orders."""
    scale = np.sqrt(np.diag(square))
    return np.linalg.inv(square / np.outer(scale, scale)) / np.outer(scale, scale)


def _dot(columns: Sequence[Column], weights) -> Column:
    return reduce(lambda a, b: a + b, [c * F.lit(float(w)) for c, w in zip(columns, weights)])


# --- several predictors and one factor ------------------------------------------

def design(df: DataFrame, y: str, xs: Sequence[str], factor: str, levels: Sequence) -> DataFrame:
    """Label and feature vector. The first of the given levels of the factor is the base."""
    dummies = {f"{factor}_{v}": F.when(F.col(factor) == v, 1.0).otherwise(0.0) for v in levels[1:]}
    inputs = [*dummies, *xs]
    wide = df.withColumns(dummies).withColumn("label", F.col(y).cast("double"))
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(wide).select(
        "label", "features"
    )


@dataclass
class Fit:
    """Slopes and their moments; the levels of the factor stay a table, one row per level. ``base`` is the smallest one's row."""
    y: str
    xs: list[str]
    factor: str
    frame: DataFrame
    levels: DataFrame
    n: int
    n_levels: int
    base: Row
    slopes: np.ndarray
    inverse: np.ndarray
    sse: float
    sst: float

    @property
    def predictors(self) -> int:
        return self.n_levels - 1 + len(self.xs)

    @property
    def df_residual(self) -> int:
        return self.n - self.predictors - 1

    @property
    def variance(self) -> float:
        """Of the residuals; not a number where no degree of freedom is left."""
        return max(self.sse, 0.0) / self.df_residual if self.df_residual > 0 else math.nan


def ols(df: DataFrame, y: str, xs: Sequence[str], factor: str) -> Fit:
    """Least squares of ``y`` on ``xs`` and one effect per level of ``factor``.

    The factor is absorbed: cross products are centred within each level by one
    aggregate over the rows, so the driver solves for the slopes alone, and the
    levels, however many, are a table whose effects are columns. Incomplete rows go.
    """
    size = len(xs) + 1
    frame = materialise(complete_rows(df.select(y, *xs, factor), y, xs, factor), "ols-frame")
    levels = materialise(cross_moments(frame, y, xs, [factor]), "ols-levels")
    mean_y = F.col(f"mean_{len(xs)}")
    within = levels.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("levels"), (F.sum(F.col("n") * mean_y) / F.sum("n")).alias("mean"),
        F.min_by(F.struct(*levels.columns), factor).alias("base"),
        *[F.sum(f"c_{i}_{j}").alias(f"w_{i}_{j}") for i, j in _upper(size)]).first()
    if not within["n"]:
        raise ValueError("no complete rows to fit")
    between = levels.agg(F.sum(F.col("n") * (mean_y - F.lit(within["mean"])) ** 2)).first()[0]
    w = _matrix(within, size, "w")
    inverse = _inverse(w[:-1, :-1])
    slopes = inverse @ w[:-1, -1]
    return Fit(y, list(xs), factor, frame, levels, int(within["n"]), int(within["levels"]), within["base"], slopes, inverse,
               float(w[-1, -1] - slopes @ w[:-1, -1]), float(w[-1, -1] + between))


def level_effects(fit: Fit) -> DataFrame:
    """``(level, effect, n)``: what each level adds to the slopes' part, in full, and its rows."""
    p = len(fit.xs)
    effect = F.col(f"mean_{p}") - _dot([F.col(f"mean_{i}") for i in range(p)], fit.slopes)
    return fit.levels.select(F.col(fit.factor).alias("level"), effect.alias("effect"), "n")


def _quadratic(columns: Sequence[Column], matrix: np.ndarray) -> Column:
    terms = [columns[i] * columns[j] * F.lit(float(matrix[i, j]) * (1 if i == j else 2)) for i, j in _upper(len(columns))]
    return reduce(lambda a, b: a + b, terms)


def coefficients(fit: Fit) -> DataFrame:
    """One row per term: estimate, error, t, p, stars.

    The smallest level is the base, and its effect the intercept; every other level is
    the difference from it. Errors come from the inverse of the centred cross products.
    """
    p, variance, base = len(fit.xs), fit.variance, fit.base
    base_means = [base[f"mean_{i}"] for i in range(p)]
    base_effect = base[f"mean_{p}"] - float(np.dot(fit.slopes, base_means))
    means, own = [F.col(f"mean_{i}") for i in range(p)], F.col(fit.factor) == F.lit(base[fit.factor])
    effect = F.col(f"mean_{p}") - _dot(means, fit.slopes)
    apart = [m - F.lit(b) for m, b in zip(means, base_means)]
    spread = F.when(own, F.lit(1.0) / F.col("n") + _quadratic(means, fit.inverse)).otherwise(
        F.lit(1.0) / F.col("n") + F.lit(1.0 / base["n"]) + _quadratic(apart, fit.inverse))
    levels = fit.levels.select(
        F.when(own, "intercept").otherwise(F.concat(F.lit(f"{fit.factor}_"), F.col(fit.factor).cast("string"))).alias("term"),
        F.when(own, effect).otherwise(effect - F.lit(base_effect)).alias("estimate"),
        F.sqrt(spread * F.lit(variance)).alias("std_error"))
    slopes = fit.frame.sparkSession.createDataFrame(
        [(x, float(b), math.sqrt(v * variance)) for x, b, v in zip(fit.xs, fit.slopes, np.diag(fit.inverse))],
        "term string, estimate double, std_error double")
    tested = levels.unionByName(slopes).withColumn("t", F.col("estimate") / F.col("std_error"))
    return (tested.withColumn("p", t_tail_column(F.col("t"), F.lit(fit.df_residual)))
            .withColumn("stars", stars(F.col("p"))))


def residuals(fit: Fit) -> DataFrame:
    """The rows of the fit with ``residual``."""
    effects = level_effects(fit).select(F.col("level").alias(fit.factor), "effect")
    fitted = F.col("effect") + _dot([F.col(x) for x in fit.xs], fit.slopes)
    return join_reduced(fit.frame, effects, [fit.factor], "left").withColumn("residual", F.col(fit.y) - fitted).drop("effect")


def ols_summary(fit: Fit) -> DataFrame:
    """One row: sizes, R2, adjusted R2, F and its p, residual error and quartiles."""
    n, k, df_residual = fit.n, fit.predictors, fit.df_residual
    r2 = 1.0 - fit.sse / fit.sst
    f_value = (r2 / k) / ((1.0 - r2) / df_residual)
    written = materialise(residuals(fit).select("residual"), "residuals")
    q = exact_quantiles(written, "residual", (0.0, 0.25, 0.5, 0.75, 1.0))
    return fit.frame.sparkSession.createDataFrame(
        [(n, k, df_residual, r2, 1.0 - fit.variance / (fit.sst / (n - 1)), f_value, f_tail(f_value, k, df_residual),
          math.sqrt(fit.variance), *q)],
        "n bigint, k int, df_residual int, r2 double, adj_r2 double, f_value double, f_p double, "
        "residual_error double, res_min double, res_q1 double, res_median double, "
        "res_q3 double, res_max double",
    )


# --- cross-validation from one aggregate ------------------------------------------

def _training_cells(df: DataFrame, y: str, xs: Sequence[str], factor: str, key: Column, k: int) -> DataFrame:
    """One row per fold and level: moments of the level outside the fold (``n``, ``mean_i``, ``c_i_j``), and its
    own in the fold (``test``, missing if it has no rows there).

    A level has at most one cell per fold, so bringing its cells together is bounded by k.
    """
    size = len(xs) + 1
    kept = complete_rows(df, y, xs, factor).withColumn("_fold", hash_fold(key, k))
    cell = F.struct("_fold", "n", F.array(*[F.col(f"mean_{i}") for i in range(size)]).alias("mean"),
                    F.array(*[F.col(f"c_{i}_{j}") for i, j in _upper(size)]).alias("cross"))
    levels = (cross_moments(kept, y, xs, ["_fold", factor]).select(F.col(factor).alias("level"), cell.alias("cell"))
              .groupBy("level").agg(F.collect_list("cell").alias("cells")))
    rows = levels.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    total = lambda value: F.aggregate("others", F.lit(0.0), lambda s, c: s + value(c))
    weight = lambda c: c["n"].cast("double")
    rows = rows.select(
        "level", "fold", F.get(F.filter("cells", lambda c: c["_fold"] == F.col("fold")), F.lit(0)).alias("test"),
        F.filter("cells", lambda c: c["_fold"] != F.col("fold")).alias("others"))
    rows = rows.withColumn("n", total(weight))
    mean = lambda i: total(lambda c: weight(c) * c["mean"][i]) / F.col("n")
    rows = rows.withColumns({f"mean_{i}": F.when(F.col("n") > 0, mean(i)) for i in range(size)})

    def cross(at: int, i: int, j: int) -> Column:
        return total(lambda c: c["cross"][at] + weight(c) * (c["mean"][i] - F.col(f"mean_{i}")) * (c["mean"][j] - F.col(f"mean_{j}")))

    return rows.withColumns({f"c_{i}_{j}": F.when(F.col("n") > 0, cross(at, i, j))
                             for at, (i, j) in enumerate(_upper(size))}).drop("others")


@dataclass
class CrossValidation:
    """k fits: the figures of each fold on the driver, the level effects as a table."""
    xs: list[str]
    rows: list[dict]
    cells: DataFrame
    levels: list

    def folds(self) -> DataFrame:
        """One row per fold: rows tested, mean squared error, adjusted R2, slopes."""
        schema = "fold int, n_test bigint, test_mse double, adj_r2 double, " + ", ".join(f"`{x}` double" for x in self.xs)
        return self.cells.sparkSession.createDataFrame(
            [(r["fold"], r["n_test"], r["test_mse"], r["adj_r2"], *map(float, r["slopes"])) for r in self.rows], schema)

    def effects(self) -> DataFrame:
        """``(fold, level, effect)`` of the levels each training set has."""
        weights = F.create_map(*[c for r in self.rows for c in (F.lit(r["fold"]), F.array(*[F.lit(float(b)) for b in r["slopes"]]))])
        slopes, p = F.element_at(weights, F.col("fold")), len(self.xs)
        fitted = reduce(lambda a, b: a + b, [F.col(f"mean_{i}") * slopes[i] for i in range(p)])
        return (self.cells.filter((F.col("n") > 0) & F.col("fold").isin([r["fold"] for r in self.rows]))
                .select("fold", "level", (F.col(f"mean_{p}") - fitted).alias("effect")))


def kfold_fits(df: DataFrame, y: str, xs: Sequence[str], factor: str, key: Column, k: int = 10,
               name_levels: bool = False) -> CrossValidation:
    """k-fold cross-validation of ``ols`` for a factor with any number of levels.

    One query over the rows gives k rows of sums: the cross products of each training
    set within levels, and those of its test rows around the training means of their
    levels, from which its test error follows. ``name_levels`` fetches the levels' names
    as well, for callers that want them as columns.
    """
    size = len(xs) + 1
    cells = _training_cells(df, y, xs, factor, key, k)
    apart = lambda i: F.col("test")["mean"][i] - F.col(f"mean_{i}")
    test_n, mean_y = F.coalesce(F.col("test")["n"], F.lit(0)), F.col(f"mean_{size - 1}")
    sums = cells.groupBy("fold").agg(
        F.sum(test_n).alias("n_test"), F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("levels"),
        F.count_if((test_n > 0) & (F.col("n") == 0)).alias("unseen"),
        F.sum(F.col("n") * mean_y).alias("sum_y"), F.sum(F.col("n") * mean_y * mean_y).alias("square_y"),
        *[F.sum(f"c_{i}_{j}").alias(f"w_{i}_{j}") for i, j in _upper(size)],
        *[F.sum(F.col("test")["cross"][at] + test_n * apart(i) * apart(j)).alias(f"e_{i}_{j}") for at, (i, j) in enumerate(_upper(size))],
        *([F.sort_array(F.collect_set("level")).alias("names")] if name_levels else []))
    rows, names = [], []
    for row in sorted(sums.collect(), key=lambda r: r["fold"]):
        names = row["names"] if name_levels else []
        if not row["n_test"] or not row["n"]:
            continue
        w = _matrix(row, size, "w")
        slopes = _inverse(w[:-1, :-1]) @ w[:-1, -1]
        sse, sst = w[-1, -1] - slopes @ w[:-1, -1], w[-1, -1] + row["square_y"] - row["sum_y"] ** 2 / row["n"]
        n, terms = row["n"], row["levels"] - 1 + len(slopes)
        weights = np.append(-slopes, 1.0)
        # A level that only the test fold has cannot be predicted.
        error = math.nan if row["unseen"] else float(weights @ _matrix(row, size, "e") @ weights) / row["n_test"]
        rows.append({"fold": row["fold"], "n_test": int(row["n_test"]), "test_mse": error,
                     "adj_r2": float(1.0 - (sse / (n - terms - 1)) / (sst / (n - 1))), "slopes": slopes})
    return CrossValidation(list(xs), rows, cells, names)


def kfold_cv(df: DataFrame, y: str, xs: Sequence[str], factor: str, key: Column, k: int = 10) -> DataFrame:
    """``kfold_fits`` in one row per fold, with a column per level; for factors whose levels a row can hold.

    The smallest level is the base: its effect is the intercept, the others are differences from it.
    """
    found = kfold_fits(df, y, xs, factor, key, k, name_levels=True)
    if not found.rows:
        raise ValueError("no complete rows to validate")
    order, at = found.levels, {v: f"_level_{i}" for i, v in enumerate(found.levels)}
    effect = lambda v: F.max(F.when(F.col("level") == F.lit(v), F.col("effect"))).alias(at[v])
    wide = found.effects().groupBy("fold").agg(*[effect(v) for v in order])
    known = lambda c: F.coalesce(c, F.lit(math.nan))
    base = F.col(at[order[0]])
    return found.folds().join(wide, "fold").select(
        "fold", "n_test", "test_mse", "adj_r2", known(base).alias("intercept"),
        *[known(F.col(at[v]) - base).alias(f"{factor}_{v}") for v in order[1:]], *[F.col(f"`{x}`") for x in xs])


def cv_means(folds: DataFrame) -> DataFrame:
    """All folds in one row, numbered -1: rows tested, and the mean of every metric."""
    return folds.agg(
        F.lit(-1).alias("fold"),
        F.sum("n_test").alias("n_test"),
        *[F.avg(c).alias(c) for c in folds.columns if c not in ("fold", "n_test")],
    )


# --- relations and clusters ---------------------------------------------------------

def pairwise_corr(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the correlation of every pair of columns."""
    return df.agg(*[
        F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}_{b}")
        for a, b in combinations(columns, 2)
    ])


@dataclass
class Clusters:
    """Rows with their group and the columns that place them (whole numbers of a fine grid), and the centres on it."""
    placed: DataFrame
    name: str
    centres: list[tuple[int, ...]]

    @property
    def rows(self) -> DataFrame:
        return self.placed.drop(*self.places)

    @property
    def places(self) -> list[str]:
        return [c for c in self.placed.columns if c.startswith("_z")]

    def facts(self) -> DataFrame:
        """One row: rows, those without a group, groups in use, rows not in the group of their nearest centre, groups
        whose centre is not the mean of their rows."""
        own = F.element_at(F.array(*[_apart(self.places, c) for c in self.centres], F.lit(None).cast("double")), F.col(self.name))
        least = F.least(*[_apart(self.places, c) for c in self.centres], F.lit(math.inf), F.lit(math.inf))
        groups = self.placed.groupBy(self.name).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(own > least).alias("away"), *[F.avg(z).alias(z) for z in self.places])
        off, labelled = F.lit(False), F.col(self.name).isNotNull()
        for i, z in enumerate(self.places):
            off |= F.abs(F.col(z) - F.element_at(F.array(*[F.lit(float(c[i])) for c in self.centres], F.lit(None).cast("double")), F.col(self.name))) > 1
        total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
        return groups.agg(
            total("n").alias("rows"), total(F.when(~labelled, F.col("n"))).alias("unlabelled"), F.count(self.name).alias("groups"),
            total(F.when(labelled, F.col("away"))).alias("misplaced"), F.count_if(labelled & off).alias("moved"))


GRID = 10 ** 9


def _apart(places: Sequence[str], centre: Sequence[int]) -> Column:
    """Squared distance in standard deviations."""
    return reduce(lambda a, b: a + b, [((F.col(z) - F.lit(c)) / F.lit(float(GRID))) ** 2 for z, c in zip(places, centre)])


def _nearest(places: Sequence[str], centres: Sequence[Sequence[int]]) -> Column:
    """Number of the nearest centre from 1, the lowest of equals."""
    return F.least(*[F.struct(_apart(places, c).alias("d"), F.lit(i + 1).alias("i")) for i, c in enumerate(centres)],
                   F.struct(F.lit(math.inf).alias("d"), F.lit(0).alias("i")))["i"]


def fit_clusters(df: DataFrame, columns: Sequence[str], k: int = 5, name: str = "cluster", rounds: int = 100) -> Clusters:
    """Groups 1..k on standardised columns; rows with a missing value stay, with no group.

    The first centre is the row farthest from the mean, every further one the row
    farthest from the centres so far, ties going to the smallest row. Then Lloyd rounds
    move the centres until none moves, at most ``rounds`` times. Each step is one aggregate over the
    written rows. Standardised values are whole numbers of a grid of 1e-9, whose sums
    do not depend on the order of rows, so neither does the result. With fewer than k
    different rows there are as many groups.
    """
    frame = materialise(df, "cluster-frame")
    value = {c: F.col(c).cast("double") for c in columns}
    whole = reduce(lambda a, b: a & b, [v.isNotNull() & ~F.isnan(v) for v in value.values()])
    stats = frame.filter(whole).agg(*[f(v).alias(f"{n}{i}") for i, v in enumerate(value.values())
                                      for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    places = [f"_z{i}" for i in range(len(columns))]
    scaled = {z: F.round((v - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0) * F.lit(float(GRID))).cast("bigint")
              for i, (z, v) in enumerate(zip(places, value.values()))} if stats["m0"] is not None else {z: F.lit(None).cast("bigint") for z in places}
    rows = materialise(frame.filter(whole).withColumns(scaled), "cluster-rows")
    unlabelled = frame.filter(~whole).withColumns({z: F.lit(None).cast("bigint") for z in places}).withColumn(name, F.lit(None).cast("int"))
    centres, row = [], F.struct(*df.columns)
    while len(centres) < k:
        gap = F.least(*[_apart(places, c) for c in centres], F.lit(math.inf)) if centres else _apart(places, [0] * len(places))
        first = rows.agg(F.min(F.struct((-gap).alias("gap"), row.alias("row"), *places)).alias("far")).first()["far"]
        if first is None or (centres and first["gap"] == 0):
            break
        centres.append(tuple(first[z] for z in places))
    if not centres:
        return Clusters(unlabelled, name, [])
    for _ in range(rounds):
        sums = rows.groupBy(_nearest(places, centres).alias("i")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(F.col(z).cast("decimal(38,0)")).alias(z) for z in places]).collect()
        moved = list(centres)
        for r in sums:
            moved[r["i"] - 1] = tuple((2 * int(r[z]) + r["n"]) // (2 * r["n"]) for z in places)
        if moved == centres:
            break
        centres = moved
    return Clusters(rows.withColumn(name, _nearest(places, centres)).unionByName(unlabelled), name, centres)


def cluster(df: DataFrame, columns: Sequence[str], k: int = 5, name: str = "cluster") -> DataFrame:
    """The rows of ``fit_clusters`` with their group."""
    return fit_clusters(df, columns, k, name).rows
