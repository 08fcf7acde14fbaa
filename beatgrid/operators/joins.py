"""Joins of rates, counts and area names.

No side is force-broadcast: which tables are small is not known here, so Spark
decides by measured size, except that sides of about one size are merged. Where it
shuffles, hot keys are split at run time.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_reduced(df: DataFrame, reduced: DataFrame, on: Sequence[str], how: str, merge: bool = False) -> DataFrame:
    """Join rows to a side that was reduced to about one row per key.

    The reduced side is already partitioned by the keys. Spark would join in
    that partitioning, and then cannot split a hot key of ``df``. Comparing the
    first key NULL-safe makes it shuffle the reduced side once more, which lets
    it split. NULL keys still match nothing, since ``reduced`` has none left.
    ``merge`` keeps both sides out of a broadcast, for sides of about one size: a table
    spread over years is many times the file that Spark judges it by.
    """
    names = {c: f"_on_{i}" for i, c in enumerate(on)}
    other = reduced.filter(F.col(on[0]).isNotNull()).withColumnsRenamed(names)
    if merge:
        other = other.hint("merge")
    condition = [F.col(on[0]).eqNullSafe(F.col("_on_0"))]
    condition += [F.col(c) == F.col(names[c]) for c in on[1:]]
    return df.join(other, condition, how).drop(*names.values())


def semi_known(df: DataFrame, known: DataFrame, on: str, known_on: str | None = None) -> DataFrame:
    """Rows whose value of ``on`` is listed in ``known``."""
    names = known.select(F.col(known_on or on).alias(on)).distinct()
    return join_reduced(df, names, [on], "left_semi")


def inner_on(many: DataFrame, one: DataFrame, on: Sequence[str]) -> DataFrame:
    return join_reduced(many, one, on, "inner")


def full_outer_on(many: DataFrame, one: DataFrame, on: Sequence[str]) -> DataFrame:
    """Both sides kept: matches, and the rows of each side without a match.

    Spark cannot split a hot key of a full outer join. As a left join from the
    side whose keys may repeat, plus the rows of the other side whose key it
    lacks, a hot key of ``many`` is split at run time. ``one`` is expected to
    have about one row per key, as counts have; repeats there are still right.
    The keys of ``many`` that ``one`` has are found before they are made distinct, so no
    task holds all keys of a scan.
    """
    found = join_reduced(many.select(*on), one.select(*on), on, "left_semi", merge=True).distinct()
    unmatched = join_reduced(one, found, on, "left_anti", merge=True)
    return join_reduced(many, one, on, "left", merge=True).unionByName(unmatched, allowMissingColumns=True)


def left_from_skeleton(skeleton: DataFrame, values: DataFrame, on: Sequence[str]) -> DataFrame:
    """The skeleton defines the rows; values are attached where present."""
    return join_reduced(skeleton, values, on, "left", merge=True)


def first_rows(df: DataFrame, on: Sequence[str], columns: Sequence[str],
               order_by: Sequence[str]) -> DataFrame:
    """The first row per key in the given order (ties: smallest values)."""
    lead = [F.col(c).alias(f"_r{i}") for i, c in enumerate(order_by)]
    first = df.groupBy(*on).agg(F.min(F.struct(*lead, *columns)).alias("_row"))
    return first.select(*on, *[F.col("_row")[c].alias(c) for c in columns])


def first_match(left: DataFrame, right: DataFrame, on: Sequence[str],
                columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Left join to the first matching row; missing where there is none."""
    return join_reduced(left, first_rows(right, on, columns, order_by), on, "left")
