"""Gapless positions of rows inside groups, with no group gathered in one task.

A group is cut into buckets by a spread value of its rows, so that a bucket holds
a few thousand rows. Bucket sizes are counted, their running sums are the starts
of the buckets, and a window numbers the rows of one bucket. A group with a third
of all rows has as many buckets as its rows need.

How many buckets its group has reaches a row by a broadcast of the groups where
their counted bytes stay under ``BROADCAST_BYTES``; for more groups by a join that
also deals by a part of the spread value, so that no group meets in one task.

Rows of one spread value cannot be parted that way. Buckets that hold very many are
cut a second time: their rows, numbered for ties, are written and dealt by ranges of
the order itself, and the counts of those ranges are the starts inside the bucket.
"""

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatgrid.sources.staging import materialise

BUCKET_ROWS, HOT_ROWS, RANGE_ROWS = 5000, 50_000, 10_000
SPREAD, PARTS = 1 << 32, 1024
BROADCAST_BYTES, GROUP_BYTES = 8 << 20, 64


def with_positions(rows: DataFrame, light: DataFrame, group: Sequence[str], spread: str,
                   order: Sequence[Column | str], name: str, bucket_rows: int = BUCKET_ROWS,
                   group_start: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``name``: the zero-based position in the row's group.

    ``light`` has the same rows with the group and spread columns only; it is read
    for the counts, so that wide rows are read and moved once. ``spread`` is a long
    from 0 up to ``SPREAD``; rows are ordered by their bucket of it, then by
    ``order``. Group columns hold no nulls. ``group_start`` may add a first position
    per group, in a column ``__start``; its further columns are added to the rows.
    Rows that tie in ``order`` get neighbouring positions in no particular order.
    Buckets of over ``hot_rows`` rows are cut into ranges of about that many. No rows
    give no rows.
    """
    keys, n = list(group), F.count(F.lit(1))
    groups = light.groupBy(*keys).agg(n.alias("__n")).withColumn("__buckets", F.ceil(F.col("__n") / bucket_rows))
    if group_start is None:
        groups = groups.withColumn("__start", F.lit(0).cast("long"))
    else:
        groups = groups.join(group_start, keys)
    groups = materialise(groups.drop("__n"), "groups")
    carried = [c for c in groups.columns if c not in (*keys, "__buckets")]
    bucketed = _bucket_finder(light, groups.select(*keys, "__buckets"), keys, spread)
    before = W.partitionBy(*keys).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (bucketed(light).groupBy(*keys, "__bucket").agg(n.alias("__n"))
              .withColumn("__earlier", F.coalesce(F.sum("__n").over(before), F.lit(0)))
              .join(groups.select(*keys, *carried), keys)
              .withColumn("__offset", F.col("__start") + F.col("__earlier")).drop("__start", "__earlier"))
    starts = materialise(starts, "starts")
    located = bucketed(rows)
    hot = starts.filter(F.col("__n") > hot_rows)
    in_hot = hot.agg(F.sum("__n")).first()[0]
    inside = W.partitionBy(*keys, "__bucket").orderBy(*order)
    cool = (located.join(starts.filter(F.col("__n") <= hot_rows), [*keys, "__bucket"])
            .withColumn(name, F.col("__offset") + F.row_number().over(inside) - 1)
            .drop("__bucket", "__offset", "__n"))
    if in_hot is None:
        return cool
    chosen = located.join(hot.drop("__n"), [*keys, "__bucket"])
    return cool.unionByName(_cut_by_order(chosen, keys, order, name, math.ceil(in_hot / hot_rows)))


def _bucket_finder(light: DataFrame, groups: DataFrame, keys: Sequence[str], spread: str) -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``__bucket`` to rows that hold the group and spread columns."""
    name_bytes = F.octet_length(F.concat_ws("", *[F.col(k).cast("string") for k in keys]))
    needed = groups.agg(F.coalesce(F.sum(name_bytes + GROUP_BYTES), F.lit(0))).first()[0]
    part = F.floor(F.col(spread) * PARTS / SPREAD)
    if needed <= BROADCAST_BYTES:
        by, counts = list(keys), F.broadcast(groups)
    else:
        by = [*keys, "__part"]
        counts = materialise(light.select(*keys, part.alias("__part")).distinct().join(groups, keys), "parts")
    bucket = F.floor(F.col(spread) * F.col("__buckets") / SPREAD)
    return lambda rows: (rows.withColumn("__part", part).join(counts, by)
                         .withColumn("__bucket", bucket).drop("__buckets", "__part"))


def _cut_by_order(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str, ranges: int) -> DataFrame:
    """The positions inside hot buckets; ties are numbered and written first, so that reruns of a task deal them alike."""
    tied = materialise(rows.withColumn("__tie", F.monotonically_increasing_id()), "hot")
    whole = [*keys, "__bucket"]
    dealt = materialise(tied.repartitionByRange(ranges, *whole, *order, "__tie").withColumn("__range", F.spark_partition_id()), "ranges")
    before = W.partitionBy(*whole).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = (dealt.groupBy(*whole, "__range").agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__earlier", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    inside = W.partitionBy(*whole, "__range").orderBy(*order, "__tie")
    return (dealt.join(starts, [*whole, "__range"])
            .withColumn(name, F.col("__offset") + F.col("__earlier") + F.row_number().over(inside) - 1)
            .drop("__bucket", "__offset", "__range", "__earlier", "__tie"))


def with_earlier_sums(rows: DataFrame, order: Sequence[Column | str], sums: dict[str, Column], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add, under each name of ``sums``, its sum over all rows before this one in ``order``, which has no ties.

    Rows are dealt by ranges of about ``range_rows`` and written; only the sums of the
    ranges, one row each, meet in one task.
    """
    ranges = max(1, math.ceil(rows.count() / range_rows))
    dealt = materialise(rows.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    whole = dealt.groupBy("__range").agg(*[F.sum(c).alias(f"__whole_{name}") for name, c in sums.items()])
    starts = whole.select("__range", *[F.coalesce(F.sum(f"__whole_{name}").over(before), F.lit(0)).alias(f"__start_{name}") for name in sums])
    inside = W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = dealt.join(starts, "__range")
    return summed.select(*rows.columns, *[(F.col(f"__start_{name}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(name) for name, c in sums.items()])
