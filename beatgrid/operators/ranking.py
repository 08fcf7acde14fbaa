"""Global positions and exact quantiles without a single-task sort.

Positions come from a range partitioning that is written once: a range's start is the
number of rows in the ranges before it, and a window numbers the rows inside a range.
Quantiles come from histogram passes that narrow an interval around each order statistic
that is asked for, until what is left in it is small enough to be fetched.
"""

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatgrid.sources.staging import materialise

FETCH_VALUES, BINS = 10_000, 4096


def global_index(df: DataFrame, column: str, name: str = "index", rows_per_range: int | None = None) -> DataFrame:
    """Zero-based position of each row by a column with distinct values, missing values first.

    The number of ranges is the session's number of shuffle partitions, or follows from
    ``rows_per_range``, which costs a count. Beside that count the input is read twice:
    for the sample that cuts the ranges, and to write them.
    """
    ranges = (int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if rows_per_range is None
              else max(1, math.ceil(df.count() / rows_per_range)))
    cut = materialise(df.repartitionByRange(ranges, column).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = {r["_range"]: r["n"] for r in cut.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for at in sorted(sizes):
        starts.append((at, total))
        total += sizes[at]
    start = df.sparkSession.createDataFrame(starts, "_range int, _start bigint")
    inside = F.row_number().over(W.partitionBy("_range").orderBy(column))
    return (cut.withColumn("_inside", inside).join(start, "_range")
            .withColumn(name, F.col("_start") + F.col("_inside") - 1).drop("_range", "_inside", "_start"))


def _narrowed(values: DataFrame, spans: dict, bins: int) -> dict:
    """One pass: the bin of each span that holds its rank. Spans are ``{rank: (low, high, rows before, rows)}``."""
    v, distinct = F.col("_v"), sorted({(s[0], s[1]) for s in spans.values()})
    # Halves keep the width of a span finite.
    place = lambda low, high: F.least(F.floor((v / 2 - low / 2) / (high / 2 - low / 2) * bins), F.lit(bins - 1))
    inside = [F.when(v.between(low, high), F.struct(F.lit(i).alias("span"), place(low, high).cast("int").alias("bin")))
              for i, (low, high) in enumerate(distinct)]
    found = (values.select("_v", F.explode(F.filter(F.array(*inside), lambda x: x.isNotNull())).alias("at"))
             .groupBy("at.span", "at.bin").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")))
    counted = {}
    for row in found.collect():
        counted.setdefault(distinct[row["span"]], []).append((row["bin"], row["n"], row["low"], row["high"]))
    out = {}
    for rank, (low, high, before, _) in spans.items():
        for _, n, least, most in sorted(counted[low, high]):
            if rank < before + n:
                out[rank] = (least, most, before, n)
                break
            before += n
    return out


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float],
                    rows_per_range: int = FETCH_VALUES, bins: int = BINS) -> list[float]:
    """Quantiles with linear interpolation between order statistics; missing values and NaN do not count.

    A pass counts the values of each open span in ``bins`` equal bins, and keeps the bin
    with the wanted rank, from its least to its largest value. Least and largest value
    of a span are in different bins, so every pass splits it. Spans of one value are
    decided; the values of spans with at most ``rows_per_range`` rows are fetched.
    """
    values = df.select(F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    total, low, high = values.agg(F.count(F.lit(1)), F.min("_v"), F.max("_v")).first()
    if not total:
        return [math.nan for _ in probabilities]
    positions = [p * (total - 1) for p in probabilities]
    wanted = {int(f(h)) for h in positions for f in (math.floor, math.ceil)}
    at = {rank: low if rank == 0 else high for rank in wanted if rank in (0, total - 1)}
    spans = {rank: (low, high, 0, total) for rank in wanted - set(at)}
    while True:
        at.update({rank: s[0] for rank, s in spans.items() if s[0] == s[1]})
        spans = {rank: s for rank, s in spans.items() if s[0] != s[1]}
        if all(s[3] <= rows_per_range for s in spans.values()):
            break
        spans = _narrowed(values, spans, bins)
    if spans:
        inside = F.lit(False)
        for span_low, span_high in {(s[0], s[1]) for s in spans.values()}:
            inside |= F.col("_v").between(span_low, span_high)
        fetched = sorted(r["_v"] for r in values.filter(inside).collect())
        for rank, (span_low, span_high, before, _) in spans.items():
            at[rank] = [x for x in fetched if span_low <= x <= span_high][rank - before]
    return [
        at[math.floor(h)] + (h - math.floor(h)) * (at[math.ceil(h)] - at[math.floor(h)])
        for h in positions
    ]
