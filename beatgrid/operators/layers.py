"""Classified map layers.

Class limits from data are scalar subqueries: computed once and used as
constants, without a join to the classified rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.functions import classes
from beatgrid.operators.joins import first_match
from beatgrid.vocabulary import (
    COUNT_BAND_COLOURS,
    EQUAL_WIDTH_COLOURS,
    FIXED_BAND_COLOURS,
    FIXED_RATE_MEAN,
    FIXED_RATE_SD,
    MISSING_COLOUR,
    RATE_BAND_COLOURS,
    UNCLUSTERED_COLOUR,
)


def mean_sd(df: DataFrame, column: str, pooled_by: str | None = None) -> DataFrame:
    """Mean and population deviation; with ``pooled_by`` the mean of both over groups."""
    value = F.when(~F.isnan(column), F.col(column))
    stats = [F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd")]
    if pooled_by is None:
        return df.agg(*stats)
    return df.groupBy(pooled_by).agg(*stats).agg(F.avg("mean").alias("mean"), F.avg("sd").alias("sd"))


def min_max_by(df: DataFrame, column: str, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


def _limits(stats: DataFrame) -> tuple[Column, Column]:
    both = stats.select(F.struct("mean", "sd").alias("limits")).scalar()
    return both["mean"], both["sd"]


def classify_by_mean_sd(df: DataFrame, column: str, colours: Sequence[str] = RATE_BAND_COLOURS,
                        factor: float = 1.0, pooled_by: str | None = None,
                        missing: str = MISSING_COLOUR) -> DataFrame:
    mean, sd = _limits(mean_sd(df, column, pooled_by))
    colour = classes.by_mean_sd(F.col(column).cast("double"), mean, sd, colours, factor, missing)
    return df.withColumn("color", colour)


def classify_counts_half_sd(df: DataFrame, column: str) -> DataFrame:
    return classify_by_mean_sd(df, column, COUNT_BAND_COLOURS, factor=0.5)


def classify_by_breaks(df: DataFrame, column: str, breaks: Sequence[float] | None = None,
                       colours: Sequence[str] = FIXED_BAND_COLOURS) -> DataFrame:
    """Fixed limits; by default one deviation around the published mean."""
    if breaks is None:
        breaks = (FIXED_RATE_MEAN - FIXED_RATE_SD, FIXED_RATE_MEAN, FIXED_RATE_MEAN + FIXED_RATE_SD)
    limits = [F.lit(float(b)) for b in breaks]
    return df.withColumn("color", classes.by_breaks(F.col(column).cast("double"), limits, colours))


def classify_equal_width(df: DataFrame, column: str, width: float = 2.0, offset: float = 0.9,
                         colours: Sequence[str] = EQUAL_WIDTH_COLOURS) -> DataFrame:
    return df.withColumn("color", classes.by_equal_width(F.col(column).cast("double"), colours, width, offset))


def classify_clusters(df: DataFrame, column: str = "cluster",
                      colours: Sequence[str] = COUNT_BAND_COLOURS) -> DataFrame:
    colour = classes.by_category(F.col(column), colours, MISSING_COLOUR, UNCLUSTERED_COLOUR)
    return df.withColumn("color", colour)


def named_values(shapes: DataFrame, rates: DataFrame, counts: DataFrame, on: Sequence[str],
                 rate: str = "rate", count: str = "count", order_by: Sequence[str] = ()) -> DataFrame:
    """Shapes with the first rate and the first count found under their name."""
    rated = first_match(shapes, rates, on, [rate], [c for c in order_by if c in rates.columns])
    return first_match(rated, counts, on, [count], [c for c in order_by if c in counts.columns])


def over_years(shapes: DataFrame, years: Sequence[int]) -> DataFrame:
    """One row per shape and year."""
    return shapes.withColumn("year", F.explode(F.array(*[F.lit(int(y)) for y in years])))


def map_layer(rings: DataFrame, values: DataFrame) -> DataFrame:
    """Attach colour, rate and count to the rings; rings define the rows."""
    return rings.join(values, ["shape_id", "name"], "inner")
