"""Plain record counts by area, year and type."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.text import year_of
from beatgrid.operators.rollup import MATCH_ON, PARENTS, attach_parents, long_facts


def with_year(df: DataFrame, month: str = "month", name: str = "year") -> DataFrame:
    return df.withColumn(name, year_of(month))


def year_slice(df: DataFrame, years: Sequence[int], column: str = "year") -> DataFrame:
    """Rows of the given years. A text year is compared as a number."""
    return df.filter(F.col(column).try_cast("int").isin([int(y) for y in years]))


def count_by(df: DataFrame, keys: Sequence[str], where: Column | None = None,
             name: str = "count") -> DataFrame:
    rows = df if where is None else df.filter(where)
    return long_facts(rows, keys, count=name)


def count_by_area(df: DataFrame, crosswalk: DataFrame, area: Sequence[str],
                  keys: Sequence[str] = (), name: str = "count") -> DataFrame:
    """Count records by parent area and further keys.

    Records are counted per small area before the crosswalk join, so the join
    sees one row per small area and key instead of one per record.
    """
    facts = long_facts(df, list(MATCH_ON), keys, count=name)
    placed = attach_parents(facts, crosswalk, parents=[p for p in PARENTS if p in area])
    return placed.groupBy(*area, *keys).agg(F.sum(name).alias(name))


def counts_by_year(df: DataFrame, keys: Sequence[str], years: Sequence[int],
                   year: str = "year") -> DataFrame:
    """One count column per year."""
    number = F.col(year).try_cast("int")
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(number == y, 1).otherwise(0)).alias(f"count_{y}") for y in years
    ])
