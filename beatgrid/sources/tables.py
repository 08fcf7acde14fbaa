"""Rate, skeleton, count and cluster-label tables."""

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatgrid.functions.text import quoted, to_double
from beatgrid.vocabulary import RATE_COLUMNS, RATE_DROP_PATTERN, RATE_MARKERS, RATE_TOTAL_ROW

SKELETON_SCHEMA = T.StructType([
    T.StructField("district", T.StringType()),
    T.StructField("year", T.IntegerType()),
])
DISTRICT_COUNT_SCHEMA = T.StructType([
    T.StructField("district", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("count", T.LongType()),
])
CLUSTER_SCHEMA = T.StructType([
    T.StructField("district", T.StringType()),
    T.StructField("rate", T.DoubleType()),
    T.StructField("crime", T.DoubleType()),
    T.StructField("cluster", T.IntegerType()),
])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema).option("header", True)
        .option("quote", '"').option("escape", '"').csv(path)
    )


def read_named(spark: SparkSession, path: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Columns by their header, as ``{header: (name, type)}``, in any order and among any others.

    An index column without a header is ignored; an absent header is an error; text that
    is not of the type becomes missing.
    """
    text = read_wide_text(spark, path)
    absent = [header for header in columns if header not in text.columns]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    return text.select(*[quoted(header).try_cast(kind).alias(name) for header, (name, kind) in columns.items()])


def read_wide_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose long headers are the column names; everything is text."""
    return (
        spark.read.option("header", True).option("inferSchema", False)
        .option("quote", '"').option("escape", '"').csv(path)
    )


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.select(*[quoted(c).alias(mapping.get(c, c)) for c in df.columns])


def normalise_names(df: DataFrame) -> DataFrame:
    """Spaces and dashes to underscores, backticks to apostrophes."""
    swap = str.maketrans({" ": "_", "-": "_", "`": "'"})
    return df.toDF(*[name.translate(swap) for name in df.columns])


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[quoted(c) for c in df.columns if not re.search(pattern, c)])


def drop_markers(df: DataFrame, column: str, markers=RATE_MARKERS) -> DataFrame:
    """Drop rows whose text is a marker. Missing values stay."""
    return df.filter(~F.coalesce(F.col(column), F.lit("")).isin(*markers))


def drop_named_row(df: DataFrame, column: str, name: str = RATE_TOTAL_ROW) -> DataFrame:
    return df.filter(~F.col(column).eqNullSafe(name))


def clean_rate_table(df: DataFrame, columns: Mapping[str, str] = RATE_COLUMNS,
                     markers=RATE_MARKERS, drop_pattern: str = RATE_DROP_PATTERN,
                     total_row: str = RATE_TOTAL_ROW) -> DataFrame:
    """Long-header text table to ``district, year, rate, population``.

    Text that is no number becomes missing; marker rows and the summary row go.
    """
    renamed = drop_matching(rename_columns(df, columns), drop_pattern)
    kept = drop_named_row(drop_markers(renamed, "rate", markers), "district", total_row)
    return kept.select(
        "district",
        F.col("year").try_cast("int").alias("year"),
        to_double("rate").alias("rate"),
        to_double("population").alias("population"),
    )
