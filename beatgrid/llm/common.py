"""Small helpers that several operators share."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """Only these columns, whatever else the table holds."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """Arrow batches in, Arrow batches out, partition by partition, without a shuffle."""
    return df.mapInArrow(work, schema)


def id_key(column: str) -> Column:
    """The id as text; an absent id is the text ``null``."""
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def is_held_out(column: str) -> Column:
    """True where crc32 of the id as text leaves remainder 0 by 5; an absent id counts as empty text, so it is held out."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def hex_number(digest: Column, start: int, digits: int) -> Column:
    """Some hex digits of a digest as a long; 12 digits at most stay exact as a double."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")
