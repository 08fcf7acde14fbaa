"""Typed tables between stages, and the shared folder they live in."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Without one, a session on one machine gets a temporary folder; on a cluster it
    is an error, as executors would not share that folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/beatgrid/{label}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Write a stage as Parquet.

    With a partition column the rows are rebalanced on it first: a folder gets
    few files, and a folder holding most of the rows is split over many tasks.
    """
    if partition_col is None:
        df.write.mode("overwrite").parquet(path)
    else:
        (df.hint("rebalance", partition_col)
           .write.mode("overwrite").partitionBy(partition_col).parquet(path))


@contextmanager
def shuffles_end_with_their_job(spark: SparkSession):
    """For writes inside, shuffle files are removed when the write has ended.

    Otherwise they stay until the driver collects its garbage, so that writes one
    after the other hold the shuffles of all of them on disk.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def read_stage(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a stage with the schema it was written with (no folder-name guessing)."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and continue from the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    write_stage(df, path)
    return read_stage(spark, path, df.schema)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column.

    Rebalancing merges a small result into one file and leaves a large one in
    several; nothing is forced through a single task. A quote inside a value is
    doubled, as the table readers expect.
    """
    df.hint("rebalance").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
