"""File classification and header validation over whole folder trees."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatgrid.vocabulary import HEADERS

UNIDENTIFIED = "unidentified"


def list_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Path and length of every file below ``root``. No content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select(F.col("_metadata.file_path").alias("path"), "length")
    )


def kind_of(path: Column, kinds=tuple(HEADERS)) -> Column:
    """Record kind by the file name's suffix before ``.csv``.

    Spark writes a CSV "file" as a folder of parts, so for a part file the name
    of its folder counts, above any partition folders.
    """
    # Anchored, as a search would start anew at every character of a path that does not match.
    pattern = "(?s)^.*(" + "|".join(kinds) + r")\.csv(?:(?:/[^/=]+=[^/]*)*/part-[^/]*)?$"
    found = F.regexp_extract(path, pattern, 1)
    # A path that ends in a kind needs no pattern; of kinds that end alike the shortest counts, as in the pattern.
    ends = [(path.endswith(f"{k}.csv"), F.lit(k)) for k in sorted(kinds, key=len)]
    first, *rest = [*ends, (found == "", F.lit(UNIDENTIFIED))]
    return reduce(lambda kind, case: kind.when(*case), rest, F.when(*first)).otherwise(found)


def record_name(path: Column) -> Column:
    """The name without ``.csv`` of the first file or folder of a path that ends so; blank if none does."""
    plain, last = path.endswith(".csv") & ~path.contains(".csv/"), F.substring_index(path, "/", -1)
    return (F.when(plain, F.left(last, F.length(last) - len(".csv")))
            .otherwise(F.regexp_extract(path, r"(?:^|/)([^/]*)\.csv(?:/[^/]*)*$", 1)))


def classify_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Add ``kind``. Unidentified files are kept and labelled."""
    return files.withColumn("kind", kind_of(F.col(path)))


def first_lines(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """First line of every file, all files in one job.

    Only rows of a file's first block compete, and they are reduced to one row
    per file before the shuffle. The text of the files is read whole: Spark feeds a
    consumer that stops early (an Arrow or RDD generator) to the end of its input all
    the same.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(root)
        .select(
            "value",
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block_start"),
        )
        .filter(F.col("block_start") == 0)
        .withColumn("position", F.monotonically_increasing_id())
    )
    return lines.groupBy("path").agg(F.min_by("value", "position").alias("header"))


def validate_headers(spark: SparkSession, root: str,
                     expected: Mapping[str, str] = HEADERS, glob: str = "*.csv") -> DataFrame:
    """One row per file: path, kind, header, whether the header is the expected one.

    Unidentified files fail. Spark does not list files of zero bytes, so those
    appear neither here nor in ``list_files``.
    """
    lines = classify_files(first_lines(spark, root, glob))
    wanted = F.lit(None).cast("string")
    for kind, text in expected.items():
        wanted = F.when(F.col("kind") == kind, text).otherwise(wanted)
    ok = F.coalesce(F.col("header") == wanted, F.lit(False))
    return lines.select("path", "kind", "header", ok.alias("ok"))


def offenders(validated: DataFrame) -> DataFrame:
    return validated.filter(~F.col("ok"))


# --- packing ------------------------------------------------------------------

def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def pack_files(files: DataFrame, target_bytes: int, group: Column | None = None) -> tuple[DataFrame, int]:
    """``(path, first_bin, before)`` for listed files, and the number of bins.

    Files of a group (their folder, unless another is given) lie end to end in path order, and bins are cut every
    ``target_bytes`` of that run. A byte at offset b of a file is in bin
    ``first_bin + floor((before + b) / target_bytes)``, so a long file spans several bins and
    many short ones share one. Only one row per group reaches the driver.
    """
    group = folder_of(F.col("path")) if group is None else group
    listed = files.select("path", "length", group.alias("group"))
    bins = {r["group"]: max(1, -(-r["n"] // target_bytes)) for r in listed.groupBy("group").agg(F.sum("length").alias("n")).collect()}
    starts, total = [], 0
    for name in sorted(bins):
        starts.append((name, total))
        total += bins[name]
    run = W.partitionBy("group").orderBy("path").rowsBetween(W.unboundedPreceding, -1)
    first = files.sparkSession.createDataFrame(starts, "group string, first_bin int")
    before = F.coalesce(F.sum("length").over(run), F.lit(0)).alias("before")
    return listed.select("path", "group", before).join(first, "group").select("path", "first_bin", "before"), total
