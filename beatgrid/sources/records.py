"""Delimited record files to typed tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatgrid.functions.text import null_if_blank
from beatgrid.operators.joins import join_reduced
from beatgrid.schemas import CROSSWALK_COLUMNS, RECORD_COLUMNS, record_schema, text_schema
from beatgrid.sources.files import kind_of, list_files, pack_files, record_name
from beatgrid.sources.staging import materialise, write_stage
from beatgrid.vocabulary import HEADERS

CORRUPT = "_corrupt_record"


def quoted_csv(reader):
    """Options of a quoted CSV with a header per file, for batch and stream readers."""
    return (
        reader.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def blanks_to_null(raw: DataFrame) -> DataFrame:
    return raw.select(*[
        null_if_blank(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in raw.schema.fields
    ])


def read_text_table(spark: SparkSession, paths, schema: T.StructType, keep_corrupt: bool = False,
                    recursive: bool = False, with_place: bool = False) -> DataFrame:
    """Quoted CSV with a header per file. Blank fields come back as NULL.

    ``with_place`` adds where a row was read: ``_path``, ``_block`` and ``_row``, which
    grows with the position inside the block.

    Commas inside quotes belong to the field. A row with the wrong number of
    fields is kept; its raw text is in ``_corrupt_record`` when asked for.
    """
    full = schema
    if keep_corrupt:
        full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    reader = quoted_csv(spark.read.schema(full)).option("recursiveFileLookup", recursive)
    read = reader.csv(paths)
    if not with_place:
        return blanks_to_null(read)
    place = (F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
             F.monotonically_increasing_id().alias("_row"))
    return blanks_to_null(read.select(*full.fieldNames(), *place))


def read_records(spark: SparkSession, paths, kind: str, keep_corrupt: bool = False,
                 recursive: bool = False, with_place: bool = False) -> DataFrame:
    """Street, outcome or stop-and-search files. ``paths`` may hold globs."""
    return read_text_table(spark, paths, record_schema(kind), keep_corrupt, recursive, with_place)


def kind_glob(root: str, kind: str) -> str:
    """All files of one kind below ``<root>/<month>/``."""
    return f"{root.rstrip('/')}/*/*-{kind}.csv"


def compact(df: DataFrame, out: str, partition_col: str = "month") -> None:
    """Gather many small files into one partitioned Parquet table."""
    write_stage(df, out, partition_col)


def compact_by_bytes(spark: SparkSession, root: str, kind: str, out: str, target_bytes: int = 128 << 20,
                     partition_col: str = "month") -> None:
    """Gather the files of a kind below ``<root>/<month>/`` into Parquet files of about ``target_bytes`` of input each.

    Bins are planned from the listing alone: running sums of file lengths in each folder.
    Every bin is written by one task, so a folder with most of the bytes takes many
    tasks and a small folder one file. A bin is exceeded by one read block at most.
    """
    files = list_files(spark, root).filter(kind_of(F.col("path")) == kind)
    bins, total = pack_files(files, target_bytes)
    # Written, as Spark judges a listing by the length of its files; few of them then need no shuffle of the rows.
    bins = materialise(bins, "bins")
    rows = read_records(spark, kind_glob(root, kind), kind, recursive=True, with_place=True)
    bin_of = (F.col("first_bin") + F.floor((F.col("before") + F.col("_block")) / target_bytes)).cast("int")
    placed = join_reduced(rows, bins.withColumnRenamed("path", "_path"), ["_path"], "left").withColumn("_bin", bin_of)
    (placed.repartitionById(max(1, total), "_bin").drop("_path", "_block", "_row", "first_bin", "before", "_bin")
     .write.mode("overwrite").partitionBy(partition_col).parquet(out))


def file_order() -> Column:
    """A row's place in its files: path, block and position, a sort key that keeps file order through joins and aggregates.

    It has to be taken where the files are read, by ``with_place`` of the readers.
    """
    return F.struct("_path", "_block", "_row")


# --- trees of mixed kinds -----------------------------------------------------

def struct_name(kind: str) -> str:
    return kind.replace("-", "_")


def read_tree(spark: SparkSession, root: str, kinds=tuple(HEADERS), glob: str = "*.csv") -> DataFrame:
    """All record files of a tree in one scan, whatever their kinds.

    One row per line: ``path``, ``kind``, ``month`` and ``force`` of the file name, the raw
    ``line``, and one struct per kind, which only rows of that kind have. Files of an
    unknown kind keep their lines and have no struct. Header lines of any kind are
    dropped; a field must not span lines.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
        .filter(~F.col("line").isin(*HEADERS.values()))
        .withColumns({"kind": kind_of(F.col("path"), kinds), "_name": record_name(F.col("path"))})
    )
    schema = lambda kind: ", ".join(f"`{c}` string" for c in RECORD_COLUMNS[kind])
    # Blank fields, quoted or not, are missing by the parser's own setting: expressions for every field of
    # every kind would outgrow what the JVM compiles of one scan.
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "nullValue": "", "emptyValue": ""}
    parsed = lines.withColumns({struct_name(k): F.when(F.col("kind") == k, F.from_csv("line", schema(k), options)) for k in kinds})
    return parsed.select(
        "path", "kind", F.nullif(F.regexp_extract("_name", r"^(\d{4}-\d{2})-", 1), F.lit("")).alias("month"),
        F.nullif(F.regexp_extract("_name", r"^\d{4}-\d{2}-(.*)-(?:" + "|".join(kinds) + ")$", 1), F.lit("")).alias("force"),
        "line", *map(struct_name, kinds))


def of_kind(tree: DataFrame, kind: str) -> DataFrame:
    """The records of one kind from ``read_tree``, as ``read_records`` gives them."""
    return tree.filter(F.col("kind") == kind).select(f"{struct_name(kind)}.*")


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path, text_schema(CROSSWALK_COLUMNS))
