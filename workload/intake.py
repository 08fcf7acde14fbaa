"""Queries over files: they write the views as files and read them back."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.operators.counts import count_by_area, with_year
from beatgrid.operators.joins import first_rows
from beatgrid.operators.rollup import crosswalk_distinct, long_facts
from beatgrid.schemas import record_schema, text_schema
from beatgrid.sources.files import classify_files, list_files, validate_headers
from beatgrid.sources.records import (
    compact_by_bytes,
    file_order,
    kind_glob,
    read_crosswalk,
    read_records,
    read_text_table,
    read_tree,
)
from beatgrid.sources.staging import export_csv, read_export, read_stage, scratch_path, shuffles_end_with_their_job, write_stage
from beatgrid.sources.tables import (
    SKELETON_SCHEMA,
    clean_rate_table,
    normalise_names,
    read_named,
    read_table,
    read_wide_text,
)
from beatgrid.vocabulary import CROSSWALK_HEADER, HEADERS
from workload import views as v
from workload.view_sql import with_views


def _write_record_files(df: DataFrame, path: str, header: str) -> None:
    """Monthly CSV parts below ``path`` under the given header, from rows that are together by month."""
    named = df.toDF(*header.split(",")).withColumn("folder", F.col("Month"))
    named.write.partitionBy("folder").option("header", True).option("escape", '"').csv(path)


def ingest_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "ingest")
    _write_record_files(v.incidents(spark, sf, by_month=True), f"{root}/all/all-street.csv", HEADERS["street"])
    return read_records(spark, kind_glob(root, "street"), "street", recursive=True)


#: The folder that Spark's writers give to rows without a value.
NO_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _of_file(kind: str, month: Column, force: Column) -> dict[str, Column]:
    """The file of a record, by columns of the record: the folder ``_m`` and the name ``_f`` it has in a tree."""
    return {"_m": F.coalesce(month, F.lit(NO_FOLDER)), "_f": F.concat_ws("-", month, force, F.lit(kind))}


def _write_tree(root: str, kind: str, header: str, rows: DataFrame) -> None:
    """Real file names: ``<root>/<month>/<month>-<force>-<kind>.csv``, one file each, from rows that are in order of their files.

    Spark names its own parts, so each is written below a folder of the wanted name and then takes that name.
    """
    spark, work = rows.sparkSession, f"{root}-{kind}"
    named = rows.toDF(*header.split(","), "_m", "_f")
    with shuffles_end_with_their_job(spark):
        named.write.partitionBy("_m", "_f").option("header", True).option("escape", '"').csv(work)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(work).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in system.globStatus(path(f"{work}/_m=*/_f=*/part-*.csv")):
        old = part.getPath()
        name = old.getParent().getName().split("=", 1)[1]
        folder = path(f"{root}/{old.getParent().getParent().getName().split('=', 1)[1]}")
        system.mkdirs(folder)
        system.rename(old, path(folder, f"{name}.csv"))


def _record_tree(spark: SparkSession, sf: str) -> str:
    """Street, outcome, stop-and-search and unknown files of two forces."""
    root = scratch_path(spark, "tree")
    force = F.concat(F.lit("force-"), F.col("reported_by").substr(7, 9).cast("int") % 2)
    of_file = lambda kind: _of_file(kind, F.col("month"), force)
    _write_tree(root, "street", HEADERS["street"], v.incidents(spark, sf, files=of_file("street")))
    _write_tree(root, "outcomes", HEADERS["outcomes"], v.outcome_records(spark, sf, files=of_file("outcomes")))
    searches = v.searches(spark, sf, _of_file(
        "stop-and-search", F.col("date").substr(1, 7),
        F.concat(F.lit("force-"), F.regexp_extract("self_defined_ethnicity", r"\d", 0).cast("int") % 2)))
    _write_tree(root, "stop-and-search", HEADERS["stop-and-search"], searches.drop("force"))
    _write_tree(root, "notes", HEADERS["outcomes"], v.outcome_records(spark, sf, files=of_file("notes")).filter("month LIKE '1997%'"))
    return root


def mixed_tree(spark: SparkSession, sf: str) -> DataFrame:
    """What one scan of a tree of all kinds gives, by kind and month, beside the listing of its files."""
    root = _record_tree(spark, sf)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    files = (classify_files(list_files(spark, root)).groupBy("kind", F.substring(name, 1, 7).alias("month"))
             .agg(F.count(F.lit(1)).alias("n_files")))
    tree = read_tree(spark, root)
    # Each line once for its file and once for its location: sums of keys, which need neither a sort nor a copy per distinct count.
    lines = tree.select(
        "kind", F.substring(F.substring_index("path", "/", -1), 1, 7).alias("month"), "force",
        F.col("stop_and_search.self_defined_ethnicity").alias("stated"), F.col("street.location").alias("location"),
        F.coalesce("street.crime_id", "outcomes.crime_id").alias("id"), F.col("stop_and_search.object_of_search").alias("object"))
    by_file, by_location = ["kind", "month", "force", "stated"], ["kind", "month", "location"]
    counted = lines.groupingSets([by_file, by_location], *by_file, "location").agg(
        F.grouping("location").alias("_by_file"), F.count(F.lit(1)).alias("n_rows"), F.count("id").alias("n_ids"), F.count("object").alias("n_objects"))
    of_files = lambda c: F.sum(F.when(F.col("_by_file") == 1, F.col(c))).alias(c)
    summed = counted.groupBy(*by_file).agg(
        of_files("n_rows"), of_files("n_ids"), F.count(F.when(F.col("_by_file") == 0, F.col("location"))).alias("n_locations"), of_files("n_objects"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    rows = summed.groupBy("kind", "month").agg(
        total("n_rows"), F.count_distinct("force").alias("n_forces"), total("n_ids"), total("n_locations"), total("n_objects"),
        F.max("stated").alias("last_stated"))
    return files.join(rows, ["kind", "month"])


def stop_and_search_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The searches of a tree, through the reader of one kind."""
    root = scratch_path(spark, "searches")
    searches = v.searches(spark, sf, _of_file("stop-and-search", F.col("date").substr(1, 7), F.lit("force-0")))
    _write_tree(root, "stop-and-search", HEADERS["stop-and-search"], searches.drop("force"))
    return read_records(spark, kind_glob(root, "stop-and-search"), "stop-and-search")


COMPACT_BYTES = 4 << 20


def compact_files(spark: SparkSession, sf: str) -> DataFrame:
    root, out = scratch_path(spark, "compact-in"), scratch_path(spark, "compact-out")
    _write_record_files(v.outcome_records(spark, sf, by_month=True), f"{root}/all/all-outcomes.csv", HEADERS["outcomes"])
    compact_by_bytes(spark, root, "outcomes", out, COMPACT_BYTES)
    return read_stage(spark, out, record_schema("outcomes"))


def first_match_file_order(spark: SparkSession, sf: str) -> DataFrame:
    """Each name takes its first value in file order; the column that the order came from is not in the file."""
    path = scratch_path(spark, "in-order")
    rows = v.repeated_names(spark, sf)
    rows.repartitionByRange(8, "place").sortWithinPartitions("place").drop("place").write.option("header", True).csv(path)
    placed = read_text_table(spark, path, text_schema(["name", "value"]), with_place=True)
    return first_rows(placed.withColumn("_order", file_order()), ["name"], ["value"], ["_order"])


def classify_files_query(spark: SparkSession, sf: str) -> DataFrame:
    return classify_files(v.file_names(spark, sf))


def validate_headers_query(spark: SparkSession, sf: str) -> DataFrame:
    """Whether all files of a kind and month have the right header."""
    root = scratch_path(spark, "headers")
    street, outcomes = v.incidents(spark, sf, by_month=True), v.outcome_records(spark, sf, by_month=True)
    good = F.substring("month", 1, 4) != "1997"
    _write_record_files(street.filter(good), f"{root}/all/good-street.csv", HEADERS["street"])
    swapped = HEADERS["street"].replace("Longitude,Latitude", "Latitude,Longitude")
    _write_record_files(street.filter(~good), f"{root}/all/swapped-street.csv", swapped)
    _write_record_files(outcomes, f"{root}/all/good-outcomes.csv", HEADERS["outcomes"])
    _write_record_files(outcomes.filter(~good), f"{root}/all/notes.csv", HEADERS["outcomes"])
    checked = validate_headers(spark, root)
    month = F.regexp_extract("path", r"folder=([^/]+)/", 1)
    return checked.groupBy("kind", month.alias("month")).agg(F.min("ok").alias("ok"))


def stage_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stage")
    facts = long_facts(v.records(spark, sf), ["area_code", "area_name", "month"], ["crime_type", "outcome"])
    write_stage(facts, path, "month")
    return read_stage(spark, path, facts.schema)


def _csv(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.hint("rebalance").write.option("header", True).option("escape", '"').csv(path)
    return path


def crosswalk_csv(spark: SparkSession, sf: str) -> DataFrame:
    """One row per small area from a crosswalk file with one row per output area."""
    path = _csv(v.crosswalk(spark, sf).toDF(*CROSSWALK_HEADER.split(",")), "crosswalk")
    return crosswalk_distinct(read_crosswalk(spark, path))


def rate_table_csv(spark: SparkSession, sf: str) -> DataFrame:
    return clean_rate_table(read_wide_text(spark, _csv(v.rates_raw(spark, sf), "rates")))


def rate_table_names(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_names(read_wide_text(spark, _csv(v.rates_raw(spark, sf), "rate-names")))


def skeleton_csv(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _csv(v.skeleton(spark, sf), "skeleton"), SKELETON_SCHEMA)


def district_counts_csv(spark: SparkSession, sf: str) -> DataFrame:
    """By header: an index column ahead, the wanted columns in another order."""
    written = v.district_counts(spark, sf).select(
        F.col("year").alias("index"), F.col("count").alias("n"), F.col("year").alias("Year"), F.col("district").alias("LAD_name"))
    wanted = {"LAD_name": ("district", "string"), "Year": ("year", "int"), "n": ("count", "bigint")}
    return read_named(spark, _csv(written, "counts"), wanted)


def cluster_labels_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Four of six columns, by header; names hold quotes and commas."""
    written = v.clusters(spark, sf).select(
        F.col("crime").alias("id"), F.concat(F.lit('"Area", '), "district").alias("lad"), F.lit(1).alias("pop"),
        F.col("rate").alias("unemp"), F.col("crime").alias("crim"), F.col("cluster").alias("complete5.cut"))
    wanted = {"lad": ("district", "string"), "unemp": ("rate", "double"), "crim": ("crime", "double"), "complete5.cut": ("cluster", "int")}
    return read_named(spark, _csv(written, "clusters"), wanted)


def export_counts_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "export")
    counts = count_by_area(
        with_year(v.records(spark, sf)), v.crosswalk(spark, sf),
        ["mid_code", "mid_name"], ["year", "crime_type"])
    export_csv(counts, path)
    return read_export(spark, path, counts.schema)


_NULLED = ", ".join(
    f"nullif({c}, '') AS {c}" for c in
    ("crime_id", "month", "reported_by", "falls_within", "longitude", "latitude",
     "location", "area_code", "area_name"))

QUERIES = {
    "ingest_csv_roundtrip": ingest_csv_roundtrip,
    "compact_files": compact_files,
    "mixed_tree": mixed_tree,
    "stop_and_search_csv": stop_and_search_csv,
    "first_match_file_order": first_match_file_order,
    "classify_files": classify_files_query,
    "validate_headers": validate_headers_query,
    "stage_roundtrip": stage_roundtrip,
    "export_counts_csv": export_counts_csv,
    "crosswalk_csv": crosswalk_csv,
    "rate_table_csv": rate_table_csv,
    "rate_table_names": rate_table_names,
    "skeleton_csv": skeleton_csv,
    "district_counts_csv": district_counts_csv,
    "cluster_labels_csv": cluster_labels_csv,
}
_SEARCHES = """
    SELECT 'Person search' AS search_type, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS date, 'False' AS in_operation,
           CAST(NULL AS VARCHAR) AS operation, '51.5' AS latitude, '-0.1' AS longitude, o_orderstatus AS gender, '18-24' AS age_range,
           'Group "' || CAST(o_custkey % 9 AS VARCHAR) || '", stated' AS self_defined_ethnicity,
           CAST(NULL AS VARCHAR) AS officer_defined_ethnicity, 'Act 1984 (section 1)' AS legislation,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS object_of_search, CAST(NULL AS VARCHAR) AS outcome,
           CAST(NULL AS VARCHAR) AS outcome_linked_to_object, 'False' AS outer_clothing_removed
    FROM orders"""
_TREE = {
    "searched": "SELECT *, CAST(regexp_extract(self_defined_ethnicity, '[0-9]') AS INTEGER) % 2 AS force FROM (" + _SEARCHES + ")",
    "forced": "SELECT *, CAST(substr(reported_by, 7) AS INTEGER) % 2 AS force FROM inc",
    "parts": """
        SELECT 'street' AS kind, month, force, nullif(crime_id, '') AS id, location, NULL AS object, NULL AS stated FROM forced
        UNION ALL SELECT 'outcomes', month, force, nullif(crime_id, ''), NULL, NULL, NULL FROM forced
        UNION ALL SELECT 'stop-and-search', substr(date, 1, 7), force, NULL, NULL, object_of_search, self_defined_ethnicity FROM searched
        UNION ALL SELECT 'unidentified', month, force, NULL, NULL, NULL, NULL FROM forced WHERE month LIKE '1997%'""",
}

ORACLES = {
    "mixed_tree": with_views("inc", """
        SELECT kind, month, count(DISTINCT force) AS n_files, count(*) AS n_rows,
               CASE WHEN kind = 'unidentified' THEN 0 ELSE count(DISTINCT force) END AS n_forces, count(id) AS n_ids,
               count(DISTINCT location) AS n_locations, count(object) AS n_objects, max(stated) AS last_stated
        FROM parts GROUP BY kind, month""", _TREE),
    "stop_and_search_csv": _SEARCHES,
    "first_match_file_order": """
        SELECT 'Area ' || CAST(c_custkey % 97 AS VARCHAR) AS name, CAST(max(c_custkey) AS VARCHAR) AS value FROM customer GROUP BY ALL""",
    "ingest_csv_roundtrip": with_views(
        "inc", f"SELECT {_NULLED}, crime_type, nullif(outcome, '') AS outcome, nullif(context, '') AS context FROM inc"),
    "compact_files": with_views("inc", f"SELECT {_NULLED}, nullif(outcome, '') AS outcome FROM inc"),
    "classify_files": with_views("file_names", """
        SELECT path, CASE WHEN path LIKE '%street.csv' THEN 'street'
                          WHEN path LIKE '%stop-and-search.csv' THEN 'stop-and-search'
                          WHEN path LIKE '%outcomes.csv' THEN 'outcomes'
                          ELSE 'unidentified' END AS kind
        FROM file_names"""),
    "validate_headers": with_views("inc", """
        SELECT 'street' AS kind, month, month NOT LIKE '1997%' AS ok FROM (SELECT DISTINCT month FROM inc)
        UNION ALL SELECT 'outcomes', month, true FROM (SELECT DISTINCT month FROM inc)
        UNION ALL SELECT 'unidentified', month, false
        FROM (SELECT DISTINCT month FROM inc WHERE month LIKE '1997%')"""),
    "stage_roundtrip": with_views("rec", """
        SELECT area_code, area_name, month, crime_type, outcome, count(*) AS n FROM rec GROUP BY ALL"""),
    "crosswalk_csv": with_views("xw", "SELECT * FROM xw"),
    "rate_table_csv": with_views("rates", "SELECT * FROM rates"),
    "rate_table_names": with_views("rates_text", """
        SELECT district AS "local_authority:_district_/_unitary_(prior_to_April_2015)",
               CAST(year AS VARCHAR) AS "Date", rate AS "Unemployment_rate___aged_16_64",
               population AS "Denominator", '0.5' AS "Conf___Unemployment_rate___aged_16_64",
               '1' AS "Numerator___Unemployment_rate___aged_16_64"
        FROM rates_text"""),
    "skeleton_csv": with_views("skel", "SELECT * FROM skel"),
    "district_counts_csv": with_views("dcounts", "SELECT * FROM dcounts"),
    "cluster_labels_csv": with_views("clusters", """
        SELECT '"Area", ' || district AS district, rate, crime, cluster FROM clusters"""),
    "export_counts_csv": with_views("placed", """
        SELECT mid_code, mid_name, year, crime_type, count(*) AS "count" FROM placed GROUP BY ALL"""),
}
