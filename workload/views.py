"""The library's input shapes, derived from the given tables with Spark.

The given tables have unique keys and no blanks, so each view derives the
duplicates, blanks and misses its operators need. Every view grows with its
tables. ``view_sql`` holds the same definitions for DuckDB.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.vocabulary import CRIME_TYPES, OUTCOMES

YEARS = tuple(range(1995, 2002))

PRIORITY_VOCABULARY = {
    "1-URGENT": "Urgent",
    "2-HIGH": "High",
    "3-MEDIUM": "Medium",
    "4-NOT SPECIFIED": "NotSpecified",
    "5-LOW": "Low",
}
STATUS_VOCABULARY = {"F": "Final", "O": "Open", "P": "Pending"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_INCIDENT = {
    "crime_id": "CASE WHEN l_orderkey % 10 = 0 THEN '' ELSE CAST(l_orderkey AS STRING) END",
    "month": "date_format(l_shipdate, 'yyyy-MM')",
    "reported_by": "concat('Force ', l_suppkey % 40)",
    "falls_within": "concat('Force ', l_suppkey % 40)",
    "longitude": "CASE WHEN l_suppkey % 14 = 0 THEN '' ELSE CAST(l_suppkey % 180 AS STRING) END",
    "latitude": "CASE WHEN l_suppkey % 14 = 0 THEN '' ELSE CAST(l_suppkey % 90 AS STRING) END",
    "location": "concat('On or near \"Road\", ', l_partkey)",
    "area_code": "CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE CAST(l_suppkey AS STRING) END",
    "area_name": "CASE WHEN l_suppkey % 14 = 0 THEN '' ELSE concat('N', l_suppkey) END",
    "crime_type": "l_returnflag",
    "outcome": "CASE WHEN l_partkey % 3 = 0 THEN '' ELSE l_linestatus END",
    "context": "''",
}


def _as_text(rows: DataFrame, columns: Mapping[str, str], files: Mapping[str, Column] | None = None) -> DataFrame:
    """Records from the few columns they are derived from.

    ``files`` names a file by columns of the record, the last of them distinct for each file.
    The rows of a file then come together, in order of these columns, before they become
    wide text; the columns follow the record's.
    """
    text = [F.expr(e).alias(c) for c, e in columns.items()]
    if files is None:
        return rows.select(*text)
    placed = (rows.select("*", *text).withColumns(files).select(*rows.columns, *files)
              .repartition(list(files)[-1]).sortWithinPartitions(*files))
    return placed.select(*text, *files)


def incidents(spark: SparkSession, sf: str, by_month: bool = False, files: Mapping[str, Column] | None = None) -> DataFrame:
    """Street records with blanks, missing locations and duplicated keys.

    ``by_month`` brings the rows of a month together, before they become wide text; ``files`` those of a file.
    """
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    if by_month:
        items = items.withColumn("_month", F.year("l_shipdate") * 12 + F.month("l_shipdate")).hint("rebalance", "_month")
    return _as_text(items, _INCIDENT, files)


def outcome_records(spark: SparkSession, sf: str, by_month: bool = False, files: Mapping[str, Column] | None = None) -> DataFrame:
    return incidents(spark, sf, by_month, files).drop("crime_type", "context")


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Clean records by small area; a small area is a customer."""
    return table(spark, sf, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS area_code",
        "concat('Customer#', lpad(CAST(o_custkey AS STRING), 9, '0')) AS area_name",
        "date_format(o_orderdate, 'yyyy-MM') AS month",
        "o_orderpriority AS crime_type",
        "o_orderstatus AS outcome",
    )


def labelled_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records over the full vocabularies plus one label outside each."""
    crimes, outcomes = [*CRIME_TYPES, "Unlisted type"], [*OUTCOMES, "Unlisted outcome"]
    pick = lambda labels, at: F.element_at(
        F.array(*[F.lit(v) for v in labels]), (F.pmod(at, F.lit(len(labels))) + 1).cast("int"))
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("area_code"),
        F.date_format("l_shipdate", "yyyy").alias("year"),
        pick(crimes, F.col("l_partkey")).alias("crime_type"),
        pick(outcomes, F.col("l_orderkey") + F.col("l_linenumber")).alias("outcome"),
    )


def crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """Three output areas per small area; every eleventh small area has another code and name."""
    customer = table(spark, sf, "customer")
    placed = (
        customer.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return placed.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3)))).selectExpr(
        "concat(c_custkey, '-', k) AS oa_code",
        "CASE WHEN c_custkey % 11 = 0 THEN concat('U', c_custkey) ELSE CAST(c_custkey AS STRING) END AS small_code",
        "CASE WHEN c_custkey % 11 = 0 THEN concat('Unlisted ', c_name) ELSE c_name END AS small_name",
        "CAST(n_nationkey AS STRING) AS mid_code", "n_name AS mid_name",
        "CAST(r_regionkey AS STRING) AS district_code", "r_name AS district_name",
        "'' AS district_name_alt",
    )


def _customer_years(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").withColumn(
        "year", F.explode(F.sequence(F.lit(YEARS[0]), F.lit(YEARS[-1]))))


def rates_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Rate table under its long headers: text polluted by markers."""
    tenths = "(20 + (c_custkey * 31 + (year - 1995) * 17) % 120)"
    return _customer_years(spark, sf).selectExpr(
        "CASE WHEN c_custkey % 100 = 99 THEN 'Column Total' "
        "WHEN c_custkey % 19 = 0 THEN concat('Unlisted ', c_name) ELSE c_name END "
        "AS `local authority: district / unitary (prior to April 2015)`",
        "CAST(year AS STRING) AS `Date`",
        "CASE (c_custkey * 7 + year) % 13 WHEN 0 THEN '!' WHEN 1 THEN '-' WHEN 2 THEN '~' "
        f"ELSE concat({tenths} DIV 10, '.', {tenths} % 10) END AS `Unemployment rate - aged 16-64`",
        "CAST(50 + (c_custkey * 13 + year * 5) % 400 AS STRING) AS `Denominator`",
        "'0.5' AS `Conf - Unemployment rate - aged 16-64`",
        "'1' AS `Numerator - Unemployment rate - aged 16-64`",
    )


def rates_text(spark: SparkSession, sf: str) -> DataFrame:
    """The same under short names, year typed, rate and population still text."""
    raw = rates_raw(spark, sf)
    return raw.select(
        F.col("`local authority: district / unitary (prior to April 2015)`").alias("district"),
        F.col("Date").cast("int").alias("year"),
        F.col("`Unemployment rate - aged 16-64`").alias("rate"),
        F.col("Denominator").alias("population"),
    )


def district_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Records per district (a customer) and year."""
    return (
        records(spark, sf)
        .groupBy(F.col("area_name").alias("district"), F.substring("month", 1, 4).cast("int").alias("year"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def skeleton(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_years(spark, sf).selectExpr(
        "CASE WHEN c_custkey % 23 = 0 THEN concat('Unlisted ', c_name) ELSE c_name END AS district", "year")


def boundary(spark: SparkSession, sf: str) -> DataFrame:
    """Grid vertices; eight parts outline one shape named like a customer."""
    return table(spark, sf, "part").selectExpr(
        "p_partkey DIV 8 AS shape_id",
        "concat('Customer#', lpad(CAST(p_partkey DIV 8 AS STRING), 9, '0')) AS name",
        "p_partkey AS seq",
        "CAST(400000 + (p_partkey * 37) % 90000 AS DOUBLE) AS x",
        "CAST(200000 + (p_partkey * 53) % 90000 AS DOUBLE) AS y",
    )


def clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Cluster labels: 1..6, some missing, some districts under another name."""
    return table(spark, sf, "customer").selectExpr(
        "CASE WHEN c_custkey % 13 = 0 THEN concat('Unlisted ', c_name) ELSE c_name END AS district",
        "CAST(20 + (c_custkey * 31) % 120 AS DOUBLE) / 10 AS rate",
        "CAST(c_custkey % 977 AS DOUBLE) AS crime",
        "CAST(nullif(c_custkey % 7, 0) AS INT) AS cluster",
    )


def file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly file names of three kinds and of one unknown kind."""
    return table(spark, sf, "orders").selectExpr(
        "concat('in/', date_format(o_orderdate, 'yyyy-MM'), '/', date_format(o_orderdate, 'yyyy-MM'), "
        "'-force', o_custkey % 25, '-', element_at(array('street', 'outcomes', 'stop-and-search', 'notes'), "
        "CAST(o_orderkey % 4 AS INT) + 1), '.csv') AS path"
    ).distinct()


_SEARCH = {
    "search_type": "'Person search'",
    "date": "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "in_operation": "'False'", "operation": "''", "latitude": "'51.5'", "longitude": "'-0.1'",
    "gender": "o_orderstatus", "age_range": "'18-24'", "self_defined_ethnicity": "concat('Group \"', o_custkey % 9, '\", stated')",
    "officer_defined_ethnicity": "''", "legislation": "'Act 1984 (section 1)'",
    "object_of_search": "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END",
    "outcome": "''", "outcome_linked_to_object": "''", "outer_clothing_removed": "'False'",
    "force": "concat('force-', o_custkey % 2)",
}


def searches(spark: SparkSession, sf: str, files: Mapping[str, Column] | None = None) -> DataFrame:
    """Stop-and-search records, one per order; the force is among the columns of the view, not of the record."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    return _as_text(orders, _SEARCH, files)


def crosswalk_with_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """The crosswalk, in which some small areas are listed a second time, under another district."""
    rows = crosswalk(spark, sf)
    again = rows.filter("oa_code LIKE '%7-1'").withColumn("district_code", F.lit("-")).withColumn("district_name", F.lit(None).cast("string"))
    return rows.unionByName(again)


def repeated_names(spark: SparkSession, sf: str) -> DataFrame:
    """Values under names that occur many times, by a place that is not a column of the file."""
    return table(spark, sf, "customer").selectExpr(
        "concat('Area ', c_custkey % 97) AS name", "CAST(c_custkey AS STRING) AS value", "-c_custkey AS place")
