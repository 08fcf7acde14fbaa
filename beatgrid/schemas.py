"""Explicit schemas. Text fields stay text; numbers are cast by the operators."""

from pyspark.sql import types as T

from beatgrid.vocabulary import CROSSWALK_HEADER

# Column names of each record kind, in file order.
RECORD_COLUMNS = {
    "street": (
        "crime_id", "month", "reported_by", "falls_within", "longitude", "latitude",
        "location", "area_code", "area_name", "crime_type", "outcome", "context",
    ),
    "outcomes": (
        "crime_id", "month", "reported_by", "falls_within", "longitude", "latitude",
        "location", "area_code", "area_name", "outcome",
    ),
    "stop-and-search": (
        "search_type", "date", "in_operation", "operation", "latitude", "longitude",
        "gender", "age_range", "self_defined_ethnicity", "officer_defined_ethnicity",
        "legislation", "object_of_search", "outcome", "outcome_linked_to_object",
        "outer_clothing_removed",
    ),
}

# Columns kept for analysis.
STREET_ANALYSIS = (
    "crime_id", "month", "longitude", "latitude",
    "area_code", "area_name", "crime_type", "outcome",
)
OUTCOME_ANALYSIS = (
    "crime_id", "month", "longitude", "latitude", "area_code", "area_name", "outcome",
)
LOCATION_COLUMNS = ("area_code", "area_name", "latitude", "longitude")

CROSSWALK_COLUMNS = (
    "oa_code", "small_code", "small_name", "mid_code", "mid_name",
    "district_code", "district_name", "district_name_alt",
)
CROSSWALK_KEEP = CROSSWALK_COLUMNS[1:7]
CROSSWALK_GUARD = {"small_code": CROSSWALK_HEADER.split(",")[1]}


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def record_schema(kind: str) -> T.StructType:
    return text_schema(RECORD_COLUMNS[kind])
