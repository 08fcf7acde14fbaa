"""Raw records to clean records."""

from pyspark.sql import DataFrame

from beatgrid.operators.clean import audit, clean_observed, dedup_by_completeness, drop_unlocatable, prune
from beatgrid.schemas import LOCATION_COLUMNS, OUTCOME_ANALYSIS, RECORD_COLUMNS, STREET_ANALYSIS
from beatgrid.vocabulary import HEADERS

KEYS = ("crime_id", "month")


def _guard(kind: str) -> dict[str, str]:
    """First column of a kind and the text of an embedded header line there."""
    return {RECORD_COLUMNS[kind][0]: HEADERS[kind].split(",")[0]}


def prune_street(df: DataFrame) -> DataFrame:
    return prune(df, STREET_ANALYSIS, _guard("street"))


def prune_outcomes(df: DataFrame) -> DataFrame:
    return prune(df, OUTCOME_ANALYSIS, _guard("outcomes"))


def dedup_street(pruned: DataFrame) -> DataFrame:
    """Rows without an identifier are made distinct; the others keep the most
    complete row per identifier and month. The outcome may be missing."""
    return dedup_by_completeness(
        pruned, KEYS, required=STREET_ANALYSIS[:-1], optional="outcome", blank_key="crime_id")


def clean_street(raw: DataFrame) -> DataFrame:
    return drop_unlocatable(dedup_street(prune_street(raw)), LOCATION_COLUMNS)


def clean_outcomes(raw: DataFrame) -> DataFrame:
    """One row per identifier and month, a blank identifier included."""
    return dedup_by_completeness(prune_outcomes(raw), KEYS, required=OUTCOME_ANALYSIS)


def street_audit(raw: DataFrame) -> DataFrame:
    return audit(prune_street(raw), KEYS, STREET_ANALYSIS[:-1], "outcome", "crime_id", LOCATION_COLUMNS)


def clean_street_observed(raw: DataFrame, path: str) -> DataFrame:
    """Write the clean street records to ``path`` and return their audit, from one scan."""
    return clean_observed(prune_street(raw), path, KEYS, STREET_ANALYSIS[:-1], "outcome", "crime_id", LOCATION_COLUMNS)
