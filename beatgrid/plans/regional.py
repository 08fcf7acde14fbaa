"""Clean records to regional facts and feature tables."""

from collections.abc import Mapping

from pyspark.sql import DataFrame

from beatgrid.operators.counts import with_year
from beatgrid.operators.rollup import (
    LEVELS,
    MATCH_ON,
    PARENTS,
    PERIODS,
    attach_parents,
    cell_counts,
    long_facts,
    spread,
    wide,
)
from beatgrid.vocabulary import CRIME_TYPES, OUTCOMES

DIMS = ("crime_type", "outcome")


def regional_facts(records: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Small area by month facts with year and parents: the base of all roll-ups.

    Write this table once; every level below is a sum over it.
    """
    facts = long_facts(records, [*MATCH_ON, "month"], DIMS)
    return with_year(attach_parents(facts, crosswalk))


def feature_table(facts: DataFrame, level: str, period: str,
                  crime_vocabulary: Mapping[str, str] = CRIME_TYPES,
                  outcome_vocabulary: Mapping[str, str] = OUTCOMES) -> DataFrame:
    """Wide counts of one area level and period."""
    area = next(lv for lv in LEVELS if lv.name == level)
    return wide(facts, [*area.keys, *PERIODS[period]], crime_vocabulary, outcome_vocabulary, count="n")


def small_month_features(records: DataFrame, crosswalk: DataFrame,
                         crime_vocabulary: Mapping[str, str] = CRIME_TYPES,
                         outcome_vocabulary: Mapping[str, str] = OUTCOMES) -> DataFrame:
    """Wide counts of small areas by month straight from records, with parents."""
    own = [*MATCH_ON, "month"]
    cells = attach_parents(
        cell_counts(records, own, crime_vocabulary, outcome_vocabulary), crosswalk)
    return spread(cells, [*own, *PARENTS], crime_vocabulary, outcome_vocabulary, together=own)
