"""Feature, roll-up and count queries."""

from pyspark.sql import DataFrame, SparkSession

from beatgrid.operators import counts as c
from beatgrid.operators import features, rollup
from beatgrid.plans import regional as plan
from beatgrid.plans.incidents import clean_street
from beatgrid.vocabulary import CRIME_TYPES, OUTCOMES
from workload import views as v
from workload.cleaning import DEDUP, LOCATED
from workload.view_sql import with_views

CRIMES, STATES = v.PRIORITY_VOCABULARY, v.STATUS_VOCABULARY
ONE_YEAR = 1997


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    return plan.regional_facts(v.records(spark, sf), v.crosswalk(spark, sf))


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    return c.with_year(v.records(spark, sf))


def _by_district(spark: SparkSession, sf: str, keys, year: int | None = None) -> DataFrame:
    rows = _dated(spark, sf)
    if year is not None:
        rows = c.year_slice(rows, [year])
    return c.count_by_area(rows, v.crosswalk(spark, sf), ["district_name"], keys)


def _wide(level: str, period: str):
    return lambda s, d: plan.feature_table(_facts(s, d), level, period, CRIMES, STATES)


def crosswalk_join(spark: SparkSession, sf: str) -> DataFrame:
    facts = rollup.long_facts(v.records(spark, sf), ["area_code", "area_name", "month"])
    xwalk = rollup.crosswalk_distinct(v.crosswalk(spark, sf))
    return rollup.attach_parents(facts, xwalk).withColumnsRenamed(
        {"mid_name": "mid_area", "district_name": "district_area"})


def year_slice_counts(spark: SparkSession, sf: str) -> DataFrame:
    return c.counts_by_year(_dated(spark, sf), ["area_name"], v.YEARS)


def clean_counts_by_area(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records to clean records to counts by small area and year."""
    return c.count_by(c.with_year(clean_street(v.incidents(spark, sf))), ["area_name", "year"])


QUERIES = {
    "clean_counts_by_area": clean_counts_by_area,
    "crosswalk_dedup": lambda s, d: rollup.crosswalk_distinct(v.crosswalk(s, d)),
    "crosswalk_join": crosswalk_join,
    "crosswalk_conflicts": lambda s, d: rollup.crosswalk_conflicts(v.crosswalk_with_conflicts(s, d)),
    "crosswalk_misses": lambda s, d: rollup.missing_parents(_facts(s, d), count="n"),
    "indicator_crime": lambda s, d: features.indicators(v.records(s, d), "crime_type", CRIMES),
    "indicator_outcome": lambda s, d: features.indicators(v.records(s, d), "outcome", STATES),
    "indicator_pairs": lambda s, d: features.interactions(
        v.records(s, d), "crime_type", CRIMES, "outcome", STATES),
    "year_from_month": lambda s, d: _dated(s, d).select("area_code", "month", "year"),
    "year_slice_counts": year_slice_counts,
    "vocab_crime": lambda s, d: features.vocabulary_report(v.labelled_records(s, d), "crime_type", CRIME_TYPES),
    "vocab_outcome": lambda s, d: features.vocabulary_report(v.labelled_records(s, d), "outcome", OUTCOMES),
    "wide_small_month": lambda s, d: plan.small_month_features(
        v.records(s, d), v.crosswalk(s, d), CRIMES, STATES),
    "wide_small_year": _wide("small", "year"),
    "wide_small_all": _wide("small", "all"),
    "wide_mid_month": _wide("mid", "month"),
    "wide_mid_year": _wide("mid", "year"),
    "wide_mid_all": _wide("mid", "all"),
    "wide_district_month": _wide("district", "month"),
    "wide_district_year": _wide("district", "year"),
    "wide_district_all": _wide("district", "all"),
    "wide_full_vocabulary": lambda s, d: rollup.wide(
        v.labelled_records(s, d), ["area_code", "year"], CRIME_TYPES, OUTCOMES),
    "rollup_nine_levels": lambda s, d: rollup.roll_up_all(_facts(s, d), plan.DIMS),
    "count_small_one_year": lambda s, d: c.count_by(c.year_slice(_dated(s, d), [ONE_YEAR]), ["area_name"]),
    "count_district_one_year": lambda s, d: _by_district(s, d, [], ONE_YEAR),
    "count_district_year": lambda s, d: _by_district(s, d, ["year"]),
    "count_district_year_type": lambda s, d: _by_district(s, d, ["year", "crime_type"]),
    "count_year": lambda s, d: c.count_by(_dated(s, d), ["year"]),
    "count_year_type": lambda s, d: c.count_by(_dated(s, d), ["year", "crime_type"]),
    "count_type": lambda s, d: c.count_by(v.records(s, d), ["crime_type"]),
}

_SMALL = "area_code, area_name, mid_code, mid_name, district_code, district_name"
_MID = "mid_code, mid_name, district_code, district_name"
_DISTRICT = "district_code, district_name"


def _is(column: str, label: str) -> str:
    text = label.replace("'", "''")
    return f"coalesce({column}, '') = '{text}'"


def _wide_sql(view: str, keys: str, crimes=CRIMES, states=STATES) -> str:
    sums = [f"count(*) FILTER (WHERE {_is('crime_type', a)}) AS {s}" for a, s in crimes.items()]
    sums += [f"count(*) FILTER (WHERE {_is('outcome', b)}) AS {s}" for b, s in states.items()]
    sums += [f"count(*) FILTER (WHERE {_is('crime_type', a)} AND {_is('outcome', b)}) AS {s}{t}"
             for a, s in crimes.items() for b, t in states.items()]
    return with_views(view, f"SELECT {keys}, count(*) AS total_obs, {', '.join(sums)} FROM {view} GROUP BY {keys}")


def _flags(column: str, labels) -> str:
    return ", ".join(
        f"CASE WHEN {_is(column, a)} THEN 1 ELSE 0 END AS {s}" for a, s in labels.items())


def _nine_sql() -> str:
    levels = {"small": _SMALL, "mid": _MID, "district": _DISTRICT}
    parts = []
    for level, keys in levels.items():
        for period in ("month", "year", "all"):
            have = [*keys.split(", "), *([period] if period != "all" else [])]
            shown = [k if k in have else f"NULL AS {k}" for k in [*_SMALL.split(", "), "month", "year"]]
            group = ", ".join([*have, "crime_type", "outcome"])
            parts.append(
                f"SELECT '{level}' AS area_level, '{period}' AS period_level, {', '.join(shown)}, "
                f"crime_type, outcome, count(*) AS n FROM placed GROUP BY {group}")
    return with_views("placed", "\nUNION ALL ".join(parts))


def _vocab_sql(column: str, labels) -> str:
    known = ", ".join("'" + a.replace("'", "''") + "'" for a in labels)
    return with_views("labelled", f"""
        SELECT {column}, count(*) AS n, {column} IN ({known}) AS known FROM labelled GROUP BY {column}""")


def _count_sql(view: str, keys: str, where: str = "true") -> str:
    group = f"GROUP BY {keys}" if keys else ""
    return with_views(view, f'SELECT {keys}, count(*) AS "count" FROM {view} WHERE {where} {group}')


ORACLES = {
    "clean_counts_by_area": with_views("sized", f"""
        SELECT area_name, substr(month, 1, 4) AS year, count(*) AS "count"
        FROM cleaned WHERE {LOCATED} GROUP BY ALL""", DEDUP),
    "crosswalk_dedup": with_views("xw", "SELECT * FROM xw"),
    "crosswalk_conflicts": with_views("xwalk2", """
        SELECT *, row_number() OVER (PARTITION BY small_code, small_name
                                     ORDER BY mid_code, mid_name, district_code, district_name NULLS FIRST) = 1 AS used
        FROM (SELECT *, count(*) OVER (PARTITION BY small_code, small_name) AS n_parents
              FROM (SELECT small_code, small_name, mid_code, mid_name, district_code, district_name, count(*) AS n_rows
                    FROM xwalk2 GROUP BY ALL))
        WHERE n_parents > 1"""),
    "crosswalk_join": with_views("placed", """
        SELECT area_code, area_name, month, count(*) AS n, mid_code, mid_name AS mid_area,
               district_code, district_name AS district_area
        FROM placed GROUP BY ALL"""),
    "crosswalk_misses": with_views("placed", """
        SELECT (SELECT count(*) FROM (SELECT DISTINCT area_code, month, crime_type, outcome
                                      FROM placed WHERE mid_code IS NULL)) AS rows_missed,
               count(*) FILTER (WHERE mid_code IS NULL) AS records_missed, count(*) AS records
        FROM placed"""),
    "indicator_crime": with_views("rec", f"SELECT * EXCLUDE (year), {_flags('crime_type', CRIMES)} FROM rec"),
    "indicator_outcome": with_views("rec", f"SELECT * EXCLUDE (year), {_flags('outcome', STATES)} FROM rec"),
    "indicator_pairs": with_views("rec", "SELECT * EXCLUDE (year), " + ", ".join(
        f"CASE WHEN {_is('crime_type', a)} AND {_is('outcome', b)} THEN 1 ELSE 0 END AS {s}{t}"
        for a, s in CRIMES.items() for b, t in STATES.items()) + " FROM rec"),
    "year_from_month": with_views("rec", "SELECT area_code, month, substr(month, 1, 4) AS year FROM rec"),
    "year_slice_counts": with_views("rec", "SELECT area_name, " + ", ".join(
        f"count(*) FILTER (WHERE year = '{y}') AS count_{y}" for y in v.YEARS
    ) + " FROM rec GROUP BY area_name"),
    "vocab_crime": _vocab_sql("crime_type", CRIME_TYPES),
    "vocab_outcome": _vocab_sql("outcome", OUTCOMES),
    "wide_small_month": _wide_sql("placed", f"{_SMALL}, month"),
    "wide_small_year": _wide_sql("placed", f"{_SMALL}, year"),
    "wide_small_all": _wide_sql("placed", _SMALL),
    "wide_mid_month": _wide_sql("placed", f"{_MID}, month"),
    "wide_mid_year": _wide_sql("placed", f"{_MID}, year"),
    "wide_mid_all": _wide_sql("placed", _MID),
    "wide_district_month": _wide_sql("placed", f"{_DISTRICT}, month"),
    "wide_district_year": _wide_sql("placed", f"{_DISTRICT}, year"),
    "wide_district_all": _wide_sql("placed", _DISTRICT),
    "wide_full_vocabulary": _wide_sql("labelled", "area_code, year", CRIME_TYPES, OUTCOMES),
    "rollup_nine_levels": _nine_sql(),
    "count_small_one_year": _count_sql("rec", "area_name", f"year = '{ONE_YEAR}'"),
    "count_district_one_year": _count_sql("placed", "district_name", f"year = '{ONE_YEAR}'"),
    "count_district_year": _count_sql("placed", "district_name, year"),
    "count_district_year_type": _count_sql("placed", "district_name, year, crime_type"),
    "count_year": _count_sql("rec", "year"),
    "count_year_type": _count_sql("rec", "year, crime_type"),
    "count_type": _count_sql("rec", "crime_type"),
}
