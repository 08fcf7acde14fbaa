"""Cleaning and de-duplication queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.operators import clean
from beatgrid.plans import incidents as plan
from beatgrid.schemas import LOCATION_COLUMNS, RECORD_COLUMNS, STREET_ANALYSIS
from beatgrid.sources.staging import scratch_path
from workload import views as v
from workload.view_sql import with_views

KEYS = list(plan.KEYS)
SEED = "survivor"


def _street(spark: SparkSession, sf: str) -> DataFrame:
    return plan.prune_street(v.incidents(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return clean.with_completeness(_street(spark, sf), STREET_ANALYSIS[:-1], "outcome")


def street_prune(spark: SparkSession, sf: str) -> DataFrame:
    """With header lines left inside the rows, as concatenated files have them."""
    names = RECORD_COLUMNS["street"]
    header = v.table(spark, sf, "region").select(
        *[F.lit("Crime ID" if c == "crime_id" else c).alias(c) for c in names])
    return plan.prune_street(v.incidents(spark, sf).unionByName(header))


def semi_duplicated(spark: SparkSession, sf: str) -> DataFrame:
    return clean.duplicated_rows(_street(spark, sf), KEYS, "crime_id")


def keep_best_score(spark: SparkSession, sf: str) -> DataFrame:
    return clean.keep_best(_scored(spark, sf), KEYS, duplicated_only="crime_id")


QUERIES = {
    "street_prune": street_prune,
    "street_locatable": lambda s, d: clean.drop_unlocatable(_street(s, d), LOCATION_COLUMNS),
    "completeness_score": _scored,
    "having_dup_keys": lambda s, d: clean.duplicated_keys(_street(s, d), KEYS, "crime_id"),
    "score_min_max": lambda s, d: clean.score_range(_scored(s, d), KEYS, "score"),
    "semi_unique_or_blank": lambda s, d: clean.unique_or_blank(_street(s, d), KEYS, "crime_id"),
    "semi_duplicated": semi_duplicated,
    "keep_best_score": keep_best_score,
    "distinct_rows": lambda s, d: clean.distinct_rows(_street(s, d)),
    "one_per_key": lambda s, d: clean.one_per_key(_street(s, d), KEYS),
    "one_per_key_seeded": lambda s, d: clean.one_per_key(_street(s, d), KEYS, seed=SEED),
    "street_dedup": lambda s, d: plan.clean_street(v.incidents(s, d)),
    "outcome_dedup": lambda s, d: plan.clean_outcomes(v.outcome_records(s, d)),
    "dedup_audit": lambda s, d: plan.street_audit(v.incidents(s, d)),
    "dedup_audit_observed": lambda s, d: plan.clean_street_observed(v.incidents(s, d), scratch_path(s, "clean-street")),
}

_COLS = ", ".join(STREET_ANALYSIS)
_REST = "longitude, latitude, area_code, area_name, crime_type, outcome"
LOCATED = "NOT (area_code = '' AND area_name = '' AND latitude = '' AND longitude = '')"
DEDUP = {
    "own": f"SELECT DISTINCT {_COLS} FROM sized WHERE n_key = 1 OR crime_id = ''",
    "ranked": f"""SELECT *, row_number() OVER (PARTITION BY crime_id, month ORDER BY {_REST}) AS rn
                  FROM sized WHERE n_key >= 2 AND crime_id <> '' AND score = best""",
    "cleaned": f"SELECT {_COLS} FROM own UNION ALL SELECT {_COLS} FROM ranked WHERE rn = 1",
}

ORACLES = {
    "street_prune": with_views("st", "SELECT * FROM st"),
    "street_locatable": with_views("st", f"SELECT * FROM st WHERE {LOCATED}"),
    "completeness_score": with_views("scored", "SELECT * FROM scored"),
    "having_dup_keys": with_views("st", """
        SELECT crime_id, month, count(*) AS n FROM st GROUP BY crime_id, month
        HAVING count(*) >= 2 AND crime_id <> ''"""),
    "score_min_max": with_views("scored", """
        SELECT crime_id, month, min(score) AS min_score, max(score) AS max_score
        FROM scored GROUP BY crime_id, month"""),
    "semi_unique_or_blank": with_views("sized", f"SELECT {_COLS} FROM sized WHERE n_key = 1 OR crime_id = ''"),
    "semi_duplicated": with_views("sized", f"SELECT {_COLS} FROM sized WHERE n_key >= 2 AND crime_id <> ''"),
    "keep_best_score": with_views(
        "sized", f"SELECT {_COLS}, score FROM sized WHERE n_key >= 2 AND crime_id <> '' AND score = best"),
    "distinct_rows": with_views("st", "SELECT DISTINCT * FROM st"),
    "one_per_key": with_views("st", f"""
        SELECT {_COLS} FROM st
        QUALIFY row_number() OVER (PARTITION BY crime_id, month ORDER BY {_REST}) = 1"""),
    "one_per_key_seeded": with_views("st", f"""
        SELECT {_COLS} FROM st
        QUALIFY row_number() OVER (PARTITION BY crime_id, month
            ORDER BY md5(concat_ws('|', '{SEED}', {_COLS})), {_REST}) = 1"""),
    "street_dedup": with_views("sized", f"SELECT * FROM cleaned WHERE {LOCATED}", DEDUP),
    "outcome_dedup": with_views("inc", """
        SELECT crime_id, month, longitude, latitude, area_code, area_name, outcome FROM graded
        QUALIFY row_number() OVER (PARTITION BY crime_id, month
            ORDER BY score DESC, longitude, latitude, area_code, area_name, outcome) = 1""", {
        "graded": """
            SELECT DISTINCT crime_id, month, longitude, latitude, area_code, area_name, outcome,
                   CASE WHEN crime_id <> '' AND month <> '' AND longitude <> '' AND latitude <> ''
                         AND area_code <> '' AND area_name <> '' AND outcome <> '' THEN 1 ELSE 0 END AS score
            FROM inc"""}),
    "dedup_audit": with_views("sized", f"""
        SELECT (SELECT count(*) FROM st) AS "before",
               (SELECT count(*) FROM sized WHERE n_key = 1 OR crime_id = '') AS unique_or_blank,
               (SELECT count(*) FROM own) AS unique_or_blank_distinct,
               (SELECT count(*) FROM sized WHERE n_key >= 2 AND crime_id <> '') AS duplicated,
               (SELECT count(*) FROM ranked) AS duplicated_best,
               (SELECT count(*) FROM ranked WHERE rn = 1) AS survivors,
               (SELECT count(*) FROM cleaned) AS recombined,
               (SELECT count(*) FROM cleaned WHERE {LOCATED}) AS locatable""", DEDUP),
}
ORACLES["dedup_audit_observed"] = ORACLES["dedup_audit"]
