import random

import pytest
from pyspark.sql import functions as F

from beatgrid.operators import clean
from beatgrid.plans import incidents as plan
from beatgrid.schemas import LOCATION_COLUMNS, OUTCOME_ANALYSIS, RECORD_COLUMNS, STREET_ANALYSIS

KEYS = ["crime_id", "month"]
SCHEMA = ", ".join(f"{c} string" for c in STREET_ANALYSIS)


def row(crime_id, month="2015-01", lon="1.0", lat="51.0", code="E1", name="Area 1",
        crime="Burglary", outcome="Local resolution"):
    return (crime_id, month, lon, lat, code, name, crime, outcome)


EDGE_ROWS = [
    row("a"),
    row(""), row(""),                                   # identical without identifier
    row("", crime="Drugs"), row(None, crime="Robbery"),
    row("b", outcome=""), row("b"), row("b", code=""),  # scores 1, 2, 0
    row("c", code=""), row("c", name=""),               # both 0
    row("d"), row("d", month="2015-02"),                # one per month
    row("e", crime="Robbery"), row("e", crime="Drugs"),  # tie, smallest row wins
    row("f", lon="", lat=None, code="", name=None),     # no location
    row("g", lon="", lat="", code="", name="Area 9"),   # only a name
    row("h", outcome="", crime="X"), row("h", outcome=""),
]


def blank(value):
    return value is None or value == ""


def order(values):
    return [(v is not None, v or "") for v in values]


def score(r):
    if any(blank(v) for v in r[:-1]):
        return 0
    return 1 if blank(r[-1]) else 2


def brute_dedup(rows):
    """The rule, row by row."""
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[1]), []).append(r)
    out = []
    for key, members in groups.items():
        if blank(key[0]):
            out += list(set(members))
        else:
            best = max(score(m) for m in members)
            out.append(min((m for m in members if score(m) == best), key=lambda m: order(m[2:])))
    return sorted(out, key=order)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=order)


def test_street_dedup_on_edge_rows(spark):
    df = spark.createDataFrame(EDGE_ROWS, SCHEMA)
    assert collected(plan.dedup_street(df)) == brute_dedup(EDGE_ROWS)


def test_street_dedup_on_random_rows(spark):
    rng = random.Random(5)
    pick = lambda *values: rng.choice(values)
    rows = [
        row(pick("", None, "a", "b", "c", "d"), pick("2015-01", "2015-02"), pick("1", ""), pick("2", None),
            pick("E1", ""), pick("N", ""), pick("Drugs", "Burglary"), pick("", "Local resolution"))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(plan.dedup_street(df)) == brute_dedup(rows)


def test_dedup_does_not_depend_on_row_order_or_partitions(spark):
    df = spark.createDataFrame(EDGE_ROWS, SCHEMA)
    reordered = spark.createDataFrame(EDGE_ROWS[::-1], SCHEMA).repartition(5)
    assert collected(plan.dedup_street(df)) == collected(plan.dedup_street(reordered))


def test_audit_counts_and_invariants(spark):
    got = plan.street_audit(
        spark.createDataFrame(EDGE_ROWS, SCHEMA).select(
            "*", *[F.lit(None).cast("string").alias(c) for c in RECORD_COLUMNS["street"]
                   if c not in STREET_ANALYSIS])).first().asDict()
    deduped = brute_dedup(EDGE_ROWS)
    assert got["before"] == len(EDGE_ROWS) == got["unique_or_blank"] + got["duplicated"]
    assert got["recombined"] == len(deduped) == got["unique_or_blank_distinct"] + got["survivors"]
    assert got["survivors"] == 4
    assert got["duplicated_best"] == 1 + 2 + 2 + 2
    assert got["locatable"] == sum(not all(blank(r[i]) for i in (2, 3, 4, 5)) for r in deduped)


def test_locatable_needs_one_location_field(spark):
    df = clean.drop_unlocatable(spark.createDataFrame(EDGE_ROWS, SCHEMA), LOCATION_COLUMNS)
    ids = {r["crime_id"] for r in df.collect()}
    assert "f" not in ids and "g" in ids


def test_outcome_records_without_identifier_collapse(spark):
    rows = [tuple(r[:6] + (o,)) for r, o in [
        (row(""), "Fined"), (row(""), "Other"), (row("x"), "Fined"), (row("x"), "Fined"), (row("x"), "")]]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in OUTCOME_ANALYSIS)).select(
        "*", F.lit("").alias("reported_by"))
    assert collected(plan.clean_outcomes(raw)) == [
        ("", "2015-01", "1.0", "51.0", "E1", "Area 1", "Fined"),
        ("x", "2015-01", "1.0", "51.0", "E1", "Area 1", "Fined")]


def test_prune_drops_embedded_headers_and_keeps_missing(spark):
    df = spark.createDataFrame([row("Crime ID"), row(None), row("a")], SCHEMA)
    assert [r[0] for r in plan.prune_street(df).collect()] == [None, "a"]


def test_key_operators_split_the_rows(spark):
    df = spark.createDataFrame(EDGE_ROWS, SCHEMA)
    single = collected(clean.unique_or_blank(df, KEYS, "crime_id"))
    double = collected(clean.duplicated_rows(df, KEYS, "crime_id"))
    assert sorted(single + double, key=order) == sorted(EDGE_ROWS, key=order)
    assert {r[0] for r in double} == {"b", "c", "e", "h"}


def test_keep_best_keeps_ties(spark):
    scored = clean.with_completeness(spark.createDataFrame(EDGE_ROWS, SCHEMA), STREET_ANALYSIS[:-1], "outcome")
    best = collected(clean.keep_best(scored, KEYS, duplicated_only="crime_id"))
    assert [r[0] for r in best] == ["b", "c", "c", "e", "e", "h", "h"]
    everything = clean.keep_best(scored, KEYS)
    assert everything.count() == len(EDGE_ROWS) - 2


def test_seeded_survivor_repeats_and_changes_with_the_seed(spark):
    rows = [row("k", crime=str(i)) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    pick = lambda frame, seed: clean.one_per_key(frame, KEYS, seed=seed).first()["crime_type"]
    assert pick(df, "s1") == pick(df.repartition(7), "s1")
    assert len({pick(df, f"s{i}") for i in range(8)}) > 1


def _hot(spark, n=60_000):
    """A third of all rows under one key."""
    return spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS crime_id",
        "'2015-01' AS month", "CAST(id AS STRING) AS longitude", "'1' AS latitude",
        "CASE WHEN id % 5 = 0 THEN '' ELSE 'E' END AS area_code", "'N' AS area_name",
        "'Drugs' AS crime_type", "CASE WHEN id % 2 = 0 THEN '' ELSE 'o' END AS outcome")


def _final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_reduced_before_the_shuffle(spark):
    out = plan.dedup_street(_hot(spark).repartition(6))
    assert out.count() == 40_001
    text = _final_plan(plan.dedup_street(_hot(spark)))
    assert text.count("Exchange") == 1 and "partial_min" in text and "Window" not in text


@pytest.mark.parametrize("name", ["duplicated_rows", "keep_best"])
def test_hot_key_join_is_split_at_run_time(spark, small_skew, name):
    rows = _hot(spark).repartition(6)
    if name == "duplicated_rows":
        out, expected = clean.duplicated_rows(rows, KEYS, "crime_id"), 20_000
    else:
        scored = clean.with_completeness(rows, STREET_ANALYSIS[:-1], "outcome")
        out, expected = clean.keep_best(scored, KEYS, duplicated_only="crime_id"), 8_000
    assert len(out.collect()) == expected
    assert "skew=true" in _final_plan(out)
