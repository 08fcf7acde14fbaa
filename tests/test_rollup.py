import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from beatgrid.operators import counts, features, rollup
from beatgrid.plans import regional as plan
from beatgrid.vocabulary import CRIME_TYPES, OUTCOMES

RECORD = "area_code string, area_name string, month string, crime_type string, outcome string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    crimes, outcomes = [*CRIME_TYPES, None, "Unlisted"], [*OUTCOMES, None, "Blaby 013C"]
    areas = [("E1", "A 1"), ("E2", "A 2"), ("E3", "A 3"), ("E9", "A 9"), ("E1", "Other name"), (None, None)]
    return [(*rng.choice(areas), f"20{rng.randint(11, 12)}-0{rng.randint(1, 3)}",
             rng.choice(crimes), rng.choice(outcomes)) for _ in range(900)]


@pytest.fixture(scope="module")
def records(spark, rows):
    return spark.createDataFrame(rows, RECORD)


@pytest.fixture(scope="module")
def crosswalk(spark):
    out = []
    for code, name, mid, district in [("E1", "A 1", "1", "1"), ("E2", "A 2", "1", "1"), ("E3", "A 3", "2", "1")]:
        out += [(code, name, f"M{mid}", f"Mid {mid}", f"D{district}", f"Dist {district}")] * 3
    return spark.createDataFrame(
        out, "small_code string, small_name string, mid_code string, mid_name string, "
             "district_code string, district_name string")


def test_vocabulary_sizes():
    assert (len(CRIME_TYPES), len(OUTCOMES)) == (17, 25)
    names = rollup.wide_columns(CRIME_TYPES, OUTCOMES)
    assert len(names) == 468 == len(set(names))
    assert names[:2] == ["total_obs", "EMPTYNULLCrime"] and names[43] == "EMPTYNULLCrimeEMPTYNULLOutcome"
    assert names[-1] == "ViolentCrimeUnderInvestigation"


def test_wide_counts_every_label_and_pair(records, rows):
    out = rollup.wide(records, ["month"], CRIME_TYPES, OUTCOMES)
    assert out.columns == ["month", *rollup.wide_columns(CRIME_TYPES, OUTCOMES)]
    got = {r["month"]: r.asDict() for r in out.collect()}
    for month, wide in got.items():
        mine = [r for r in rows if r[2] == month]
        crime, outcome = Counter(r[3] or "" for r in mine), Counter(r[4] or "" for r in mine)
        pair = Counter((r[3] or "", r[4] or "") for r in mine)
        assert wide["total_obs"] == len(mine)
        for a, s in CRIME_TYPES.items():
            assert wide[s] == crime[a]
            for b, t in OUTCOMES.items():
                assert wide[s + t] == pair[a, b]
        for b, t in OUTCOMES.items():
            assert wide[t] == outcome[b]
        assert sum(wide[s] for s in CRIME_TYPES.values()) == len(mine) - crime["Unlisted"] < len(mine)


def test_wide_rows_are_never_shuffled(records):
    text = rollup.wide(records, ["month"], CRIME_TYPES, OUTCOMES)._jdf.queryExecution().executedPlan().toString()
    above = text[:text.index("Exchange")]
    assert "partial_pivotfirst" in above and text.count("Exchange") == 2


def test_totals_agree_at_all_nine_levels(records, crosswalk, rows):
    facts = plan.regional_facts(records, crosswalk)
    per_level = rollup.roll_up_all(facts).groupBy("area_level", "period_level").agg(F.sum("n").alias("n")).collect()
    assert len(per_level) == 9 and {r["n"] for r in per_level} == {len(rows)}
    for level in rollup.LEVELS:
        for period in rollup.PERIODS:
            table = plan.feature_table(facts, level.name, period, {"Drugs": "Drugs"}, {"Local resolution": "Local"})
            assert table.agg(F.sum("total_obs")).first()[0] == len(rows)


def test_missing_parents_are_kept_apart_from_left_out_columns(records, crosswalk, rows):
    facts = plan.regional_facts(records, crosswalk)
    level = rollup.roll_up_all(facts).filter("area_level = 'mid' AND period_level = 'all'").collect()
    lost = sum((r[0], r[1]) not in {("E1", "A 1"), ("E2", "A 2"), ("E3", "A 3")} for r in rows)
    assert {r["mid_code"]: r["n"] for r in level}[None] == lost
    missed = rollup.missing_parents(facts, count="n").first()
    assert missed["records_missed"] == lost and missed["records"] == len(rows)


def test_conflicting_parents_never_multiply_rows(spark, records, crosswalk, rows):
    doubled = crosswalk.unionByName(spark.createDataFrame([("E1", "A 1", "M9", "Mid 9", "D9", "Dist 9")], crosswalk.schema))
    assert rollup.attach_parents(records, doubled).count() == len(rows)


def test_coarse_roll_up_equals_direct_count(records, crosswalk):
    facts = plan.regional_facts(records, crosswalk)
    by_month = rollup.roll_up(facts, ["district_name", "month"])
    again = rollup.roll_up(counts.with_year(by_month), ["district_name", "year"])
    direct = counts.count_by_area(counts.with_year(records), crosswalk, ["district_name"], ["year"], name="n")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, direct.collect()), key=str)


def test_year_slice_compares_numbers(spark):
    df = spark.createDataFrame([("2011",), ("2012",), ("n/a",), (None,)], "year string")
    assert [r[0] for r in counts.year_slice(df, [2011]).collect()] == ["2011"]


def test_vocabulary_drift_lists_unknown_labels(records):
    drift = features.vocabulary_drift(records, "outcome", OUTCOMES).collect()
    assert [r["outcome"] for r in drift] == ["Blaby 013C"]
    report = features.vocabulary_report(records, "crime_type", CRIME_TYPES).collect()
    assert {r["crime_type"]: r["known"] for r in report}[None] is True
    assert [r["crime_type"] for r in features.labels_found(records, "crime_type").collect()][:2] == [None, ""]


def test_indicators_multiply_to_interactions(records):
    crimes, outcomes = {"Drugs": "Drugs", "": "None"}, {"Local resolution": "Local", "": "Open"}
    both = features.interactions(
        features.indicators(features.indicators(records, "crime_type", crimes), "outcome", outcomes),
        "crime_type", crimes, "outcome", outcomes)
    for a in crimes.values():
        for b in outcomes.values():
            assert both.filter(f"{a}{b} <> {a} * {b}").count() == 0


def test_partitions_of_wide_rows_are_not_merged(records):
    """Their bytes before the spread say little of what a task holds after it."""
    plan_text = rollup.wide(records, ["month"], CRIME_TYPES, OUTCOMES)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan_text
