"""Positions where a third of the rows share one id, and quotes that are never closed."""

import random

from pyspark.sql import functions as F

from beatgrid.llm import mixing, positions, sharding, template_html

SCHEMA = "doc_id long, text string, source string"


def rows_with_hot_id(n):
    rng = random.Random(5)
    hot = [(None, rng.choice([None, "", "one", "one two", "one two three"]), "s") for _ in range(n)]
    return hot + [(i, " ".join(["word"] * rng.randint(0, 90)), rng.choice(["s", "t", None])) for i in range(2 * n)]


def all_rows(df):
    return sorted(map(repr, df.collect()))


def plain(df, order):
    """Positions by one sort."""
    by_group = {}
    for r in df.collect():
        by_group.setdefault(r["g"], []).append(tuple(r[c] for c in order))
    return {g: sorted(rows) for g, rows in by_group.items()}


def test_hot_spread_values_are_numbered_in_order(spark):
    rng = random.Random(6)
    rows = [("a", 7, rng.randint(0, 40), i % 11) for i in range(900)] + [(rng.choice("ab"), rng.randrange(1 << 32), rng.randint(0, 9), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, s long, x int, y int").repartition(6)
    for hot_rows in (60, 10**6):
        found = positions.with_positions(df, df.select("g", "s"), ["g"], "s", ["s", "x", "y"], "at", bucket_rows=50, hot_rows=hot_rows)
        assert found.columns == ["g", "s", "x", "y", "at"]
        for g, expected in plain(df, ["s", "x", "y"]).items():
            own = found.filter(F.col("g") == g).orderBy("at").collect()
            assert [r["at"] for r in own] == list(range(len(expected)))
            assert [(r["s"], r["x"], r["y"]) for r in own] == expected


def test_hot_rows_are_spread_over_tasks(spark):
    df = spark.range(6000).select(F.lit("a").alias("g"), F.lit(9).cast("long").alias("s"), F.lit(0).alias("x"))
    dealt = positions._cut_by_order(df.withColumn("__bucket", F.lit(0)).withColumn("__offset", F.lit(0)), ["g"], ["x"], "at", 6)
    sizes = [r["count"] for r in dealt.groupBy(F.floor(F.col("at") / 1000)).count().collect()]
    assert sizes == [1000] * 6
    written = spark.read.parquet(*[f.rsplit("/", 1)[0] for f in dealt.inputFiles()][:1])
    most = written.groupBy("__range").count().agg(F.max("count")).first()[0]
    assert most < 2500


def test_shards_and_mix_do_not_depend_on_the_cut(spark, monkeypatch):
    docs = spark.createDataFrame(rows_with_hot_id(400), SCHEMA)
    whole_shards, whole_mix = all_rows(sharding.op8_rendezvous_shards(docs)), all_rows(mixing.op7_source_mix(docs))
    monkeypatch.setattr(positions.with_positions, "__defaults__", (20, None, 30))
    assert all_rows(sharding.op8_rendezvous_shards(docs)) == whole_shards
    cut = mixing.op7_source_mix(docs).collect()
    assert len(cut) == len(whole_mix)
    for source_size, target in {(r["source_size"], r["target"]) for r in cut}:
        taken = sum(r["taken"] for r in cut if (r["source_size"], r["target"]) == (source_size, target))
        assert abs(taken - target) <= 0.02 * target + 100
    assert sorted(map(repr, mixing.op7_source_mix(docs).collect())) == sorted(map(repr, cut))


def test_many_groups_find_their_buckets_without_a_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame(rows_with_hot_id(400), SCHEMA)
    whole_shards, whole_mix = all_rows(sharding.op8_rendezvous_shards(docs)), all_rows(mixing.op7_source_mix(docs))
    monkeypatch.setattr(positions, "BROADCAST_BYTES", -1)
    assert all_rows(sharding.op8_rendezvous_shards(docs)) == whole_shards
    assert all_rows(mixing.op7_source_mix(docs)) == whole_mix
    light = docs.select("source", F.lit(7).cast("long").alias("s")).na.fill("", ["source"])
    joined = positions._bucket_finder(light, light.groupBy("source").agg(F.lit(3).alias("__buckets")), ["source"], "s")(light)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__part" in plan and "strategy=broadcast" not in plan
    assert joined.count() == docs.count()


def test_open_quotes_end_with_their_tag():
    for page, text in (
        ('<p>a <a href="foo>link</a> tail</p><p>b "q" c</p>', 'a link tail\nb "q" c'),
        ("<p>a <a href='foo>link</a> it's</p>", "a link it's"),
        ('<p><a href="x"class="y">l</a> said "z" w</p>', 'l said "z" w'),
        ('<p title="a > b" lang=en>x</p>', "x"),
        ('<div data-x="<p>no</p>">yes</div>', "yes"),
        ('<div title="x > y">one</div><p title="z">two</p>', "one\ntwo"),
    ):
        assert template_html.main_text(page, frozenset()) == text, page


def plain_targets(sizes, weights=(5, 2, 1), limit=3):
    """Share, cap and reshare until nothing is over its limit."""
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes))}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(limit * sizes[s] for s in capped)
        shares = sum(weigh[s] for s in sizes if s not in capped)
        over = {s for s in sizes if s not in capped and left * weigh[s] / shares >= limit * sizes[s]}
        if not over:
            return {s: limit * sizes[s] if s in capped else left * weigh[s] / shares for s in sizes}
        capped |= over


def test_targets_of_very_many_sources(spark):
    rng = random.Random(8)
    sizes = {f"0host{i:05d}": int(rng.paretovariate(0.7) * 5) for i in range(3000)}
    sizes["1"] = 0
    df = spark.createDataFrame(list(sizes.items()), "__source string, __size_of_source long")
    expected = plain_targets(sizes)
    for range_rows in (100, 10**6):
        found = {r["__source"]: r["__target"] for r in mixing.source_targets(df, range_rows=range_rows).collect()}
        assert found.keys() == expected.keys()
        assert all(abs(found[s] - expected[s]) <= 1e-6 * max(1, expected[s]) for s in sizes)
    assert mixing.source_targets(df.limit(0)).collect() == []


def test_targets_of_a_billion_words(spark):
    """What the sources share times a weight is over 2^31, while itself below."""
    sizes = {"0a": 500_000_000, "0b": 300_000_000, "0c": 200_000_000}
    df = spark.createDataFrame(list(sizes.items()), "__source string, __size_of_source long")
    found = {r["__source"]: r["__target"] for r in mixing.source_targets(df).collect()}
    assert found == plain_targets(sizes)
