"""Every stage of the pipeline against a plain version of its decisions, and the whole against its stages."""

import collections
import random

import duckdb
import pytest

import corpus_pipeline
from beatgrid.llm import oracles, quality_gbt
from tests.llm.test_operators import plain_fingerprint, plain_groups

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int, row string, copy int, key string, slot int, shard string"
STAGES = dict(corpus_pipeline.STAGES)


def given():
    """Prose and junk with labels, exact and near copies, benchmark passages, nulls, an id used twice, a hot source."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in ("stone", "river", "light", "cloud", "garden", "winter") for b in ("", "s", "ed", "ing", "er")]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n)).capitalize() + "."
    items = [("b1", prose(14)), ("b2", "only four words here"), ("b3", None), (None, prose(30))]
    docs = []
    for i in range(140):
        text = prose(rng.randint(60, 200)) if i % 4 else "!!! $$$ " * rng.randint(5, 40) + "@@ 0x0 ## " * 9
        docs.append((i, text, "en", rng.choice(["hot", "hot", "hot", "b", None]), len(text)))
    for k in range(12):
        docs.append((200 + k, docs[4 * k + 1][1], "en", "b", 1))
        docs.append((230 + k, docs[4 * k + 2][1] + " Ending", "en", "hot", None))
    for k, (_, text) in enumerate(items):
        if text:
            docs.append((260 + k, prose(40) + " " + text.upper() + " " + prose(50), "en", "c", 2))
    docs += [(300, None, None, None, None), (301, "", "en", "hot", 0), (None, prose(90), "en", "hot", 3), (5, prose(120), "en", "b", 4), (302, prose(9000), "en", "hot", 5)]
    labels = [(i, 0 if i % 4 == 0 else 1) for i in range(140)]
    return [(*d, "clash", 1, "clash", 2, "clash") for d in docs], labels, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels, items = given()
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def chain(spark, folder):
    """The documents before the first stage and after each, cached."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in [("documents", None), *corpus_pipeline.STAGES]:
        docs = (docs if stage is None else stage(spark, docs, folder)).cache()
        out.append((name, docs))
    return dict(out)


def bag(df, *columns):
    return collections.Counter(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def test_quality_keeps_what_is_not_rejected(spark, chain, folder):
    before, after = chain["documents"], chain["quality"]
    scores = quality_gbt.op6_quality_scores(before.select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet")).collect()
    good = collections.Counter(r["doc_id"] for r in scores if r["predicted"])
    assert collections.Counter(r["doc_id"] for r in after.collect()) == good
    assert not bag(after) - bag(before)
    kept = set(good)
    assert len([i for i in range(140) if i % 4 and i in kept]) > 100 and len([i for i in range(140) if i % 4 == 0 and i in kept]) < 4


def test_near_duplicates_keep_the_first_of_each_group(chain):
    rows = sorted(chain["quality"].collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    label = plain_groups([plain_fingerprint(r["text"]) for r in rows])
    kept = chain["near_duplicates"]
    assert not bag(kept) - bag(chain["quality"])
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == collections.Counter(rows[i]["doc_id"] for i in sorted(set(label)))
    assert len(rows) - kept.count() >= 12


def test_decontamination_keeps_what_holds_no_window(chain):
    items = [i[1].lower().replace(".", "").split() for i in given()[2] if i[1]]
    windows = {tuple(w[k:k + 10]) for w in items for k in range(max(1, len(w) - 9))}

    def is_clean(text):
        words = (text or "").lower().replace(".", " ").split()
        return not any(tuple(words[k:k + n]) in windows for n in {len(w) for w in windows} for k in range(len(words) - n + 1))

    before, after = chain["near_duplicates"].collect(), chain["decontamination"].collect()
    assert collections.Counter(r["doc_id"] for r in after) == collections.Counter(r["doc_id"] for r in before if is_clean(r["text"]))
    assert len(before) - len(after) >= 2


def duck(df, sql, tmp_path):
    df.write.parquet(str(tmp_path / "docs"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/docs/*.parquet')")
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return [dict(zip(names, row)) for row in cursor.fetchall()]


def test_mix_takes_each_document_as_often_as_its_target_says(chain, tmp_path):
    taken = collections.Counter()
    for r in duck(chain["decontamination"], oracles.SOURCE_MIX, tmp_path):
        if r["size"]:
            taken[r["doc_id"]] += r["taken"] // r["size"]
    mixed = [r for r in chain["source_mix"].collect() if (r["text"] or "").strip()]
    assert collections.Counter(r["doc_id"] for r in mixed) == +taken
    assert not set(bag(chain["source_mix"])) - set(bag(chain["decontamination"]))


def test_shards_and_slots(chain, tmp_path):
    expected = collections.Counter((r["doc_id"], r["shard"]) for r in duck(chain["source_mix"], oracles.RENDEZVOUS_SHARDS, tmp_path))
    assert bag(chain["shards"], "doc_id", "shard") == expected
    slots = collections.defaultdict(list)
    for r in chain["shards"].collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert bag(chain["shards"], "doc_id", "text", "row", "copy", "key") == bag(chain["source_mix"], "doc_id", "text", "row", "copy", "key")


def test_run_applies_all_stages(spark, chain, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "source_mix", "shards"]
    assert all(chain[name].columns == chain["documents"].columns for name in list(STAGES)[:-1])
    result = corpus_pipeline.run(spark, folder)
    assert bag(result, "doc_id", "text", "source", "shard") == bag(chain["shards"], "doc_id", "text", "source", "shard")


def test_run_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
