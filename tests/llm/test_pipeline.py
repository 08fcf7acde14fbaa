"""The pipeline as a whole, and its stages' columns, on the smallest given tables."""

import __spark_entry__
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_pipeline_keeps_whole_documents(spark):
    given = {(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {(r["doc_id"], r["text"]) for r in rows} <= given
    assert list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
