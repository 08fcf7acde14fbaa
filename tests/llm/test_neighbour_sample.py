"""The sample that the lists of the neighbour search are fitted on, and recall on a given table."""

import numpy as np
from pyspark.sql import functions as F

from beatgrid.llm import adaptive_ann


def test_sample_is_bounded_and_has_each_id_once(spark):
    ids = spark.range(20_000).unionByName(spark.range(10_000).select(F.lit(7).cast("long").alias("id")))
    vectors = ids.select("id", F.array(F.col("id").cast("double"), F.rand(1)).alias("v"))
    drawn = adaptive_ann.draw(vectors, 20_000, 500).collect()
    assert len(drawn) == 500 and len({r["id"] for r in drawn}) == 500
    assert {r["id"] for r in adaptive_ann.draw(vectors, 20_000, 50_000).collect()} == set(range(20_000))
    one = vectors.filter("id = 7")
    assert [r["id"] for r in adaptive_ann.draw(one, 1, 500).collect()] == [7]


def test_recall_on_a_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = adaptive_ann.usable(table).collect()
    ids, x = np.array([r["id"] for r in rows]), np.array([r["v"] for r in rows])
    found = {}
    for r in adaptive_ann.op1_adaptive_neighbours(table).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = wanted = 0
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [int(ids[j]) for j in np.lexsort((ids, d)) if j != i][:10]
        hits, wanted = hits + len(found[ids[i]] & set(order)), wanted + len(order)
    assert hits >= 0.9 * wanted, hits / wanted
