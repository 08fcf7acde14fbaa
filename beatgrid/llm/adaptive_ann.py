"""Nearest neighbours by an adaptive scan of dimensions inside probed lists.

An inverted-file index: centroids are fitted on at most ``SAMPLE`` vectors (one
an id, chosen by a hash of it), and every vector is put in the list of its nearest
centroid. A query visits the lists nearest to it. There, vectors are rotated by one
random orthogonal matrix and read in blocks of columns. After each block, the partial
distance over the d columns read so far estimates the whole distance; a candidate goes
as soon as the hypothesis that it is nearer than the k-th best so far is rejected,
i.e. when the estimate exceeds that distance by the factor ``1 + EPSILON / sqrt(d)``.
Survivors are measured exactly, in double precision on the original vectors.

How many lists a query visits is measured, not assumed: ``CALIBRATION`` vectors of the
sample are compared with every vector, and the number of lists is the smallest one that
holds a share ``TARGET`` of their true neighbours. Data with clusters needs few lists,
data without any structure needs many.

Lists are cut into blocks of ``BLOCK_ROWS`` vectors, and the queries of a list into
blocks of as many, so no task holds more than one block of each, however large a list
or however many queries visit it.

Defined cases: vectors that are null, empty, all zero, hold a null or non-finite
component, or have an absent id take no part; vectors of another length than the most
frequent one take no part; a repeated id is one candidate, at its nearest row, and as a
query has its smallest vector; equal distances go by the smaller id; with fewer than k
candidates all are returned; an empty table gives no rows.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatgrid.llm.common import map_batches
from beatgrid.sources.staging import materialise

SAMPLE, MAX_LISTS, ROUNDS = 32_768, 4096, 8
K, SEED = 10, 7
CALIBRATION, TARGET = 256, 0.96
BLOCK_ROWS, COLUMNS, AT_ONCE = 8192, 16, 512
EPSILON = 2.1
HASHES = 1 << 32


def usable(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, v)`` of the vectors that take part."""
    named = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = named.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    lengths = good.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").limit(1)
    return good.join(F.broadcast(lengths.select("n")), F.size("v") == F.col("n")).drop("n")


def rows_of(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64, copy=False)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a ** 2).sum(axis=1)[:, None] - 2 * a @ b.T + (b ** 2).sum(axis=1)[None, :]


def draw(good: DataFrame, distinct: int, sample: int) -> DataFrame:
    """At most ``sample`` vectors, one an id; only about twice as many leave their partitions."""
    cut = min(HASHES, math.ceil(2 * sample / distinct * HASHES))
    near = good.filter(F.pmod(F.xxhash64("id"), F.lit(HASHES)) < cut).groupBy("id").agg(F.min("v").alias("v"))
    return near.orderBy(F.xxhash64("id"), "id").limit(sample)


def slices(batch: pa.RecordBatch):
    """A batch in pieces of a few hundred rows, which bounds the distances held at once."""
    for start in range(0, batch.num_rows, AT_ONCE):
        yield batch.slice(start, AT_ONCE)


def fit_centroids(sample: np.ndarray, lists: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's algorithm; a list left empty keeps its centroid."""
    centroids = sample[np.random.default_rng(seed).choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        nearest = squared(sample, centroids).argmin(axis=1)
        size = np.bincount(nearest, minlength=lists)
        order = np.argsort(nearest, kind="stable")
        full = np.flatnonzero(size)
        sums = np.add.reduceat(sample[order], (np.cumsum(size) - size)[full], axis=0)
        centroids = centroids.copy()
        centroids[full] = sums / size[full, None]
    return centroids


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def nearest_in_block(ids: np.ndarray, x: np.ndarray, rotated: np.ndarray, query_id: int, query: np.ndarray,
                     rotated_query: np.ndarray, k: int, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the k nearest vectors of a block that survive the tests."""
    dims = x.shape[1]
    best_id, best = np.zeros(0, np.int64), np.zeros(0)
    for start in range(0, len(ids), AT_ONCE):
        alive = np.arange(start, min(start + AT_ONCE, len(ids)))
        if best.size >= k:
            bound, partial = best[-1] ** 2, np.zeros(alive.size)
            for low in range(0, dims, COLUMNS):
                high = min(low + COLUMNS, dims)
                partial = partial + ((rotated[alive, low:high] - rotated_query[low:high]) ** 2).sum(axis=1)
                keep = partial * (dims / high) <= bound * (1 + (epsilon / math.sqrt(high) if high < dims else 1e-9)) ** 2
                alive, partial = alive[keep], partial[keep]
        alive = alive[ids[alive] != query_id]
        if alive.size:
            distance = np.sqrt(((x[alive] - query) ** 2).sum(axis=1))
            all_id, everything = np.r_[best_id, ids[alive]], np.r_[best, distance]
            order = np.lexsort((all_id, everything))
            _, first = np.unique(all_id[order], return_index=True)
            order = order[np.sort(first)][:k]
            best_id, best = all_id[order], everything[order]
    return best_id, best


def lists_needed(assigned: DataFrame, ids: np.ndarray, points: np.ndarray, centroids: np.ndarray, k: int, target: float) -> int:
    """How many of its nearest lists a query must visit to meet the target share of true neighbours."""
    shared = assigned.sparkSession.sparkContext.broadcast((ids, points))

    def compare(batches):
        kept = [np.zeros((len(ids), 0), np.float64), np.zeros((len(ids), 0), np.int32)]
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                d = squared(shared.value[1], rows_of(part.column(1)))
                d[shared.value[0][:, None] == part.column(0).to_numpy()[None, :]] = np.inf
                lists = np.broadcast_to(part.column(2).to_numpy()[None, :], d.shape)
                d, lists = np.concatenate([kept[0], d], axis=1), np.concatenate([kept[1], lists], axis=1)
                near = np.argpartition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k]
                kept = [np.take_along_axis(d, near, 1), np.take_along_axis(lists, near, 1)]
        query = np.repeat(np.arange(len(ids)), kept[0].shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(kept[0].ravel()), pa.array(kept[1].ravel())], names=["query", "d", "list"])

    rank = F.row_number().over(W.partitionBy("query").orderBy("d", "list"))
    near = (map_batches(assigned, compare, "query long, d double, list int").filter(F.col("d") < float("inf"))
            .withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "list").collect())
    order = squared(points, centroids).argsort(axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centroids))[None, :], 1)
    visited = np.sort([place[r["query"], r["list"]] for r in near])
    return int(visited[math.ceil(target * len(visited)) - 1]) + 1 if near else 1


def search(vectors: DataFrame, is_query, k: int = K, target: float = TARGET, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS,
           id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the rows whose id column ``is_query`` accepts."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    good = materialise(usable(vectors, id_column, vector), "vectors")
    total, distinct = good.agg(F.count(F.lit(1)), F.count_distinct("id")).first()
    if not total:
        return spark.createDataFrame([], schema)
    drawn = draw(good, distinct, sample).toArrow()
    points = rows_of(drawn.column("v"))
    lists = max(1, min(MAX_LISTS, round(math.sqrt(total)), len(points) // 4))
    centroids = fit_centroids(points, lists)
    turn = rotation(points.shape[1])
    shared = spark.sparkContext.broadcast((centroids, turn))

    def assign(batches):
        for part in (part for batch in batches for part in slices(batch)):
            nearest = squared(rows_of(part.column(1)), shared.value[0]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nearest.astype(np.int32))], names=["id", "v", "list"])

    assigned = materialise(map_batches(good, assign, "id long, v array<double>, list int"), "lists")
    probes = lists_needed(assigned, drawn.column("id").to_numpy()[:CALIBRATION], points[:CALIBRATION], centroids, k, target)
    sizes = np.zeros(lists, np.int64)
    for row in assigned.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[row["list"]] = row["n"]
    asked = assigned.filter(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v"))

    def visit(batches):
        for part in (part for batch in batches for part in slices(batch)):
            order = squared(rows_of(part.column(1)), shared.value[0]).argsort(axis=1, kind="stable")
            # A list may be all copies of the query's id, so candidates are counted without it only in the end.
            reached = sizes[order].cumsum(axis=1)
            wanted = np.maximum(probes, (reached < 4 * k + 1).sum(axis=1) + 1)
            chosen = [order[i, :n].astype(np.int32) for i, n in enumerate(wanted)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(chosen, pa.list_(pa.int32()))], names=["id", "v", "lists"])

    visits = materialise(map_batches(asked, visit, "id long, v array<double>, lists array<int>")
                         .select("id", "v", F.explode("lists").alias("list")), "visits")
    per_list = visits.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()
    cuts = spark.createDataFrame([(r["list"], math.ceil(int(sizes[r["list"]]) / block_rows), math.ceil(r["n"] / block_rows))
                                  for r in per_list if sizes[r["list"]]], "list int, vector_blocks int, query_blocks int")
    cuts = F.broadcast(cuts)

    def blocked(rows, own, others):
        mine = F.pmod(F.xxhash64("id"), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block")
        return (rows.join(cuts, "list").select("list", "id", "v", mine, F.explode(F.sequence(F.lit(0), F.col(f"{others}_blocks") - 1)).alias(f"{others}_block"))
                .groupBy("list", "vector_block", "query_block"))

    def scan(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found = ([], [], [])
        if candidates.num_rows and queries.num_rows:
            ids, x = candidates.column("id").to_numpy(), rows_of(candidates.column("v"))
            rotated = x @ shared.value[1]
            q = rows_of(queries.column("v"))
            for query_id, query, turned in zip(queries.column("id").to_numpy(), q, q @ shared.value[1]):
                near, distance = nearest_in_block(ids, x, rotated, query_id, query, turned, k)
                found[0].append(np.full(near.size, query_id))
                found[1].append(near)
                found[2].append(distance)
        joined = [np.concatenate(f) if f else np.zeros(0) for f in found]
        return pa.table({"query_id": pa.array(joined[0].astype(np.int64)), "vec_id": pa.array(joined[1].astype(np.int64)), "score": pa.array(joined[2])})

    pairs = (blocked(assigned, "vector", "query").cogroup(blocked(visits, "query", "vector"))
             .applyInArrow(scan, "query_id long, vec_id long, score double"))
    once = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_adaptive_neighbours(vectors: DataFrame) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return search(vectors, lambda i: i % 100 == 0)
