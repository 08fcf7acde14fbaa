"""SimHash near-duplicates, linked through BK-trees.

Distinct fingerprints are dealt to shards such that two within the radius meet in at
least one: the bits are cut into radius + 1 parts, and of two fingerprints that
differ in at most that many bits one part is equal. A shard is a part and its value.
A shard that grows past ``SHARD_LIMIT`` is cut the same way over its remaining bits,
again and again; bits run out before the limit is reached, so a shard is bounded and
nothing is left out. Each shard's fingerprints form a BK-tree, whose children are
keyed by their distance to the parent, and a search follows only edges within the
radius of the query's distance. Trees are built where their shard is, as the
fingerprints of all documents may not pass through the driver.

A shard returns each fingerprint with the smallest one it reaches there, not pairs,
so a dense group costs as many rows as it has members. Components over all shards
come from ``components``.

Defined cases: an absent or empty text has no words and fingerprint zero, and is
linked like any other; repeated documents share a fingerprint; absent ids never name
a component unless it has no other; an empty table gives no rows; other columns are
left alone.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import map_batches
from beatgrid.llm.components import components
from beatgrid.sources.staging import materialise

SHINGLE, SEED, RADIUS, BITS = 3, 42, 2, 64
SHARD_LIMIT = 2048
LEVELS = 6
CHUNK = 1 << 16
PAIRS = 1 << 21


def lower_table() -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, lower: bytes, size: int = SHINGLE) -> int:
    """Majority bits of the hashes of all shingles."""
    words = text.translate(lower).split()
    if not words:
        return 0
    count = max(1, len(words) - size + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) > size else iter((b" ".join(words),))
    digests = map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED))
    ones = np.zeros(BITS, np.int64)
    while (h := np.fromiter(itertools.islice(digests, CHUNK), np.uint64)).size:
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` packed in ``row``, and ``fingerprint`` as a long."""
    rest = [c for c in docs.columns if c != text]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(text).cast("binary").alias("text"))

    def work(batches):
        lower = lower_table()
        for batch in batches:
            found = [fingerprint(t.as_py() or b"", lower) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["row", "fingerprint"])

    return map_batches(packed, work, f"row {packed.schema['row'].dataType.simpleString()}, fingerprint long")


def split_bits(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` in ``parts`` masks of about equal size."""
    bits = [i for i in range(BITS) if free >> i & 1]
    edges = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(edges, edges[1:])]


def child_masks(mask: int, parts: int) -> list[int]:
    return [mask | part for part in split_bits(~mask & ((1 << BITS) - 1), parts)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def sharded(distinct: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """``(mask, value, fingerprint)``: every fingerprint in each of its shards, none over the limit."""
    keyed, level, done = distinct.select("fingerprint", F.lit(0).cast("long").alias("mask")), [0], None
    for depth in range(LEVELS):
        children = {m: child_masks(m, radius + 1) for m in level}
        table = F.create_map(*[x for m, cs in children.items() for x in (F.lit(signed(m)).cast("long"), F.array(*[F.lit(signed(c)).cast("long") for c in cs]))])
        level = [c for cs in children.values() for c in cs]
        dealt = (keyed.select("fingerprint", F.explode(F.element_at(table, F.col("mask"))).alias("mask"))
                 .withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask"))))
        crowded = materialise(dealt.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).drop("n"), "crowded")
        more = depth + 1 < LEVELS and not crowded.isEmpty()
        fit = dealt.join(crowded, ["mask", "value"], "left_anti") if more else dealt
        done = fit if done is None else done.unionByName(fit)
        if not more:
            break
        keyed = dealt.join(crowded, ["mask", "value"], "left_semi").select("fingerprint", "mask")
    return done


class BKForest:
    """BK-trees of several groups in flat arrays; a node's children are sorted by their distance to it."""

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        self.values = values
        first = np.r_[True, groups[1:] != groups[:-1]]
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1]
        at, items = self.root.copy(), np.flatnonzero(~first)
        keys, children = [], []
        while items.size:
            key = at[items] * (BITS + 1) + self.distance(items, at[items])
            unique, new, inverse = np.unique(key, return_index=True, return_inverse=True)
            child = items[new]
            keys.append(unique)
            children.append(child)
            at[items] = child[inverse]
            items = items[at[items] != items]
        order = np.argsort(np.concatenate(keys)) if keys else []
        self.keys = np.concatenate(keys)[order] if keys else np.zeros(0, np.int64)
        self.children = np.concatenate(children)[order] if keys else np.zeros(0, np.int64)

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.values[a] ^ self.values[b]).astype(np.int64)

    def links(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, smaller member) within the radius."""
        query, node, found = queries, self.root[queries], []
        while query.size:
            d = self.distance(query, node)
            hit = (d <= radius) & (node < query)
            found.append((query[hit], node[hit]))
            low = np.searchsorted(self.keys, node * (BITS + 1) + np.maximum(d - radius, 0))
            high = np.searchsorted(self.keys, node * (BITS + 1) + np.minimum(d + radius, BITS), "right")
            n = high - low
            query = np.repeat(query, n)
            node = self.children[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n members the smallest member it is linked to, by any path."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def linked(values: np.ndarray, groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Members with the smallest value each reaches inside its group, itself excluded."""
    forest, pairs = BKForest(values, groups), []
    size = np.bincount(np.cumsum(np.r_[True, groups[1:] != groups[:-1]]) - 1)
    cost = np.cumsum(np.repeat(size, size))
    for part in np.split(np.arange(values.size), np.searchsorted(cost, np.arange(PAIRS, cost[-1], PAIRS))):
        if part.size:
            pairs.append(forest.links(part, radius))
    label = least_reachable(values.size, np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]))
    member = np.flatnonzero(label != np.arange(values.size))
    return values[member], values[label[member]]


def link_shards(shards: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(u, v)`` that connect, inside each shard, all that is linked there."""
    def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        kept = np.zeros((0, 3), np.int64)
        for batch in batches:
            rows = np.concatenate([kept, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)])
            last = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))
            cut = last[-1] + 1 if last.size else 0
            yield rows[:cut]
            kept = rows[cut:]
        yield kept

    def work(batches):
        for rows in whole_groups(batches):
            if len(rows):
                start = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
                group = np.cumsum(start)
                crowd = np.bincount(group)[group] > 1
                if crowd.any():
                    u, v = linked(rows[crowd, 2], group[crowd], radius)
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    dealt = shards.select("mask", "value", "fingerprint").repartition("mask", "value").sortWithinPartitions("mask", "value", "fingerprint")
    return map_batches(dealt, work, "u long, v long")


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", radius: int = RADIUS,
                    limit: int = SHARD_LIMIT) -> DataFrame:
    """All columns but the text in ``row``, with ``fingerprint``, ``component`` (a fingerprint of it) and ``component_id``."""
    marked = materialise(fingerprints(docs, text), "fingerprints")
    distinct = materialise(marked.groupBy("fingerprint").agg(F.min(F.col("row").getField(id_column)).alias("first_id")), "distinct")
    groups = components(link_shards(sharded(distinct, radius, limit), radius))
    placed = distinct.join(groups, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component"))
    names = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    placed = placed.join(names, "component").select("fingerprint", "component", "component_id")
    return marked.join(placed, "fingerprint")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component: the one with the smallest id, of those the smallest text digest.

    Absent ids come last. Rows are told apart by id and text, so repeated rows count
    once, and documents that share an id but not their text are judged one by one.
    """
    key = F.concat_ws(":", F.md5(F.coalesce("text", F.lit(""))), F.col("doc_id").cast("string"))
    named = near_duplicates(docs.select("doc_id", "text", key.alias("key")))
    first = named.groupBy("component").agg(F.min(F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id"), F.col("row.key"))).alias("first"))
    kept = materialise(first.select(F.col("first.key").alias("key")), "kept")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def op10_simhash_groups(docs: DataFrame) -> DataFrame:
    """Fingerprint and group of every document."""
    return near_duplicates(docs).select(
        "row.doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
