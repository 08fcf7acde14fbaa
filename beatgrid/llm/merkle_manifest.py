"""A Merkle manifest of a document table, with proofs recomputed from stored levels.

Every row is a leaf: the digest of its fields. The leaves of a source, ascending by
``doc_id``, are the bottom of that source's tree: every run of ``FAN`` nodes, and the
last shorter one, becomes the digest of its digests, until one is left, the subroot.
The subroots by source (absent first, bytewise) are the leaves of a top tree, whose one
node is the root.

Only every ``SKIP``-th level is written. An aligned subtree between two written levels
has at most ``FAN ** SKIP`` nodes below; building it, a task keeps its interior nodes only
until the node above is known. For proofs, the written nodes are taken from the top down:
a task reads the stored descendants of one aligned subtree with the siblings known above
its root, computes its missing interior nodes again, emits the siblings of each
descendant, and drops the nodes. Siblings of inner levels are shared by a whole subtree
and travel once per subtree, not once per leaf.

Positions come from a range partitioning by source and id: rows are numbered within
their range, and a range's start is the number of rows of that source in ranges before
it. A source with a third of all rows spans many ranges and many subtrees, and no task
holds more than one range or one subtree of it.

Defined cases: an absent field counts as ``-``, an empty one as ``0:``; rows without id
come first in their source; rows of one id are ordered by their leaf, so equal rows are
neighbours; a row without id is never chosen for tampering; an empty table gives no rows;
other columns, whatever their names, take no part.
"""

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from beatgrid.llm.common import map_batches
from beatgrid.sources.staging import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN, SKIP = 16, 3
RANGE_ROWS = 500_000
DIGITS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPER_ONE_IN = 5


# --- leaves -------------------------------------------------------------------------

def framed(value: Column) -> Column:
    """The value behind its UTF-8 length, ``-`` if it is absent."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def leaves(docs: DataFrame, fields=FIELDS, tampered: Column | None = None) -> DataFrame:
    """``(tree, id, leaf, other)``: the source as a key that is never absent, the id, the digest, and the tampered digest or null."""
    named = [F.col(f"`{f}`") for f in fields]
    other = F.lit(None).cast("string")
    if tampered is not None:
        changed = [F.translate(c, UPPER, LOWER) if f == "text" else c for f, c in zip(fields, named)]
        other = F.when(tampered, row_digest(changed))
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    return docs.select(tree.alias("tree"), F.col("doc_id").alias("id"), row_digest(named).alias("leaf"), other.alias("other"))


# --- positions ------------------------------------------------------------------------

def placed(rows: DataFrame, order: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Written rows with ``pos``, the position by ``order`` (absent first) in the ``tree``, and its ``size``.

    Rows equal in the order are told apart by where they were read.
    """
    rows = materialise(rows, "leaves").withColumn("__at", F.monotonically_increasing_id())
    spark = rows.sparkSession
    ranges = max(spark.sparkContext.defaultParallelism, math.ceil(rows.count() / range_rows))
    by = ["tree", *order, "__at"]
    sorted_rows = materialise(rows.repartitionByRange(ranges, *by).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = sorted_rows.groupBy("tree", "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy("tree").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("tree", "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
                           F.sum("__n").over(W.partitionBy("tree")).alias("size"))
    inside = W.partitionBy("tree", "__range").orderBy(*order, "__at")
    numbered = sorted_rows.withColumn("__in", F.row_number().over(inside) - 1)
    return materialise(numbered.join(starts, ["tree", "__range"])
                       .withColumn("pos", F.col("__start") + F.col("__in")).drop("__range", "__in", "__start", "__at"), "placed")


# --- subtrees ---------------------------------------------------------------------------

def height(size: int, fan: int = FAN) -> int:
    """Levels above the leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // fan), levels + 1
    return levels


def height_column(size: Column, fan: int = FAN) -> Column:
    """The same as a column: as many powers of the fan as are smaller than the size."""
    return reduce(lambda a, b: a + b, [(size > fan ** k).cast("int") for k in range(16) if fan ** k < 1 << 62])


def joined_runs(digests: list[bytes], fan: int = FAN) -> list[bytes]:
    return [b"".join(digests[i:i + fan]) for i in range(0, len(digests), fan)]


def digest(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def interior(digests: list[bytes], steps: int, fan: int = FAN) -> list[list[bytes]]:
    """Joined digests of the runs, level by level; the last level has the runs just below the root."""
    levels = []
    for _ in range(steps):
        levels.append(joined_runs(digests, fan))
        digests = [digest(run) for run in levels[-1]]
    return levels


def groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (tree, chunk), which come one after the other."""
    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if kept is None else pa.concat_tables([kept, table])
        tree, chunk = table["tree"].combine_chunks(), table["chunk"].to_numpy()
        codes = tree.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (chunk[1:] != chunk[:-1])]) if table.num_rows else []
        for a, b in zip(starts, starts[1:]):
            yield table.slice(a, b - a)
        kept = table.slice(starts[-1]) if len(starts) else None
    if kept is not None:
        yield kept


def by_subtree(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "pos")


def raised(nodes: DataFrame, level: int, fan: int = FAN, skip: int = SKIP) -> DataFrame:
    """The next written level: one node per aligned subtree of the given one."""
    def work(batches):
        for table in groups_of(batches):
            size = table["size"][0].as_py()
            steps = min(skip, height(size, fan) - level)
            runs = interior([d.encode() for d in table["digest"].to_pylist()], steps, fan)
            yield pa.RecordBatch.from_arrays(
                [table["tree"].slice(0, 1).combine_chunks(), pa.array([size]), table["chunk"].slice(0, 1).combine_chunks(),
                 pa.array([digest(runs[-1][0]).decode()])], names=["tree", "size", "pos", "digest"])

    open_nodes = nodes.filter(height_column(F.col("size"), fan) > level)
    chunk = F.floor(F.col("pos") / (fan ** skip)).cast("long").alias("chunk")
    return map_batches(by_subtree(open_nodes.select("tree", chunk, "pos", "size", "digest")), work,
                       "tree string, size long, pos long, digest string")


def written_levels(bottom: DataFrame, fan: int = FAN, skip: int = SKIP) -> list[DataFrame]:
    """``(tree, size, pos, digest)`` of the levels 0, ``skip``, 2 ``skip`` and so on, up to the highest tree."""
    levels = [bottom]
    largest = bottom.agg(F.max("size")).first()[0] or 1
    while height(largest, fan) > (len(levels) - 1) * skip:
        levels.append(materialise(raised(levels[-1], (len(levels) - 1) * skip, fan, skip), "level"))
    return levels


def peaks(levels: list[DataFrame], fan: int = FAN, skip: int = SKIP) -> DataFrame:
    """``(tree, size, digest, top)``: the last node of every tree, and the written level that holds it."""
    found = []
    for i, nodes in enumerate(levels):
        top = F.ceil(height_column(F.col("size"), fan) / skip).cast("int")
        found.append(nodes.filter(top == i).select("tree", "size", "digest", F.lit(i).alias("top")))
    return reduce(DataFrame.unionByName, found)


# --- proofs -------------------------------------------------------------------------------

PATH = "array<struct<left: string, right: string>>"
PATH_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def own_path(runs: list[list[bytes]], at: int, fan: int) -> list[dict]:
    """Siblings of one descendant, level by level up to the subtree's root."""
    path = []
    for level in runs:
        run, place = level[at // fan], at % fan * DIGITS
        path.append({"left": run[:place].decode(), "right": run[place + DIGITS:].decode()})
        at //= fan
    return path


def siblings(path: list[dict]) -> bytes:
    return "".join(step["left"] + step["right"] for step in path).encode()


def folded(leaf: str, path: list[dict]) -> str:
    """The root that a leaf and its siblings give."""
    for step in path:
        leaf = hashlib.sha256((step["left"] + leaf + step["right"]).encode()).hexdigest()
    return leaf


def with_paths(nodes: DataFrame, above: DataFrame, level: int, carried: list[str], emit: Callable, schema: str,
               fan: int = FAN, skip: int = SKIP) -> DataFrame:
    """Send each subtree's descendants and the path of its root to one task, which calls ``emit(table, runs, path, peak)``.

    ``above`` has ``(tree, chunk, peak, path)``, one row per subtree.
    """
    def work(batches):
        for table in groups_of(batches):
            head, rest = table.slice(0, 1), table.slice(1)
            if rest.num_rows:
                steps = max(0, min(skip, height(rest["size"][0].as_py(), fan) - level))
                runs = interior([d.encode() for d in rest["digest"].to_pylist()], steps, fan)
                yield from emit(rest, runs, head["path"][0].as_py(), head["peak"][0].as_py())

    types = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    below = nodes.select("tree", F.floor(F.col("pos") / (fan ** skip)).cast("long").alias("chunk"), "pos", "size", "digest",
                         *carried, none("string", "peak"), none(PATH, "path"))
    heads = above.select("tree", "chunk", F.lit(-1).cast("long").alias("pos"), none("long", "size"), none("string", "digest"),
                         *[none(types[c], c) for c in carried], "peak", "path")
    return map_batches(by_subtree(below.unionByName(heads)), work, schema)


def descended(levels: list[DataFrame], crown: DataFrame, carried: list[str], emit: Callable, schema: str,
              fan: int = FAN, skip: int = SKIP) -> DataFrame:
    """Paths of all leaves, from the written levels downwards.

    ``crown`` has ``(tree, top, peak, path)``: the path from each tree's last node on. Levels above
    the leaves emit their nodes' paths to the next lower one; the leaves go to ``emit``.
    """
    def inner(table, runs, path, peak):
        n = table.num_rows
        paths = [own_path(runs, i, fan) + path for i in range(n)]
        yield pa.RecordBatch.from_arrays(
            [table["tree"].combine_chunks(), table["pos"].combine_chunks(), pa.array([peak] * n), pa.array(paths, PATH_ARROW)],
            names=["tree", "chunk", "peak", "path"])

    above = None
    for i in reversed(range(len(levels))):
        ending = crown.filter(F.col("top") == i).select("tree", F.lit(0).cast("long").alias("chunk"), "peak", "path")
        above = ending if above is None else above.unionByName(ending)
        if i:
            above = materialise(with_paths(levels[i], above, i * skip, [], inner,
                                           f"tree string, chunk long, peak string, path {PATH}", fan, skip), "paths")
    return with_paths(levels[0], above, 0, carried, emit, schema, fan, skip)


class Manifest:
    """Written levels of all source trees and of the top tree, and the root."""

    def __init__(self, rows: DataFrame, fan: int = FAN, skip: int = SKIP, range_rows: int = RANGE_ROWS):
        self.fan, self.skip = fan, skip
        bottom = placed(rows, ["id", "leaf"], range_rows)
        self.levels = written_levels(bottom.withColumnRenamed("leaf", "digest"), fan, skip)
        self.subroots = materialise(peaks(self.levels, fan, skip), "subroots")
        top = placed(self.subroots.select(F.lit("").alias("tree"), F.col("tree").alias("item"), "digest"), ["item"], range_rows)
        self.top_levels = written_levels(top, fan, skip)
        root = peaks(self.top_levels, fan, skip).select("digest").first()
        self.root = root[0] if root else None

    def roots(self) -> DataFrame:
        """``(source, n_rows, subroot)``."""
        source = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30))
        return self.subroots.select(source.alias("source"), F.col("size").alias("n_rows"), F.col("digest").alias("subroot"))

    def crown(self) -> DataFrame:
        """The siblings of each subroot up to the root."""
        fan = self.fan

        def emit(table, runs, path, peak):
            paths = [own_path(runs, i, fan) + path for i in range(table.num_rows)]
            yield pa.RecordBatch.from_arrays([table["item"].combine_chunks(), pa.array(paths, PATH_ARROW)], names=["tree", "path"])

        last = len(self.top_levels) - 1
        start = self.subroots.sparkSession.range(1).select(
            F.lit("").alias("tree"), F.lit(last).alias("top"), F.lit(self.root).alias("peak"), F.array().cast(PATH).alias("path"))
        paths = descended(self.top_levels, start, ["item"], emit, f"tree string, path {PATH}", fan, self.skip)
        return materialise(self.subroots.select("tree", "top", F.col("digest").alias("peak")).join(paths, "tree"), "crown")

    def proofs(self) -> DataFrame:
        """``(id, leaf, subroot, path)``: the siblings of every leaf, left and right, level by level up to the root."""
        fan = self.fan

        def emit(table, runs, path, peak):
            for start in range(0, table.num_rows, 256):
                part = table.slice(start, 256)
                paths = [own_path(runs, start + i, fan) + path for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part["id"].combine_chunks(), part["digest"].combine_chunks(), pa.array([peak] * part.num_rows),
                     pa.array(paths, PATH_ARROW)], names=["id", "leaf", "subroot", "path"])

        kind = self.levels[0].schema["id"].dataType.simpleString()
        return descended(self.levels, self.crown(), ["id"], emit, f"id {kind}, leaf string, subroot string, path {PATH}", fan, self.skip)

    def audited(self) -> DataFrame:
        """``(id, leaf, subroot, proof_sha256, folded_root)``, folded from the tampered digest in ``other``, if any, else from the leaf."""
        fan = self.fan

        def emit(table, runs, path, peak):
            leaves, others = table["digest"].to_pylist(), table["other"].to_pylist()
            proofs, roots, run = [], [], None
            for i, (leaf, other) in enumerate(zip(leaves, others)):
                if i // fan != run:  # from the second level on, the leaves of a run have the same siblings
                    run, shared = i // fan, own_path(runs[1:], i // fan, fan) + path
                    rest = siblings(shared)
                first = own_path(runs[:1], i, fan)
                proofs.append(digest(siblings(first) + rest).decode())
                roots.append(folded(other or leaf, first + shared))
            yield pa.RecordBatch.from_arrays(
                [table["id"].combine_chunks(), table["digest"].combine_chunks(), pa.array([peak] * len(leaves)),
                 pa.array(proofs), pa.array(roots)], names=["id", "leaf", "subroot", "proof_sha256", "folded_root"])

        kind = self.levels[0].schema["id"].dataType.simpleString()
        return descended(self.levels, self.crown(), ["id", "other"], emit,
                         f"id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string", fan, self.skip)


def manifest(docs: DataFrame, **sizes) -> Manifest:
    return Manifest(leaves(docs), **sizes)


def op12_merkle_proofs(docs: DataFrame) -> DataFrame:
    """Leaf, roots, proof digest of every row, and what its proof gives after tampering with one row in five."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_ONE_IN == 0, F.lit(False))
    tree = Manifest(leaves(docs, tampered=tampered))
    return tree.audited().select(
        F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(tree.root).cast("string").alias("root"), "proof_sha256", "folded_root",
        F.coalesce(F.col("folded_root") == F.lit(tree.root).cast("string"), F.lit(False)).alias("verified"))
