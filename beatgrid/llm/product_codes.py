"""Product quantisation of integer vectors with memoised grid cells.

Vectors are scaled and floored to integers and cut into equal consecutive parts. Each
part position has a codebook, fitted by Lloyd rounds: every part is assigned to its
nearest entry, then each entry becomes the floored mean of its parts. A round is one
pass over the written integer vectors; tasks return one row per part position and used
entry, which Spark adds up, so the driver only sees codebooks.

The nearest entry is found through a grid. A part falls into a coarse cell, a box whose
side is a power of two; the box alone bounds the distance to every entry from below and
above, and an entry whose least distance exceeds another's greatest one cannot win for
any part of the box. The entries left are kept per cell in a table of the task, so that
parts of a known cell are compared with those only, exactly. The side is the smallest
one at which the first batch has at least ``REUSE`` parts a cell. Data without clusters
have few small cells in common, so there most entries are left in; the result is the same.
A table over ``MEMO`` kept entries is dropped and filled again.

All arithmetic is on whole numbers: in doubles while every distance stays below 2**53,
in longs up to 2**63. Components beyond that end in an error before anything is fitted,
as no long could hold the result.

Defined cases: vectors that are null, empty, or hold a null or non-finite component are
left out, as are those of another length than the most frequent one (the smaller length
of equally frequent ones); a length that four does not divide is cut as evenly as
possible; zero vectors take part; codebooks start from the smallest ids, absent ids
last, equal ids by their integers; fewer vectors than entries give fewer entries;
repeated rows count each time; labels that are absent are one group; an empty table
gives no rows; other columns are left alone.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import map_batches
from beatgrid.sources.staging import materialise

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
REUSE, MEMO = 8, 1 << 21
DOUBLE_LIMIT, LONG_LIMIT = 1 << 53, 1 << 63


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
                    label: str = "label", scale: int = SCALE) -> DataFrame:
    """``(id, label, v)`` of the vectors that take part, written; ``v`` holds longs."""
    named = vectors.select(F.col(id_column).alias("id"), F.col(label).alias("label"),
                           F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = named.filter(F.col("x").isNotNull() & (F.size("x") > 0) & finite)
    lengths = good.groupBy(F.size("x").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").limit(1)
    one = good.join(F.broadcast(lengths.select("n")), F.size("x") == F.col("n"))
    return materialise(one.select("id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v")), "integers")


def part_edges(dimensions: int, parts: int = PARTS) -> list[tuple[int, int]]:
    edges = [dimensions * k // parts for k in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class CellSearch:
    """Nearest entries of one codebook for parts, by remembered cells."""

    def __init__(self, entries: np.ndarray, exact_type=np.float64, reuse: int = REUSE, memo: int = MEMO):
        self.entries = entries.astype(exact_type)
        self.norms = (self.entries ** 2).sum(axis=1)
        self.type, self.reuse, self.memo = exact_type, reuse, memo
        self.shift, self.cells, self.kept = None, {}, 0

    def pick_side(self, x: np.ndarray) -> int:
        """Bits of the smallest side with ``reuse`` parts a cell."""
        top = int(np.abs(x).max(initial=0)).bit_length() + 1
        low, high = 0, top
        while low < high:
            middle = (low + high) // 2
            if len(np.unique(self.cell_of(x, middle), axis=0)) * self.reuse <= len(x):
                high = middle
            else:
                low = middle + 1
        return high

    @staticmethod
    def cell_of(x: np.ndarray, shift: int) -> np.ndarray:
        """Boxes are centred on multiples of their side, so that values around zero share one."""
        return (x + (1 << shift >> 1)) >> shift

    def survivors(self, cell: np.ndarray) -> np.ndarray:
        """The entries that may be nearest to some part in the box of the cell."""
        low = (cell.astype(np.int64) << self.shift) - (1 << self.shift >> 1)
        low, high = low.astype(self.type), (low + (1 << self.shift) - 1).astype(self.type)
        below, above = low - self.entries, self.entries - high
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=1)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=1)
        return np.flatnonzero(least <= most.min())

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row, the lowest of equals, and the squared distance."""
        if self.shift is None:
            self.shift = self.pick_side(x)
        cells, group = np.unique(self.cell_of(x, self.shift), axis=0, return_inverse=True)
        order = np.argsort(group.ravel(), kind="stable")
        ends = np.cumsum(np.bincount(group.ravel(), minlength=len(cells)))
        values = x.astype(self.type)
        index, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        for cell, rows in zip(cells, np.split(order, ends[:-1])):
            key = cell.tobytes()
            if (kept := self.cells.get(key)) is None:
                if self.kept > self.memo:
                    self.cells, self.kept = {}, 0
                kept = self.cells[key] = self.survivors(cell)
                self.kept += len(kept)
            part = values[rows]
            d = self.norms[kept] - 2 * (part @ self.entries[kept].T)
            best = d.argmin(axis=1)
            index[rows] = kept[best]
            distance[rows] = d[np.arange(len(rows)), best] + (part ** 2).sum(axis=1)
        return index, distance


def searches(codebooks: list[np.ndarray], exact_type) -> list[CellSearch]:
    return [CellSearch(c, exact_type) for c in codebooks]


def entry_sums(vectors: DataFrame, codebooks: list[np.ndarray], exact_type=np.float64) -> DataFrame:
    """``(part, entry, n, sums)`` of the parts nearest to each used entry."""
    edges = part_edges(sum(c.shape[1] for c in codebooks), len(codebooks))
    width = max(b - a for a, b in edges)

    def work(batches):
        search = searches(codebooks, exact_type)
        counts = [np.zeros(len(c), np.int64) for c in codebooks]
        sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column(0))
                for k, (a, b) in enumerate(edges):
                    index, _ = search[k].nearest(v[:, a:b])
                    counts[k] += np.bincount(index, minlength=len(counts[k]))
                    np.add.at(sums[k], index, v[:, a:b])
        for k in range(len(edges)):
            used = np.flatnonzero(counts[k])
            rows = [np.pad(r, (0, width - len(r))) for r in sums[k][used]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[k][used]),
                 pa.array(rows, pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    found = map_batches(vectors.select("v"), work, "part int, entry int, n long, sums array<long>")
    return found.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums").getItem(i)) for i in range(width)]).alias("sums"))


def moved(codebooks: list[np.ndarray], sums: DataFrame) -> list[np.ndarray]:
    """Codebooks at the floored means; entries without parts stay. At most parts x entries rows are fetched."""
    new = [c.copy() for c in codebooks]
    for part, entry, n, total in sums.collect():
        new[part][entry] = [t // n for t in total[:new[part].shape[1]]]
    return new


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[list[np.ndarray], type]:
    """Codebooks of written integer vectors, and the number type in which all distances are exact."""
    absolute = F.array_max(F.transform("v", lambda c: F.abs(c.cast("double"))))
    largest = vectors.agg(F.max(absolute)).first()[0]
    if largest is None:
        return [], np.float64
    first = [r["v"] for r in vectors.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()]
    bound = len(first[0]) * (2 * int(largest) + 2) ** 2
    if bound >= LONG_LIMIT:
        raise ValueError(f"a component of {largest:.3g} after scaling is too large for distances in a long")
    exact_type = np.float64 if 4 * bound < DOUBLE_LIMIT else np.int64
    start = np.array(first, np.int64)
    codebooks = [start[:, a:b] for a, b in part_edges(start.shape[1], parts)]
    for _ in range(rounds):
        codebooks = moved(codebooks, entry_sums(vectors, codebooks, exact_type))
    return codebooks, exact_type


def encode(vectors: DataFrame, codebooks: list[np.ndarray], exact_type=np.float64) -> DataFrame:
    """``(id, label, code, error)``: two hex digits a part, and the squared distance over all parts."""
    edges = part_edges(sum(c.shape[1] for c in codebooks), len(codebooks))

    def work(batches):
        search = searches(codebooks, exact_type)
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column(2))
                found = [search[k].nearest(v[:, a:b]) for k, (a, b) in enumerate(edges)]
                codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes]),
                     pa.array(sum(distance for _, distance in found))], names=["id", "label", "code", "error"])

    types = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    return map_batches(vectors.select("id", "label", "v"), work, f"id {types['id']}, label {types['label']}, code string, error long")


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    """Over all components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel()).encode()).hexdigest()


def decode(codes: DataFrame, codebooks: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """Add ``approximation``: the vector that each code stands for."""
    tables = [F.array(*[F.array(*[F.lit(float(x) / scale) for x in entry]) for entry in c]) for c in codebooks]
    index = [F.conv(F.substring("code", 2 * k + 1, 2), 16, 10).cast("int") for k in range(len(codebooks))]
    return codes.withColumn("approximation", F.concat(*[F.get(t, i) for t, i in zip(tables, index)]))


def op13_vector_codes(vectors: DataFrame) -> DataFrame:
    """Code and error of every usable vector, with the error of its label and a digest of the codebooks."""
    whole = integer_vectors(vectors)
    codebooks, exact_type = fit(whole)
    if not codebooks:
        return whole.select(F.col("id").alias("vec_id"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    codes = materialise(encode(whole, codebooks, exact_type), "codes")
    labels = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (codes.join(labels, F.col("label").eqNullSafe(F.col("of")))
            .select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256")))
