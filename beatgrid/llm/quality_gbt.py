"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted on at most ``FIT_ROWS`` labelled documents, those with the
smallest hash of their id; that bound is the only sample here, and it keeps what is
broadcast and what reaches the driver bounded. Feature values become bins by their
quantiles, each tree grows level by level from gradient sums per node, feature and
bin, and all trees are complete, so that they lie in flat arrays and a batch of
documents walks one level of all trees at a time in numpy. Scoring passes over every
document once, without a shuffle.

Defined cases: an absent text counts as empty and gets a score; absent labels and
absent ids are not learned from; several labels of one id count by their mean; with
no labelled rows, or rows of one label, all scores are that share (0.5 without rows);
an empty table gives no rows; other columns, whatever their names, stay in ``row``.
"""

from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import is_held_out, map_batches, narrow

FIT_ROWS = 50_000
TREES, DEPTH, BINS, RATE, SHRINK, LEAST = 80, 4, 64, 0.15, 1.0, 5.0
THRESHOLD = 0.3
#: Fixed: marks that stand for markup, tables and noise rather than prose.
SYMBOLS = b"#$%&*|<>{}[]=/\\~^_@+"
ENDINGS = b".!?"
FEATURES = 22


class Trees(NamedTuple):
    """Complete trees: split feature and threshold per inner node, value per leaf."""
    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray


def statistics(text: bytes) -> list[float]:
    """Numbers of one document, from its UTF-8 bytes and its words and lines."""
    n = len(text)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if n else np.zeros(256, np.int64)
    share = seen / max(n, 1)
    words, lines = text.split(), [line for line in text.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counted, w = Counter(words), max(len(words), 1)
    top = counted.most_common(1)[0][1] if words else 0
    again = sum(a == b for a, b in zip(words, words[1:]))
    line_lengths = np.fromiter(map(len, lines), np.int64, len(lines)) if lines else np.zeros(1, np.int64)
    letters = share[65:91].sum() + share[97:123].sum()
    return [
        np.log1p(n), letters, share[65:91].sum(), share[48:58].sum(), share[32], share[10],
        share[list(SYMBOLS)].sum(), share[124], share[list(ENDINGS)].sum(), share[44], share[128:].sum(),
        np.log1p(len(words)), lengths.mean(), lengths.std(), lengths.max(), len(counted) / w, top / w, again / w,
        (lengths <= 3).mean(), np.log1p(line_lengths.mean()), 1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(len(lines)),
    ]


def matrix(texts: pa.Array) -> np.ndarray:
    rows = [statistics(t.as_py() or b"") for t in texts]
    return np.array(rows, np.float64).reshape(len(rows), FEATURES)


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
              rate: float = RATE, shrink: float = SHRINK, least: float = LEAST) -> Trees:
    """Logistic boosting on binned features."""
    mean = float(y.mean()) if y.size else 0.5
    inner, leaves = (1 << depth) - 1, 1 << depth
    if not y.size or not 0 < mean < 1:
        start = 0.0 if not y.size else np.copysign(20.0, mean - 0.5)
        return Trees(float(start), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(column, np.arange(1, bins) / bins)) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], axis=1)
    slots = np.arange(x.shape[1]) * bins
    start = float(np.log(mean / (1 - mean)))
    margin = np.full(y.size, start)
    all_features, all_thresholds, all_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, p * (1 - p)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(y.size, np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            at = ((node - first)[:, None] * (slots.size * bins) + slots + binned).ravel()
            shape = (width, slots.size, bins)
            g = np.bincount(at, np.repeat(gradient, slots.size), width * slots.size * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(weight, slots.size), width * slots.size * bins).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g ** 2 / (h + shrink) + (all_g - g) ** 2 / (all_h - h + shrink) - all_g ** 2 / (all_h + shrink)
            gain[(h < least) | (all_h - h < least)] = -np.inf
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-9 and b < cuts[f].size:
                    feature[first + k], threshold[first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(y.size), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, weight, leaves) + shrink)
        margin += value[leaf]
        all_features.append(feature)
        all_thresholds.append(threshold)
        all_leaves.append(value)
    return Trees(start, np.array(all_features), np.array(all_thresholds), np.array(all_leaves))


def predict(model: Trees, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row."""
    trees, inner = model.feature.shape
    margin = np.full(len(x), model.start)
    if trees and len(x):
        tree, row = np.arange(trees)[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), trees), np.int64)
        for _ in range(inner.bit_length()):
            node = 2 * node + 1 + (x[row, model.feature[tree, node]] > model.threshold[tree, node])
        margin += model.leaf[tree, node - inner].sum(axis=1)
    return 1 / (1 + np.exp(-margin))


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Trees:
    """Fit on documents whose labels may be learned from, ``rows`` of them at most."""
    known = (narrow(labels, "doc_id", "quality").filter(F.col("quality").isNotNull() & ~is_held_out("doc_id"))
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good")))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = narrow(docs, "doc_id", "text").join(F.broadcast(sample), "doc_id").select(
        "doc_id", "good", F.col("text").cast("binary").alias("text"))

    def work(batches):
        for batch in batches:
            x = matrix(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))],
                                             names=["doc_id", "good", "x"])

    found = map_batches(texts, work, "doc_id long, good boolean, x array<double>")
    one = found.groupBy("doc_id").agg(F.min(F.struct("x", "good")).alias("v")).orderBy("doc_id").toArrow()
    value = one.column("v").combine_chunks()
    x = np.array(value.field("x").to_pylist(), np.float64).reshape(-1, FEATURES)
    return fit_trees(x, np.array(value.field("good").to_pylist(), np.float64))


def score(docs: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """Each row packed in ``row``, with its ``score``."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def work(batches):
        for batch in batches:
            row = batch.column(0)
            texts = row.field(row.type.get_field_index(text)).cast(pa.binary())
            p = predict(Trees(*shared.value), matrix(texts))
            yield pa.RecordBatch.from_arrays([row, pa.array(p, pa.float64())], names=["row", "score"])

    return map_batches(packed, work, f"row {packed.schema['row'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject."""
    return score(docs, fit_quality(docs, labels)).filter(F.col("score") >= threshold).select("row.*")


def op6_quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and decision for every document."""
    return score(docs, fit_quality(docs, labels)).select(
        "row.doc_id", is_held_out("row.doc_id").alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
