"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of all n-grams of all documents that may be learned from are summed per
language and hash bucket: each task counts into arrays, and Spark adds the arrays'
entries. The log-probability matrix has one row per bucket and one column per
language; it is broadcast in blocks of at most ``LANGUAGES_AT_ONCE`` languages, 32 MB
each. Every block is one pass over the texts that keeps the best score so far, so any
number of languages is scored; up to that many take one pass. Names become numbers
before the counts of a block are fetched, at most ``LANGUAGES_AT_ONCE`` times the
buckets, 16 bytes each. A document becomes its
distinct buckets and their counts, a batch of documents one sparse matrix, and the
product gives all scores, ``CELLS`` matrix cells at a time.

Defined cases: an absent text, or one without a letter, is ``und`` with score 0, as is
every text if nothing could be learned from; documents with an absent language or an
absent id are not learned from; ties go to the language first in code-point order; an
empty table gives no rows; other columns, whatever their names, stay in ``row``.
"""

import sys
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import is_held_out, map_batches
from beatgrid.sources.staging import materialise

ORDERS = 3
BUCKET_BITS = 15
SMOOTH = 0.5
LANGUAGES_AT_ONCE = 256
PIECE = 1 << 20
DOCS_AT_ONCE = 256
CELLS = 1 << 22
UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]
    prior: np.ndarray
    log_p: np.ndarray


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Counts per hash bucket of the lower-cased text, runs of other characters as one space; None without letters."""
    total, tail, any_letter = None, np.array([32], np.uint32), False
    for i in range(0, len(text), PIECE):
        points = np.frombuffer(text[i:i + PIECE].lower().encode("utf-32-le"), np.uint32)
        is_letter = letters[points]
        any_letter |= bool(is_letter.any())
        kept = is_letter | np.r_[tail[-1] != 32, is_letter[:-1]]
        piece = np.where(is_letter, points, np.uint32(32))[kept]
        if i + PIECE >= len(text) and piece.size and piece[-1] != 32:
            piece = np.r_[piece, np.uint32(32)]
        run = np.r_[tail, piece]
        fresh = tail.size if i else 0
        grams, hashed = [], run.astype(np.uint32)
        for order in range(1, ORDERS + 1):
            if order > 1:
                hashed = hashed[:-1] * np.uint32(0x01000193) + run[order - 1:]
            new = hashed[max(0, fresh - order + 1):] * np.uint32(0x9E3779B1) + np.uint32(order)
            grams.append((new ^ (new >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BUCKET_BITS))
        counted = np.bincount(np.concatenate(grams), minlength=1 << BUCKET_BITS)
        total = counted if total is None else total + counted
        tail = run[-(ORDERS - 1):]
    return total if any_letter else None


def gram_table(docs: DataFrame, text: str = "text", language: str = "lang", id_column: str = "doc_id") -> DataFrame:
    """``(l, bucket, n)``, written: n-gram counts of every document that may be learned from; the last bucket counts documents."""
    known = docs.filter(F.col(language).isNotNull() & ~is_held_out(id_column)).select(F.col(language).alias("l"), F.col(text).alias("t"))

    def work(batches):
        letters, sums = letter_table(), {}
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                counted = gram_counts(value.as_py() or "", letters)
                if counted is not None:
                    held = sums.setdefault(name, np.zeros((1 << BUCKET_BITS) + 1, np.int64))
                    held[:-1] += counted
                    held[-1] += 1
        for name, held in sums.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([name] * at.size, pa.string()), pa.array(at.astype(np.int32)), pa.array(held[at])], names=["l", "bucket", "n"])

    # Written once: the corpus is counted only once, however often the counts are read.
    return materialise(map_batches(known, work, "l string, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")), "grams")


def models(grams: DataFrame, at_once: int = LANGUAGES_AT_ONCE) -> Iterator[Model]:
    """Log-probabilities of the languages by name, in blocks of at most ``at_once``, one block in memory at a time."""
    documents = {r["l"]: r["n"] for r in grams.filter(F.col("bucket") == 1 << BUCKET_BITS).select("l", "n").collect()}
    names, total = sorted(documents), max(sum(documents.values()), 1)
    for start in range(0, len(names), at_once):
        languages = names[start:start + at_once]
        counts = np.zeros((1 << BUCKET_BITS, len(languages)))
        place = F.array_position(F.array(*[F.lit(name) for name in languages]), F.col("l")).cast("int") - 1
        found = grams.select("bucket", place.alias("place"), "n").filter((F.col("place") >= 0) & (F.col("bucket") < 1 << BUCKET_BITS)).toArrow()
        counts[found.column("bucket").to_numpy(), found.column("place").to_numpy()] = found.column("n").to_numpy()
        log_p = np.log(counts + SMOOTH) - np.log(counts.sum(axis=0) + SMOOTH * (1 << BUCKET_BITS))
        yield Model(languages, np.log(np.array([documents[name] for name in languages]) / total), log_p.astype(np.float32))


def products(buckets: list[np.ndarray], counts: list[np.ndarray], model: Model) -> np.ndarray:
    """Rows of a sparse matrix times the log-probabilities."""
    starts = np.cumsum([0, *(b.size for b in buckets[:-1])])
    return np.add.reduceat(model.log_p[np.concatenate(buckets)] * np.concatenate(counts)[:, None], starts, axis=0)


def best(texts: list[str | None], model: Model, letters: np.ndarray) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """Likeliest language of the block for each text, its score, and the logarithm of the sum over the block, by one sparse product."""
    counted = [gram_counts(t, letters) if t else None for t in texts]
    named, top, sums = [None] * len(texts), np.full(len(texts), -np.inf), np.full(len(texts), -np.inf)
    rows = [i for i, c in enumerate(counted) if c is not None]
    if rows and model.languages:
        at = [np.flatnonzero(counted[i]) for i in rows]
        value = [counted[i][a].astype(np.float64) for i, a in zip(rows, at)]
        size = np.cumsum([a.size * len(model.languages) for a in at])
        parts = np.split(np.arange(len(rows)), np.unique(np.searchsorted(size, np.arange(CELLS, size[-1], CELLS))))
        scores = np.concatenate([products([at[i] for i in part], [value[i] for i in part], model) for part in parts if part.size]) + model.prior
        place, highest = scores.argmax(axis=1), scores.max(axis=1)
        top[rows], sums[rows] = highest, highest + np.log(np.exp(scores - highest[:, None]).sum(axis=1))
        for k, i in enumerate(rows):
            named[i] = model.languages[place[k]]
    return named, top, sums


def identify(docs: DataFrame, blocks: Iterable[Model], text: str = "text") -> DataFrame:
    """All columns but the text packed in ``row``, with ``lang_pred`` and ``score``.

    Every block of languages is one pass over the texts, which carries the best so far
    and the sum of all; up to ``LANGUAGES_AT_ONCE`` languages are one pass.
    """
    rest = [c for c in docs.columns if c != text]
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(text).alias("text"), F.lit(None).cast("string").alias("named"),
                        F.lit(float("-inf")).alias("top"), F.lit(float("-inf")).alias("sums"))
    schema = f"row {found.schema['row'].dataType.simpleString()}, text string, named string, top double, sums double"
    blocks = iter(blocks)
    model = next(blocks, None)
    while model is not None:
        following = next(blocks, None)
        found = map_batches(found, _scorer(docs.sparkSession.sparkContext.broadcast(tuple(model)), following is not None), schema)
        model = following
        if model is not None:
            found = materialise(found, "languages")
    return found.select("row", F.coalesce("named", F.lit(UNKNOWN)).alias("lang_pred"),
                        F.when(F.col("named").isNotNull(), F.exp(F.col("top") - F.col("sums"))).otherwise(0.0).alias("score"))


def _scorer(shared, keep_text: bool):
    def work(batches):
        letters, model = letter_table(), Model(*shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(i, DOCS_AT_ONCE)
                named, top, sums = best(part.column(1).to_pylist(), model, letters)
                before = part.column(3).to_numpy()
                named = [new if t > b else old for new, old, t, b in zip(named, part.column(2).to_pylist(), top, before)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1) if keep_text else pa.nulls(part.num_rows, pa.string()), pa.array(named, pa.string()), pa.array(np.maximum(top, before)),
                     pa.array(np.logaddexp(sums, part.column(4).to_numpy()))], names=["row", "text", "named", "top", "sums"])
    return work


def op9_languages(docs: DataFrame) -> DataFrame:
    """Predicted language of every document."""
    found = identify(docs.select("doc_id", "text"), models(gram_table(docs)))
    return found.select("row.doc_id", is_held_out("row.doc_id").alias("held_out"), "lang_pred", "score")
