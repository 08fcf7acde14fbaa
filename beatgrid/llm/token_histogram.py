"""Exact histogram of encoded lengths, and what suffix sums over it answer.

Documents are encoded where they lie and only counted; Spark adds documents and
tokens per length. With the suffix sums over the lengths, one row per length answers
totals, quantiles and truncated totals for any context limit. Lengths are cut into
ranges of ``RANGE`` values; the ranges' sums give each range its start, so neither
step holds more than the distinct lengths of one range, or one row per range.

Defined cases: an absent or empty text has length 0 and counts as a document; equal
and repeated documents all count; an empty table gives an empty histogram; texts are
encoded whole, and the strings of special tokens are ordinary text; other columns
are not read.
"""

import base64
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatgrid.llm.common import map_batches
from beatgrid.sources.staging import materialise

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed: the pattern that the rank file's vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANGE = 4096
#: White space as the pattern's engine knows it; its stack overflows on very long runs, which are therefore cut by hand.
LONG_RUN = 100_000
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LONG_SPACES = re.compile(f"(?<![{SPACES}])[{SPACES}]{{{LONG_RUN},}}+")


def load_encoding(path: str = VOCABULARY) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_length(text: str, encoding: tiktoken.Encoding) -> int:
    """Number of tokens of the whole text.

    By the pattern a run of white space is one piece without its last character, which
    begins what follows; a run at the end is one piece. Long runs are cut out by that
    rule and encoded as the pieces they are.
    """
    count, at = 0, 0
    for run in LONG_SPACES.finditer(text) if len(text) >= LONG_RUN else ():
        end = run.end() if run.end() == len(text) else run.end() - 1
        count += len(encoding.encode_to_numpy(text[at:run.start()], disallowed_special=()))
        count += len(encoding._encode_single_piece(text[run.start():end]))
        at = end
    return count + len(encoding.encode_to_numpy(text[at:] if at else text, disallowed_special=()))


def token_counts(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns but the text packed in ``row``, with ``n_tokens``; the vocabulary lies at that path on each machine."""
    rest = [c for c in docs.columns if c != text]
    packed = docs.select(F.struct(F.lit(0).alias("__none"), *[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(text).alias("text"))

    def work(batches):
        encoding = load_encoding(vocabulary)
        for batch in batches:
            lengths = [encoded_length(t.as_py() or "", encoding) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(lengths, np.int64))], names=["row", "n_tokens"])

    counted = map_batches(packed, work, f"row {packed.schema['row'].dataType.simpleString()}, n_tokens long")
    return counted.withColumn("row", F.col("row").dropFields("__none")) if rest else counted.select("n_tokens")


def histogram(lengths: DataFrame) -> DataFrame:
    """Documents per length, with suffix sums: documents and tokens at or above the length,
    and the tokens left if every document were cut to it."""
    counted = materialise(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
    tokens = (F.col("n_tokens") * F.col("n_docs")).alias("tokens")
    ranged = counted.withColumn("tokens", tokens).withColumn("range", F.floor(F.col("n_tokens") / RANGE))
    ranges = ranged.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = W.orderBy(F.desc("range")).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(1))
    ranges = ranges.select("range", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
                           F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
                           F.sum("d").over(everything).alias("d_all"), F.sum("t").over(everything).alias("t_all"))
    here = W.partitionBy("range").orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, 0)
    summed = ranged.join(ranges, "range").select(
        "n_tokens", "n_docs", (F.sum("n_docs").over(here) + F.col("d_above")).alias("docs_at_least"),
        (F.sum("tokens").over(here) + F.col("t_above")).alias("tokens_at_least"), "d_all", "t_all")
    return summed.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("t_all") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
        (F.col("docs_at_least") - F.col("n_docs")).alias("docs_cut"),
        ((F.col("d_all") - F.col("docs_at_least") + F.col("n_docs")) / F.col("d_all")).alias("share_at_most"))


def at_limits(suffix_sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Documents cut and tokens left for any limits, from the first length above each."""
    spark = suffix_sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in sorted(set(limits))], "limit long")
    steps = F.array(*[F.lit(int(x)) for x in sorted(set(limits))])
    beyond = suffix_sums.select("*", F.explode(F.filter(steps, lambda x: x < F.col("n_tokens"))).alias("limit"))
    cut = beyond.groupBy("limit").agg(F.min(F.struct("n_tokens", "docs_at_least", "tokens_at_least")).alias("next"))
    total = suffix_sums.agg(F.max("tokens_at_least").alias("total"))
    over = F.coalesce("next.docs_at_least", F.lit(0))
    return asked.join(cut, "limit", "left").join(total, F.lit(True), "left").select(
        "limit", over.alias("docs_cut"),
        (F.coalesce("total", F.lit(0)) - F.coalesce("next.tokens_at_least", F.lit(0)) + F.col("limit") * over).alias("truncated_tokens"))


def quantiles(suffix_sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The smallest length that at least this share of documents does not exceed."""
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    reached = suffix_sums.select("n_tokens", F.explode(F.filter(wanted, lambda s: s <= F.col("share_at_most"))).alias("share"))
    return reached.groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def op2_token_histogram(docs: DataFrame) -> DataFrame:
    """The histogram of encoded lengths of all documents, with its suffix sums."""
    return histogram(token_counts(docs.select("text")))
