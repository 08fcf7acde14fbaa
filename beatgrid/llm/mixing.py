"""Mixing sources to target weights by systematic sampling.

The documents of a source stand in a fixed order. Each expects ``target / size of
the source`` copies; the prefix sums of the expectations, moved by one random
offset per source, cross integer boundaries, and a document is taken once for each
boundary crossed inside its own step. Everything is column expressions.

The order is by size class (32 classes per power of two), so that neighbours are
alike in size and the taken words of a source stay near its target. Positions in
that order come from counts per class and bucket, see ``positions``.

Defined cases: an absent or empty text has size 0 and is taken by the same rule,
which adds no words; an absent source is a source of its own, last in order; an
empty table gives no rows; repeated rows are rows of their own; other columns of
the input, whatever their names, are kept by ``mix`` and left alone.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatgrid.llm.common import WORD, hex_number, id_key
from beatgrid.llm.positions import RANGE_ROWS, SPREAD, with_earlier_sums, with_positions
from beatgrid.sources.staging import materialise

WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = "mix"
STEPS = 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Exact sizes below 64, then 32 classes for each power of two; rises with size."""
    shift = F.greatest(F.length(F.bin(size)) - 6, F.lit(0))
    return (shift * 32 + F.call_function("shiftright", size, shift.cast("int"))).cast("int")


def source_key(source: Column) -> Column:
    """Sorts by code point with an absent source last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT,
                   range_rows: int = RANGE_ROWS) -> DataFrame:
    """Targets of sources from ``(__source, __size_of_source)``, one row per source.

    Targets share the total by weight; none exceeds ``limit`` times the source, and
    what exceeds is shared again among the others. The sources at their limit are
    those that come first by limit per weight, so one ordered pass finds them: with
    the earlier ones at their limits, the rest shares what is left. Ranks and running
    sums go by ranges of sources, so that sources may be as many as web domains.
    """
    ranked = with_earlier_sums(sizes, ["__source"], {"__rank": F.lit(1)}, range_rows)
    weighed = (ranked.withColumn("__weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("__rank") % len(weights)).cast("int") + 1))
                     .withColumn("__cap", limit * F.col("__size_of_source")).drop("__rank"))
    per_weight = F.col("__cap") / F.col("__weight")
    left = with_earlier_sums(weighed.withColumn("__turn", per_weight), ["__turn", "__source"],
                             {"__caps": F.col("__cap"), "__weights": F.col("__weight")}, range_rows)
    whole, shares = weighed.agg(F.coalesce(F.sum("__size_of_source"), F.lit(0)), F.coalesce(F.sum("__weight"), F.lit(0))).first()
    left = materialise(left.withColumn("__left", whole - F.col("__caps")).withColumn("__open", shares - F.col("__weights")), "turns")
    wide = lambda c: F.col(c).cast("decimal(18,0)")  # noqa: E731 - products of sums may pass a long
    free = wide("__cap") * wide("__open") > wide("__left") * wide("__weight")
    first = left.filter(free).agg(F.min(F.struct("__turn", "__source", "__left", "__open"))).first()[0]
    # A literal below 2^31 would be an int, whose product with a weight may not be one.
    share = F.lit(None) if first is None else F.lit(first["__left"]).cast("long") * F.col("__weight") / first["__open"]
    capped = F.lit(True) if first is None else ~free
    return left.select("__source", "__size_of_source", F.when(capped, F.col("__cap").cast("double")).otherwise(share).alias("__target"))


def with_copies(docs: DataFrame, text: str | None = "text", source: str = "source", id_column: str = "doc_id",
                size: str | None = None, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT,
                seed: str = SEED) -> DataFrame:
    """Each row packed in ``row``, with its size, source size, target and copies.

    ``size`` names a column with the sizes; without it they are the words of ``text``.
    """
    key = F.md5(id_key(id_column))
    measured = word_count(F.col(text)) if size is None else F.col(size)
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), measured.alias("__size"),
                        source_key(F.col(source)).alias("__source"), hex_number(key, 1, 8).alias("__spread"),
                        F.col(id_column).alias("__id"))
            .withColumn("__class", size_class(F.col("__size"))))
    light = materialise(rows.select("__source", "__class", "__spread", "__size"), "sizes")
    classes = materialise(light.groupBy("__source", "__class").agg(F.count(F.lit(1)).alias("__n"), F.sum("__size").alias("__words")), "classes")
    sources = classes.groupBy("__source").agg(F.sum("__words").alias("__size_of_source"))
    targets = source_targets(sources, weights, limit)
    before = W.partitionBy("__source").orderBy("__class").rowsBetween(W.unboundedPreceding, -1)
    starts = classes.select("__source", "__class", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")).join(targets, "__source")
    placed = with_positions(rows, light.drop("__size"), ["__source", "__class"], "__spread", ["__size", "__id"], "__at", group_start=starts)
    rate = F.when(F.col("__size_of_source") > 0, F.col("__target") / F.col("__size_of_source")).otherwise(0.0)
    offset = F.floor(hex_number(F.md5(F.concat(F.lit(seed + ":"), F.col("__source"))), 1, 8) * STEPS / SPREAD) / STEPS
    crossed = F.floor(F.col("__rate") * (F.col("__at") + 1) + F.col("__offset")) - F.floor(F.col("__rate") * F.col("__at") + F.col("__offset"))
    return (placed.withColumn("__rate", rate).withColumn("__offset", offset)
            .select("row", F.col("__size").alias("size"), F.col("__size_of_source").alias("source_size"),
                    F.col("__target").alias("target"), F.least(crossed, F.lit(limit)).cast("long").alias("copies")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row as often as it is taken, with the input's columns."""
    return (with_copies(docs, **options).filter(F.col("copies") > 0)
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*"))


def op7_source_mix(docs: DataFrame) -> DataFrame:
    """Size, target and taken words of every document."""
    sized = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("words")), "words")
    return with_copies(sized, text=None, size="words").select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
