"""Indicator columns and vocabulary checks."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.labels import flag, in_vocabulary, is_label


def indicators(df: DataFrame, column: str, vocabulary: Mapping[str, str]) -> DataFrame:
    """One 0/1 column per label. A label outside the vocabulary sets none."""
    return df.withColumns({
        slug: flag(is_label(column, label)) for label, slug in vocabulary.items()
    })


def interactions(df: DataFrame, column_a: str, vocabulary_a: Mapping[str, str],
                 column_b: str, vocabulary_b: Mapping[str, str]) -> DataFrame:
    """One 0/1 column per pair of labels, first vocabulary major.

    Per-row form, for few pairs. ``rollup.wide`` counts all pairs of large
    vocabularies without materialising a column per pair and row.
    """
    return df.withColumns({
        slug_a + slug_b: flag(is_label(column_a, a) & is_label(column_b, b))
        for a, slug_a in vocabulary_a.items()
        for b, slug_b in vocabulary_b.items()
    })


def labels_found(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct labels."""
    return df.select(column).distinct().orderBy(column)


def vocabulary_report(df: DataFrame, column: str, vocabulary: Mapping[str, str]) -> DataFrame:
    """Sorted distinct labels with their counts and whether they are known."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("known", in_vocabulary(column, vocabulary))
        .orderBy(column)
    )


def vocabulary_drift(df: DataFrame, column: str, vocabulary: Mapping[str, str]) -> DataFrame:
    """Labels outside the vocabulary."""
    return vocabulary_report(df, column, vocabulary).filter(~F.col("known")).select(column, "n")
