"""Expressions over a label vocabulary: a mapping of label to slug.

The label ``""`` in a vocabulary stands for a missing value.
"""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from beatgrid.functions.text import is_blank


def is_label(name: str, label: str) -> Column:
    return is_blank(name) if label == "" else F.col(name) == label


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def label_index(name: str, vocabulary: Mapping[str, str]) -> Column:
    """Position in the vocabulary; its length for any label outside it."""
    chain = None
    for position, label in enumerate(vocabulary):
        test = is_label(name, label)
        chain = F.when(test, position) if chain is None else chain.when(test, position)
    return chain.otherwise(len(vocabulary))


def in_vocabulary(name: str, vocabulary: Mapping[str, str]) -> Column:
    named = [label for label in vocabulary if label]
    known = F.coalesce(F.col(name).isin(named), F.lit(False))
    return known | is_blank(name) if "" in vocabulary else known
