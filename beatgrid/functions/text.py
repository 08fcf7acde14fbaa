"""Blank handling and safe casts for text fields."""

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(name: str) -> Column:
    """True for NULL and for the empty string: both mean *missing*."""
    return F.col(name).isNull() | (F.col(name) == "")


def is_filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def all_filled(names) -> Column:
    return reduce(and_, (is_filled(name) for name in names))


def all_blank(names) -> Column:
    return reduce(and_, (is_blank(name) for name in names))


def null_if_blank(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def to_double(name: str) -> Column:
    """Number, or NULL for text that is none. Never raises, also in ANSI mode."""
    return F.col(name).try_cast("double")


def is_number(name: str) -> Column:
    return F.col(name).isNotNull() & ~F.isnan(name)


def year_of(month: str = "month") -> Column:
    """The ``yyyy`` of a ``yyyy-MM`` text."""
    return F.substring(F.col(month), 1, 4)


def quoted(name: str) -> Column:
    """Column by literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")
