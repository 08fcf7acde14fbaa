"""Map classes: numbers or categories to colours."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from beatgrid.vocabulary import MISSING_COLOUR


def by_breaks(value: Column, breaks, colours, missing: str = MISSING_COLOUR) -> Column:
    """Colour i for the first break above the value, the last colour beyond all."""
    chain = F.when(value.isNull() | F.isnan(value), missing)
    for limit, colour in zip(breaks, colours):
        chain = chain.when(value < limit, colour)
    return chain.otherwise(colours[-1])


def by_mean_sd(value: Column, mean: Column, sd: Column, colours, factor: float = 1.0,
               missing: str = MISSING_COLOUR) -> Column:
    half = sd * F.lit(float(factor))
    return by_breaks(value, (mean - half, mean, mean + half), colours, missing)


def by_equal_width(value: Column, colours, width: float, offset: float,
                   missing: str = MISSING_COLOUR) -> Column:
    """Truncated ``value / width - offset``, capped at the last colour.

    A slot further below zero than there are colours is missing.
    """
    slot = F.least((value / width - F.lit(offset)).try_cast("int"), F.lit(len(colours) - 1))
    palette = F.array(*[F.lit(c) for c in colours])
    # A negative index counts from the end of the palette.
    at = F.when(slot < 0, slot).otherwise(slot + 1)
    return F.when(value.isNull() | F.isnan(value), missing).otherwise(F.coalesce(F.try_element_at(palette, at), F.lit(missing)))


def by_category(value: Column, colours, other: str = MISSING_COLOUR,
                missing: str = MISSING_COLOUR) -> Column:
    """Categories 1..n take the n colours in turn."""
    chain = F.when(value.isNull(), missing)
    for category, colour in enumerate(colours, start=1):
        chain = chain.when(value == category, colour)
    return chain.otherwise(other)


def by_cycle(index: Column, colours) -> Column:
    palette = F.array(*[F.lit(c) for c in colours])
    return F.element_at(palette, (F.pmod(index, F.lit(len(colours))) + 1).cast("int"))
