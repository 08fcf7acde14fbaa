"""Repeatable pseudo-random labels from row keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_fold(key: Column, k: int) -> Column:
    """Fold 0..k-1 from the leading 32 bits of the key's MD5."""
    leading = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.pmod(leading, F.lit(k)).cast("int")


def seeded_order(seed: str, columns) -> Column:
    """A shuffled but repeatable sort key over whole rows."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c) for c in columns]))
