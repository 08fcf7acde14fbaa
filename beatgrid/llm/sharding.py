"""Sharding by rendezvous hashing of record keys over weighted shards.

Every shard draws a number from the key and its own name; the smallest of
``-ln(number) / weight`` wins. A shard's share follows its weight, and a new shard
takes rows only into itself, since the draws of the others stay as they are. The
slot in a shard is a gapless position, numbered without gathering a shard.

Defined cases: an absent key is the key ``null``; repeated keys go to one shard and
get slots of their own; an absent text counts as empty; an empty table gives no
rows; all columns of the input, whatever their names, stay as they are in ``row``.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import hex_number, id_key
from beatgrid.llm.positions import with_positions

SHARDS = 16


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The winning shard of a text key; ``weights`` by shard name."""
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("every shard needs a positive weight")
    draws = []
    for shard, weight in sorted(weights.items()):
        number = (hex_number(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 12) + 0.5) / float(1 << 48)
        draws.append(F.struct((-F.ln(number) / weight).alias("draw"), F.lit(shard).alias("shard")))
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def shard_rows(docs: DataFrame, weights: Mapping[int, float], id_column: str = "doc_id",
               order: Sequence[str] = ()) -> DataFrame:
    """Each row packed in ``row``, with its ``shard`` and ``slot``; ``order`` breaks ties of slots."""
    key = id_key(id_column)
    light = docs.select(rendezvous(key, weights).alias("shard"), hex_number(F.md5(key), 1, 8).alias("__spread"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("__key"),
                       rendezvous(key, weights).alias("shard"), hex_number(F.md5(key), 1, 8).alias("__spread"))
    ties = [F.col("row").getField(c) for c in order]
    return with_positions(rows, light, ["shard"], "__spread", ["__spread", "__key", *ties], "slot").select("row", "shard", "slot")


def equal_weights(shards: int = SHARDS) -> dict[int, float]:
    return {i: 1.0 for i in range(shards)}


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All columns of the documents, then ``shard`` and ``slot`` (in place of columns of that name)."""
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    placed = shard_rows(docs, equal_weights(shards))
    return placed.select(*[F.col("row").getField(c).alias(c) for c in kept], "shard", "slot")


def op8_rendezvous_shards(docs: DataFrame) -> DataFrame:
    """Shard, slot and the shard among one more, of every document."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    measured = docs.select("doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard_rows(measured, equal_weights(), order=("text_crc32", "size"))
    return placed.select("row.*", F.lit("key").alias("law"), "shard", "slot",
                         rendezvous(id_key("row.doc_id"), equal_weights(SHARDS + 1)).alias("grown_shard"))
