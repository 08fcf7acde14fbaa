"""Connected components of an edge table by star contraction, as joins and aggregates.

Each round points every neighbour of a node at the node's smallest neighbour: first
the larger ones, then the smaller ones. Edges never become more, and the rounds end
when each node is joined to the smallest of its component alone. A node with very
many neighbours is reduced by a partial aggregate, and the join of edges to the
reduced side is one that adaptive execution can split. Rounds are cut by written tables.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.sources.staging import materialise


def _oriented(edges: DataFrame) -> DataFrame:
    return (edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _contract(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = _oriented(large)
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return _oriented(small)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for all nodes but the smallest of each component, which is its name.

    ``edges`` has long columns ``u`` and ``v``; loops and repeats are allowed, no edges give no rows.
    """
    now = materialise(_oriented(edges), "edges")
    state = _state(now)
    while state[0]:
        following = materialise(_contract(now), "edges")
        next_state = _state(following)
        now, same, state = following, next_state == state, next_state
        if same:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
