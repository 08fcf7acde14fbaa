"""Boundary rings from vertex tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.classes import by_cycle
from beatgrid.functions.grid import reproject
from beatgrid.operators.ranking import global_index
from beatgrid.vocabulary import CYCLE_COLOURS

PIECE_SPAN = 100_000


def assemble_rings(vertices: DataFrame, piece_span: int = PIECE_SPAN) -> DataFrame:
    """Vertices ``(shape_id, name, seq, lat, lon)`` to ordered arrays.

    A row holds the vertices of one run of ``piece_span`` sequence numbers, counted
    from the shape's smallest, so its arrays have a bounded length. Rows are always
    keyed by shape and piece; pieces in order, end to end, are the whole ring.
    """
    starts = vertices.groupBy("shape_id").agg(F.min("seq").alias("_start"))
    piece = F.floor((F.col("seq") - F.col("_start")) / F.lit(piece_span)).cast("bigint")
    first = F.struct("seq", "lat", "lon")
    return (
        vertices.join(starts, "shape_id").groupBy("shape_id", "name", piece.alias("piece"))
        .agg(F.array_sort(F.collect_list(first)).alias("_ring"))
        .select(
            "shape_id", "name", "piece",
            F.col("_ring")["seq"].alias("seqs"),
            F.col("_ring")["lat"].alias("lats"),
            F.col("_ring")["lon"].alias("longs"),
        )
    )


def rings_from_grid(vertices: DataFrame, piece_span: int = PIECE_SPAN) -> DataFrame:
    """Grid vertices ``(shape_id, name, seq, x, y)`` to rings in degrees."""
    return assemble_rings(reproject(vertices, "x", "y"), piece_span)


def flatten_rings(rings: DataFrame) -> DataFrame:
    """Back to one row per vertex."""
    points = F.explode(F.arrays_zip("seqs", "lats", "longs")).alias("_p")
    return rings.select("shape_id", "name", "piece", points).select(
        "shape_id", "name", "piece",
        F.col("_p")["seqs"].alias("seq"),
        F.col("_p")["lats"].alias("lat"),
        F.col("_p")["longs"].alias("lon"),
    )


def shapes_of(vertices: DataFrame) -> DataFrame:
    return vertices.select("shape_id", "name").distinct()


def cycle_colours(shapes: DataFrame, colours=CYCLE_COLOURS) -> DataFrame:
    """The i-th shape by id takes colour i modulo the palette size."""
    indexed = global_index(shapes, "shape_id", "position")
    return indexed.withColumn("color", by_cycle(F.col("position"), colours))


def distinct_names(shapes: DataFrame) -> DataFrame:
    return shapes.agg(F.countDistinct("name").alias("names"))
