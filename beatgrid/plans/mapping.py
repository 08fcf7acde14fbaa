"""Boundaries, rates and counts to classified layers."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from beatgrid.operators.geometry import PIECE_SPAN, rings_from_grid, shapes_of
from beatgrid.operators.joins import first_match
from beatgrid.operators.layers import (
    classify_by_mean_sd,
    classify_clusters,
    map_layer,
    named_values,
    over_years,
)


def yearly_values(vertices: DataFrame, rates: DataFrame, counts: DataFrame,
                  years: Sequence[int], order_by: Sequence[str] = ()) -> DataFrame:
    """Rate and count per shape and year, the first by ``order_by``; missing where a district has none."""
    shapes = over_years(shapes_of(vertices), years)
    as_name = lambda df: df.withColumnRenamed("district", "name")
    return named_values(shapes, as_name(rates), as_name(counts), ["name", "year"], order_by=order_by)


def classify_pooled(values: DataFrame) -> DataFrame:
    return classify_by_mean_sd(values, "rate", pooled_by="year")


def yearly_layer(vertices: DataFrame, rates: DataFrame, counts: DataFrame, years: Sequence[int],
                 classify: Callable[[DataFrame], DataFrame] = classify_pooled,
                 order_by: Sequence[str] = (), piece_span: int = PIECE_SPAN) -> DataFrame:
    """One table for all years: shape, ring piece, colour, rate, count."""
    values = classify(yearly_values(vertices, rates, counts, years, order_by))
    return map_layer(rings_from_grid(vertices, piece_span), values)


def cluster_values(vertices: DataFrame, clusters: DataFrame) -> DataFrame:
    """Cluster colour per shape; shapes without a label are marked missing."""
    labelled = first_match(
        shapes_of(vertices), clusters.withColumnRenamed("district", "name"),
        ["name"], ["rate", "crime", "cluster"], ["cluster"])
    return classify_clusters(labelled)


def cluster_layer(vertices: DataFrame, clusters: DataFrame, piece_span: int = PIECE_SPAN) -> DataFrame:
    return map_layer(rings_from_grid(vertices, piece_span), cluster_values(vertices, clusters))
