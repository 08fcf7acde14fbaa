"""Boundary, lookup, class and layer queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.functions import grid
from beatgrid.operators import geometry, joins, layers
from beatgrid.plans import mapping as plan
from beatgrid.sources.tables import clean_rate_table
from beatgrid.vocabulary import (
    COUNT_BAND_COLOURS,
    CYCLE_COLOURS,
    EQUAL_WIDTH_COLOURS,
    FIXED_BAND_COLOURS,
    RATE_BAND_COLOURS,
)
from workload import views as v
from workload.view_sql import sql_list, with_views

YEARS = v.YEARS
#: Short, so that every shape of eight vertices crosses it.
PIECE_SPAN = 5


def _degrees(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in ("lat", "lon")})


def _rates(spark: SparkSession, sf: str) -> DataFrame:
    return clean_rate_table(v.rates_raw(spark, sf))


def _values(spark: SparkSession, sf: str) -> DataFrame:
    return plan.yearly_values(
        v.boundary(spark, sf), _rates(spark, sf), v.district_counts(spark, sf), YEARS)


def reproject_grid(spark: SparkSession, sf: str) -> DataFrame:
    points = grid.reproject(v.boundary(spark, sf))
    return _degrees(points).select("shape_id", "seq", "lat", "lon")


def polygon_assemble(spark: SparkSession, sf: str) -> DataFrame:
    rings = geometry.rings_from_grid(v.boundary(spark, sf), PIECE_SPAN)
    return _degrees(geometry.flatten_rings(rings))


def map_layer_cycle(spark: SparkSession, sf: str) -> DataFrame:
    shapes = geometry.shapes_of(v.boundary(spark, sf))
    names = geometry.distinct_names(shapes).scalar()
    return geometry.cycle_colours(shapes).withColumn("names", names)


def first_match_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Several years per district: the earliest one is found first."""
    shapes = geometry.shapes_of(v.boundary(spark, sf))
    rates = _rates(spark, sf).withColumnRenamed("district", "name")
    return joins.first_match(shapes, rates, ["name"], ["rate", "population"], ["year"])


def classify_crime_half_sd(spark: SparkSession, sf: str) -> DataFrame:
    shapes = geometry.shapes_of(v.boundary(spark, sf))
    counts = v.district_counts(spark, sf).withColumnRenamed("district", "name")
    found = joins.first_match(shapes, counts, ["name"], ["count"], ["year"])
    return layers.classify_counts_half_sd(found, "count")


def _summed_up(layer: DataFrame, *columns: str) -> DataFrame:
    """Ring arrays as their size and first vertex, for flat comparison."""
    return layer.select(
        "shape_id", "name", "piece", *columns,
        F.size("lats").alias("points"),
        F.round(F.col("lats")[0], 6).alias("first_lat"),
        F.round(F.col("longs")[0], 6).alias("first_lon"),
    )


def map_layer_by_year(spark: SparkSession, sf: str) -> DataFrame:
    layer = plan.yearly_layer(
        v.boundary(spark, sf), _rates(spark, sf), v.district_counts(spark, sf), YEARS,
        piece_span=PIECE_SPAN)
    return _summed_up(layer, "year", "color", "rate", "count")


def map_layer_clusters(spark: SparkSession, sf: str) -> DataFrame:
    layer = plan.cluster_layer(v.boundary(spark, sf), v.clusters(spark, sf), PIECE_SPAN)
    return _summed_up(layer, "color", "rate", "crime", "cluster")


def pooled_mean_sd(spark: SparkSession, sf: str) -> DataFrame:
    stats = layers.mean_sd(_values(spark, sf), "rate", "year")
    return stats.select(*[F.round(c, 8).alias(c) for c in ("mean", "sd")])


QUERIES = {
    "reproject_grid": reproject_grid,
    "polygon_assemble": polygon_assemble,
    "map_layer_cycle": map_layer_cycle,
    "first_match_lookup": first_match_lookup,
    "pooled_mean_sd": pooled_mean_sd,
    "rate_min_max_year": lambda s, d: layers.min_max_by(_rates(s, d), "rate", "year"),
    "classify_rate_pooled_sd": lambda s, d: plan.classify_pooled(_values(s, d)),
    "classify_crime_half_sd": classify_crime_half_sd,
    "classify_rate_fixed": lambda s, d: layers.classify_by_breaks(_values(s, d), "rate"),
    "classify_equal_width": lambda s, d: layers.classify_equal_width(_values(s, d), "rate"),
    "map_layer_by_year": map_layer_by_year,
    "map_layer_clusters": map_layer_clusters,
}

# The oracle finds both latitudes by iteration, not by series.
_A, _B, _F0 = 6377563.396, 6356256.909, 0.9996012717
_WA, _WB = 6378137.0, 6356752.314245
_STEPS = 8


def _arc(phi: str) -> str:
    """Meridian arc from the equator on the first ellipsoid."""
    n = (_A - _B) / (_A + _B)
    scale = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    terms = (-(3 * n / 2 - 9 * n**3 / 16), 15 * n**2 / 16 - 15 * n**4 / 32,
             -35 * n**3 / 48, 315 * n**4 / 512)
    series = " + ".join(f"({t!r}) * sin({2 * (i + 1)} * {phi})" for i, t in enumerate(terms))
    return f"{scale!r} * ({phi} + {series})"


def _grid_steps() -> dict[str, str]:
    e2, we2 = 1 - (_B / _A) ** 2, 1 - (_WB / _WA) ** 2
    steps = {"g0": f"SELECT *, {_arc('radians(49.0)')} + (y + 100000.0) / {_F0} AS arc, "
                   f"radians(49.0) AS p FROM boundary"}
    for i in range(_STEPS):
        steps[f"g{i + 1}"] = f"SELECT * REPLACE (p + (arc - {_arc('p')}) / {_A} AS p) FROM g{i}"
    steps["h1"] = f"""SELECT *, x - 400000.0 AS de, tan(p) AS t,
        {_A * _F0!r} / sqrt(1 - {e2!r} * sin(p) ** 2) AS nu,
        {_A * _F0 * (1 - e2)!r} / (1 - {e2!r} * sin(p) ** 2) ** 1.5 AS rho FROM g{_STEPS}"""
    steps["h2"] = """SELECT *,
        p - de**2 * t / (2 * rho * nu)
          + de**4 * t / (24 * rho * nu**3) * (5 + 3 * t**2 + (nu / rho - 1) - 9 * t**2 * (nu / rho - 1))
          - de**6 * t / (720 * rho * nu**5) * (61 + 90 * t**2 + 45 * t**4) AS fa,
        radians(-2.0) + de / (cos(p) * nu) - de**3 / (cos(p) * 6 * nu**3) * (nu / rho + 2 * t**2)
          + de**5 / (cos(p) * 120 * nu**5) * (5 + 28 * t**2 + 24 * t**4)
          - de**7 / (cos(p) * 5040 * nu**7) * (61 + 662 * t**2 + 1320 * t**4 + 720 * t**6) AS la FROM h1"""
    steps["h3"] = f"SELECT *, {_A} / sqrt(1 - {e2!r} * sin(fa) ** 2) AS na FROM h2"
    steps["h4"] = f"""SELECT *, na * cos(fa) * cos(la) AS xa, na * cos(fa) * sin(la) AS ya,
        na * {1 - e2!r} * sin(fa) AS za FROM h3"""
    rx, ry, rz = (f"radians({r} / 3600.0)" for r in (0.1502, 0.2470, 0.8421))
    s = 1 - 20.4894e-6
    steps["h5"] = f"""SELECT *, {s!r} * xa - {rz} * ya + {ry} * za + 446.448 AS xw,
        {rz} * xa + {s!r} * ya - {rx} * za - 125.157 AS yw,
        {s!r} * za - {ry} * xa + {rx} * ya + 542.060 AS zw FROM h4"""
    steps["k0"] = "SELECT *, atan2(zw, sqrt(xw**2 + yw**2)) AS fw FROM h5"
    for i in range(_STEPS):
        steps[f"k{i + 1}"] = f"""SELECT * REPLACE (atan2(zw + {we2!r} * {_WA} / sqrt(1 - {we2!r}
            * sin(fw) ** 2) * sin(fw), sqrt(xw**2 + yw**2)) AS fw) FROM k{i}"""
    steps["located"] = f"""SELECT shape_id, name, seq, round(degrees(fw), 6) AS lat,
        round(degrees(atan2(yw, xw)), 6) AS lon FROM k{_STEPS}"""
    return steps


_YEARLY = {
    "yearly": f"""
        SELECT shape_id, name, CAST(y.year AS INTEGER) AS year, r.rate, c."count"
        FROM shapes CROSS JOIN range({YEARS[0]}, {YEARS[-1] + 1}) y(year)
             LEFT JOIN rates r ON r.district = name AND r.year = y.year
             LEFT JOIN dcounts c ON c.district = name AND c.year = y.year""",
    "pooled": """
        SELECT avg(m) AS mean, avg(s) AS sd
        FROM (SELECT avg(rate) AS m, stddev_pop(rate) AS s FROM yearly GROUP BY year)""",
}


def _bands(value: str, low: str, mid: str, high: str, colours) -> str:
    c = [f"'{x}'" for x in colours]
    return (f"CASE WHEN {value} IS NULL THEN 'black' WHEN {value} < {low} THEN {c[0]} "
            f"WHEN {value} < {mid} THEN {c[1]} WHEN {value} < {high} THEN {c[2]} ELSE {c[3]} END AS color")


_POOLED_COLOUR = _bands("rate", "mean - sd", "mean", "mean + sd", RATE_BAND_COLOURS)
_RING = {
    "pieces": f"""
        SELECT *, CAST((seq - min(seq) OVER (PARTITION BY shape_id)) // {PIECE_SPAN} AS BIGINT) AS piece
        FROM located""",
    "ringed": """
        SELECT shape_id, piece, CAST(count(*) AS INTEGER) AS points, arg_min(lat, seq) AS first_lat,
               arg_min(lon, seq) AS first_lon
        FROM pieces GROUP BY shape_id, piece"""}
_LABELLED = " ".join(
    f"WHEN cluster = {i} THEN '{c}'" for i, c in enumerate(COUNT_BAND_COLOURS, start=1))

ORACLES = {
    "reproject_grid": with_views("boundary", "SELECT shape_id, seq, lat, lon FROM located", _grid_steps()),
    "polygon_assemble": with_views("boundary", "SELECT * FROM pieces", {**_grid_steps(), "pieces": _RING["pieces"]}),
    "map_layer_cycle": with_views("shapes", f"""
        SELECT shape_id, name, row_number() OVER (ORDER BY shape_id) - 1 AS position,
               ({sql_list(CYCLE_COLOURS)})[1 + (row_number() OVER (ORDER BY shape_id) - 1) % 6] AS color,
               (SELECT count(DISTINCT name) FROM shapes) AS names
        FROM shapes"""),
    "first_match_lookup": with_views("shapes rates", """
        SELECT shape_id, name, rate, population
        FROM shapes LEFT JOIN (SELECT district, arg_min(rate, year) AS rate,
                                      arg_min(population, year) AS population
                               FROM rates GROUP BY district) ON district = name"""),
    "pooled_mean_sd": with_views(
        "shapes rates dcounts", "SELECT round(mean, 8) AS mean, round(sd, 8) AS sd FROM pooled", _YEARLY),
    "rate_min_max_year": with_views("rates", """
        SELECT year, min(rate) AS min_rate, max(rate) AS max_rate FROM rates GROUP BY year"""),
    "classify_rate_pooled_sd": with_views(
        "shapes rates dcounts", f"SELECT yearly.*, {_POOLED_COLOUR} FROM yearly, pooled", _YEARLY),
    "classify_crime_half_sd": with_views(
        "shapes dcounts", f"SELECT found.*, {_bands('count', 'mean - sd / 2', 'mean', 'mean + sd / 2', COUNT_BAND_COLOURS)} "
        "FROM found, stats", {
            "found": """
                SELECT shape_id, name, "count"
                FROM shapes LEFT JOIN (SELECT district, arg_min("count", year) AS "count"
                                       FROM dcounts GROUP BY district) ON district = name""",
            "stats": 'SELECT avg("count") AS mean, stddev_pop("count") AS sd FROM found'}),
    "classify_rate_fixed": with_views(
        # The limits are mean and deviation in double arithmetic: 6.7 - 2.9 is not exactly 3.8.
        "shapes rates dcounts", "SELECT *, " + _bands(
            "rate", "6.7::DOUBLE - 2.9::DOUBLE", "6.7::DOUBLE", "6.7::DOUBLE + 2.9::DOUBLE",
            FIXED_BAND_COLOURS) + " FROM yearly", _YEARLY),
    "classify_equal_width": with_views("shapes rates dcounts", f"""
        SELECT *, CASE WHEN rate IS NULL THEN 'black' ELSE
               ({sql_list(EQUAL_WIDTH_COLOURS)})[1 + least(CAST(trunc(rate / 2.0 - 0.9) AS INTEGER), 7)]
               END AS color
        FROM yearly""", _YEARLY),
    "map_layer_by_year": with_views("shapes rates dcounts", f"""
        SELECT y.shape_id, y.name, piece, year, {_POOLED_COLOUR}, rate, "count", points, first_lat, first_lon
        FROM yearly y JOIN ringed USING (shape_id), pooled""", {**_YEARLY, **_grid_steps(), **_RING}),
    "map_layer_clusters": with_views("shapes clusters", f"""
        SELECT s.shape_id, s.name, piece, CASE WHEN cluster IS NULL THEN 'white' {_LABELLED} ELSE 'black' END AS color,
               rate, crime, cluster, points, first_lat, first_lon
        FROM shapes s LEFT JOIN clusters c ON c.district = s.name JOIN ringed r ON r.shape_id = s.shape_id""",
        {**_grid_steps(), **_RING}),
}
