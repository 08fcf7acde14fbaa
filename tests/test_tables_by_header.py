import pytest

from beatgrid.functions import classes
from beatgrid.operators import geometry, regression
from beatgrid.sources.files import kind_of
from beatgrid.sources.tables import read_named
from pyspark.sql import functions as F

COUNTS = {"LAD_name": ("district", "string"), "Year": ("year", "int"), "count": ("count", "bigint")}


def test_an_index_column_without_header_is_ignored(spark, tmp_path):
    (tmp_path / "c.csv").write_text(',Year,LAD_name,count\n0,2011,"a""b,c",3\n1,x,d,\n')
    rows = read_named(spark, str(tmp_path), COUNTS).collect()
    assert [tuple(r) for r in rows] == [('a"b,c', 2011, 3), ("d", None, None)]


def test_an_absent_header_is_an_error(spark, tmp_path):
    (tmp_path / "c.csv").write_text("LAD_name,count\na,1\n")
    with pytest.raises(ValueError, match="Year"):
        read_named(spark, str(tmp_path), COUNTS)


def test_a_folder_does_not_decide_the_kind_of_another_file(spark):
    paths = ["a/x-street.csv/part-0.csv", "a/x-street.csv/notes.csv", "a/x-street.csv/y-outcomes.csv", "a/x-street.csv"]
    found = spark.createDataFrame([(p,) for p in paths], "path string").select(kind_of(F.col("path")).alias("kind"))
    assert [r.kind for r in found.collect()] == ["street", "unidentified", "outcomes", "street"]


def test_a_slot_below_the_palette_is_missing(spark):
    df = spark.createDataFrame([(-100.0,), (-0.5,), (0.5,), (None,)], "x double")
    found = [r[0] for r in df.select(classes.by_equal_width(F.col("x"), ["a", "b"], 0.5, 0.0, "none")).collect()]
    assert found == ["none", "b", "b", "none"]


def test_pieces_are_counted_from_the_first_vertex(spark):
    rows = [(1, "s", q, 0.0, 0.0) for q in range(99_998, 100_002)]
    rings = geometry.assemble_rings(spark.createDataFrame(rows, "shape_id long, name string, seq long, lat double, lon double"))
    assert [(r.piece, r.seqs) for r in rings.collect()] == [(0, [99_998, 99_999, 100_000, 100_001])]


def test_incomplete_rows_stay_without_a_group(spark):
    rows = [(float(i % 5) * 10, float(i)) for i in range(40)] + [(None, 1.0)]
    found = regression.cluster(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], k=3).collect()
    assert len(found) == 41 and [r.cluster for r in found if r.a is None] == [None]
