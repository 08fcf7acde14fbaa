"""File trees: first lines, mixed kinds in one scan, packing by bytes, file order; conflicts and the observed audit."""

import os
import random
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from beatgrid.operators import clean, joins, rollup
from beatgrid.plans import incidents
from beatgrid.schemas import RECORD_COLUMNS, STREET_ANALYSIS, text_schema
from beatgrid.sources import files, records
from beatgrid.sources.files import kind_of
from beatgrid.vocabulary import HEADERS
from workload import intake


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write("".join(line + "\n" for line in lines))


def test_first_lines_of_long_short_and_blank_files(spark, tmp_path):
    for i in range(3):
        write(tmp_path / str(i), f"{i}-street.csv", [HEADERS["street"], *[f"{n},2015-01,a,b,1.0,2.0,c,d,e,f,g,h" for n in range(20_000)]])
    write(tmp_path, "short-outcomes.csv", ["only"])
    write(tmp_path, "blank-street.csv", ["", "x"])
    found = {os.path.basename(r["path"]): r["header"] for r in files.first_lines(spark, str(tmp_path)).collect()}
    assert len(found) == 5 and found["2-street.csv"] == HEADERS["street"] and found["short-outcomes.csv"] == "only" and found["blank-street.csv"] == ""
    checked = {os.path.basename(r["path"]): r["ok"] for r in files.validate_headers(spark, str(tmp_path)).collect()}
    assert {name for name, ok in checked.items() if not ok} == {"short-outcomes.csv", "blank-street.csv"}


def test_tree_of_all_kinds(spark, tmp_path):
    street = ['id1,2015-01,F,F,1.0,2.0,"On ""High"" Road, North",E1,Area 1,Burglary,,', ",2015-01,F,F,,,x,,,Drugs,Done,ctx"]
    search = ["Person search,2015-01-02T10:00:00,False,,51.5,-0.1,Male,18-24,a,b,Act,,Nothing,,False"]
    write(tmp_path / "2015-01", "2015-01-avon-and-somerset-street.csv", [HEADERS["street"], *street])
    write(tmp_path / "2015-01", "2015-01-city-stop-and-search.csv", [HEADERS["stop-and-search"], *search])
    write(tmp_path / "2015-02", "2015-02-city-outcomes.csv", [HEADERS["outcomes"], "id1,2015-02,F,F,1.0,2.0,x,E1,Area 1,Charged", "short,row"])
    write(tmp_path / "2015-02", "2015-02-city-notes.csv", [HEADERS["outcomes"], "anything at all"])
    write(tmp_path / "2015-02", "readme.csv", ["one", "two"])
    tree = records.read_tree(spark, str(tmp_path)).cache()
    assert sorted((r["kind"], r["month"], r["force"]) for r in tree.collect() if r["force"]) == [
        ("outcomes", "2015-02", "city"), ("outcomes", "2015-02", "city"), ("stop-and-search", "2015-01", "city"),
        ("street", "2015-01", "avon-and-somerset"), ("street", "2015-01", "avon-and-somerset")]
    assert sorted(r["line"] for r in tree.filter("kind = 'unidentified'").collect()) == ["anything at all", "one", "two"]
    for kind in HEADERS:
        plain = records.read_records(spark, records.kind_glob(str(tmp_path), kind), kind)
        got = records.of_kind(tree, kind)
        assert got.columns == list(RECORD_COLUMNS[kind])
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert tree.filter("street IS NOT NULL AND kind <> 'street'").count() == 0


@pytest.mark.parametrize("target", [2_000, 20_000, 10 ** 9])
def test_compaction_by_bytes(spark, tmp_path, target):
    rng = random.Random(1)
    row = lambda m, n: f"{m}-{n},{m},F,F,1.0,2.0,x,E{n},Area {n},Charged"
    months, total = {"2015-01": 60, "2015-02": 2, "2015-03": 1}, 0
    for month, count in months.items():
        for i in range(count):
            lines = [HEADERS["outcomes"], *[row(month, f"{i}.{n}") for n in range(rng.randint(1, 30))]]
            total += len(lines) - 1
            write(tmp_path / "in" / month, f"{month}-force{i}-outcomes.csv", lines)
    write(tmp_path / "in" / "2015-01", "2015-01-force0-street.csv", [HEADERS["street"]])
    out = str(tmp_path / "out")
    records.compact_by_bytes(spark, str(tmp_path / "in"), "outcomes", out, target)
    rows = spark.read.parquet(out)
    assert rows.count() == total and rows.select("crime_id").distinct().count() == total
    sizes = {m: sum(f.stat().st_size for f in (tmp_path / "in" / m).glob("*outcomes.csv")) for m in months}
    for month in months:
        written = list((tmp_path / "out" / f"month={month}").glob("*.parquet"))
        assert len(written) <= -(-sizes[month] // target)
        longest = max(f.stat().st_size for f in (tmp_path / "in" / month).glob("*outcomes.csv"))
        for f in written:
            read = spark.read.parquet(str(f)).count()
            assert read * 40 <= target + longest + 40


def test_long_files_are_packed_by_block(spark, tmp_path):
    write(tmp_path / "in" / "2015-01", "2015-01-a-outcomes.csv", [HEADERS["outcomes"], *[f"{n},2015-01,F,F,1.0,2.0,x,E,Area,Charged" for n in range(20_000)]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        records.compact_by_bytes(spark, str(tmp_path / "in"), "outcomes", str(tmp_path / "out"), 200_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert spark.read.parquet(str(tmp_path / "out")).select("crime_id").distinct().count() == 20_000
    assert len(list((tmp_path / "out" / "month=2015-01").glob("*.parquet"))) == 5


def test_first_match_in_file_order(spark, tmp_path):
    rng = random.Random(5)
    expected, n = {}, 0
    for part in ("a", "b", "c"):
        lines = ["name,value"]
        for _ in range(3000):
            name = f"N{rng.randrange(200)}"
            lines.append(f"{name},{(n * 7919) % 100_003}")
            expected.setdefault(name, str((n * 7919) % 100_003))
            n += 1
        write(tmp_path, f"{part}.csv", lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = records.read_text_table(spark, str(tmp_path), text_schema(["name", "value"]), with_place=True)
        placed = rows.withColumn("_order", records.file_order())
        got = joins.first_rows(placed, ["name"], ["value"], ["_order"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r["name"]: r["value"] for r in got} == expected


def test_conflicts_of_a_crosswalk(spark):
    schema = "small_code string, small_name string, mid_code string, mid_name string, district_code string, district_name string"
    rows = [("A", "a", "M1", "m", "D1", "d")] * 3 + [("A", "a", "M2", "m", "D1", "d"), ("B", "b", "M1", "m", "D1", "d"), ("A", "other", "M9", "m", "D1", "d"),
            ("C", "c", None, None, "D1", "d"), ("C", "c", None, None, "D1", "d"), ("C", "c", "M1", "m", "D1", "d")]
    found = rollup.crosswalk_conflicts(spark.createDataFrame(rows, schema)).select("small_code", "mid_code", "n_rows", "n_parents", "used").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("A", "M1", 3, 2, True), ("A", "M2", 1, 2, False), ("C", None, 2, 2, True), ("C", "M1", 1, 2, False)], key=str)
    assert rollup.crosswalk_conflicts(spark.createDataFrame(rows[:3], schema)).collect() == []


def test_audit_while_cleaning(spark, tmp_path):
    rng = random.Random(7)
    pick = lambda *v: rng.choice(v)
    rows = [tuple(pick("", "1", "2", "3") if c == "crime_id" else pick("", "x", "y") for c in RECORD_COLUMNS["street"]) for _ in range(400)]
    raw = spark.createDataFrame(rows, text_schema(RECORD_COLUMNS["street"])).repartition(4)
    seen = incidents.clean_street_observed(raw, str(tmp_path / "clean")).collect()
    assert seen == incidents.street_audit(raw).collect()
    written = spark.read.parquet(str(tmp_path / "clean")).select(*STREET_ANALYSIS)
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, incidents.clean_street(raw).collect()))
    assert written.count() == seen[0]["locatable"]


def test_path_patterns_do_not_start_anew_at_every_character(spark):
    """A long folder name costs a search without an anchor the square of its length, for every line of a file."""
    paths = ["/in/" + "x" * 60_000 + "/2020-01-north-notes.csv", "a-street.csv", "/b/2020-01-c-street.csv/folder=1/part-0.csv",
             "/s-street.csv/other.csv", "/d-outcomes.csv/part-1", "/e-outcomes.csv/sub/part-1", "line\nbreak-street.csv"]
    start = time.monotonic()
    found = spark.createDataFrame([(p,) for p in paths * 20], "path string").select("path", kind_of(F.col("path")).alias("kind")).distinct().collect()
    assert time.monotonic() - start < 20
    assert {r["path"]: r["kind"] for r in found} == dict(zip(paths, [
        "unidentified", "street", "street", "unidentified", "outcomes", "unidentified", "street"]))


def tree_tables(spark, folder, n=200):
    """Items and orders with missing values, some locations under both forces and some rows twice."""
    spark.range(n).selectExpr(
        "IF(id % 31 = 0, NULL, id % 350) AS l_orderkey", "IF(id % 23 = 0, NULL, id % 9) AS l_partkey", "IF(id % 29 = 0, NULL, id % 45) AS l_suppkey",
        "'A' AS l_returnflag", "IF(id % 7 = 0, NULL, 'O') AS l_linestatus",
        "IF(id % 37 = 0, NULL, timestamp_seconds(820000000 + id * 200000)) AS l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    spark.range(n).selectExpr(
        "IF(id % 31 = 0, NULL, id % 350) AS o_orderkey", "IF(id % 29 = 0, NULL, id % 45) AS o_custkey", "'F' AS o_orderstatus",
        "IF(id % 37 = 0, NULL, timestamp_seconds(820000000 + id * 200000)) AS o_orderdate",
        "IF(id % 3 = 0, NULL, '1-URGENT') AS o_orderpriority").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_rows_of_a_tree_are_moved_before_they_are_text(spark, tmp_path, monkeypatch):
    """Shuffled as text, the rows take as much disk a second time."""
    plans = []
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, *a, f=DataFrameWriter.csv, **b: plans.append(
        self._df._jdf.queryExecution().optimizedPlan().toString()) or f(self, *a, **b))
    intake._record_tree(spark, tree_tables(spark, tmp_path))
    assert len(plans) == 4
    for plan in plans:
        above, below = plan.split("RepartitionByExpression")
        text = "Act 1984" if "o_orderkey" in plan else "Road"
        assert text in above and text not in below and "Sort [_m" in above


def test_one_file_for_each_name_in_a_tree(spark, tmp_path):
    root = intake._record_tree(spark, tree_tables(spark, tmp_path)).removeprefix("file:")
    found = sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if f.endswith(".csv"))
    folders = {os.path.dirname(f) for f in found}
    assert len(folders) > 10
    undated = {f.rsplit("/", 1)[1] for f in found if f.startswith("__HIVE_DEFAULT_PARTITION__/")}
    assert {"street.csv", "outcomes.csv", "stop-and-search.csv", "force-1-street.csv", "force-1-outcomes.csv", "force-0-stop-and-search.csv"} <= undated
    rows = spark.read.parquet(f"{tmp_path}/lineitem.parquet").count()
    street = [f for f in found if f.endswith("street.csv")]
    assert sum(sum(1 for _ in open(os.path.join(root, f), encoding="utf-8")) - 1 for f in street) == rows


def shuffle_files(spark):
    names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {names.apply(i).getName() for i in range(names.size()) if names.apply(i).getName().endswith(".data")}


def test_shuffles_of_written_files_do_not_stay(spark, tmp_path):
    folder = tree_tables(spark, tmp_path)
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffle_files(spark)
    setting = spark.conf.get(key, None)
    intake._record_tree(spark, folder)
    end = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < end:
        time.sleep(0.2)
    assert shuffle_files(spark) - before == set()
    assert spark.conf.get(key, None) == setting


def test_counts_of_a_mixed_tree(spark, tmp_path):
    """Against plain counts of the lines of the files; no sort and no copy of a line for every distinct count."""
    counted = intake.mixed_tree(spark, tree_tables(spark, tmp_path))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    scan = plan[:plan.index("FileScan text")].rsplit("Exchange", 1)[1]
    assert "SortAggregate" not in scan and "Sort [" not in scan
    tree = records.read_tree(spark, counted.inputFiles()[0].rsplit("/", 2)[0]).collect()
    want = {}
    for r in tree:
        name = r["path"].rsplit("/", 1)[1]
        w = want.setdefault((r["kind"], name[:7]), dict(files=set(), rows=0, forces=set(), ids=0, locations=set(), objects=0, stated=set()))
        w["files"].add(name)
        w["rows"] += 1
        w["forces"] |= {r["force"]} - {None}
        street, outcomes, search = r["street"], r["outcomes"], r["stop_and_search"]
        w["ids"] += any(s is not None and s["crime_id"] is not None for s in (street, outcomes))
        if street is not None:
            w["locations"] |= {street["location"]} - {None}
        if search is not None:
            w["objects"] += search["object_of_search"] is not None
            w["stated"] |= {search["self_defined_ethnicity"]} - {None}
    assert {tuple(r) for r in counted.collect()} == {
        (*k, len(w["files"]), w["rows"], len(w["forces"]), w["ids"], len(w["locations"]), w["objects"], max(w["stated"], default=None))
        for k, w in want.items()}
    assert any(len(w["forces"]) == 2 for w in want.values())


def test_names_by_the_short_way_are_those_of_the_pattern(spark):
    paths = ["/in/2020-01-a-street.csv", "a.csv", ".csv", "/.csv", "/b.csv/part-0.csv", "/c-street.csv/k=1/part-0", "/d.csv/e.csv/f", "/g.txt", "", "h.csv\n",
             "/i.csvx/j-outcomes.csv", "/\u00e4\u00f6 k.csv", "/l.csv/", None]
    pattern = F.regexp_extract("path", r"(?:^|/)([^/]*)\.csv(?:/[^/]*)*$", 1)
    for r in spark.createDataFrame([(p,) for p in paths], "path string").select("path", files.record_name(F.col("path")).alias("got"), pattern.alias("want")).collect():
        assert r["got"] == r["want"], r["path"]
    kinds = ("search", "stop-and-search", "street")
    found = spark.createDataFrame([("x-stop-and-search.csv",), ("x-street.csv/part-search.csv",)], "path string").select(kind_of(F.col("path"), kinds)).collect()
    assert [r[0] for r in found] == ["search", "search"]


def test_blank_fields_of_a_tree_are_missing(spark, tmp_path):
    write(tmp_path / "2015-01", "2015-01-a-street.csv", [HEADERS["street"], 'id1,,"", ,"a ""b"", c",,"",Null', "", '""'])
    tree = records.read_tree(spark, str(tmp_path))
    rows = {r["line"]: r["street"] for r in tree.collect()}
    assert tuple(rows['id1,,"", ,"a ""b"", c",,"",Null']) == ("id1", None, None, " ", 'a "b", c', None, None, "Null", None, None, None, None)
    assert tuple(rows[""]) == tuple(rows['""']) == (None,) * len(RECORD_COLUMNS["street"])
