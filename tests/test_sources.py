import pytest
from pyspark.sql import functions as F

from beatgrid.operators.counts import with_year, year_slice
from beatgrid.operators.rollup import crosswalk_distinct
from beatgrid.sources import files, records, staging, tables
from beatgrid.streaming.intake import compact_new_files, read_compacted
from beatgrid.vocabulary import CROSSWALK_HEADER, HEADERS, RATE_COLUMNS
from workload import views


def write(root, month, name, header, *lines):
    folder = root / month
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([*([header] if header else []), *lines]) + ("\n" if header else ""))


@pytest.fixture()
def root(tmp_path):
    street, outcomes, search = HEADERS["street"], HEADERS["outcomes"], HEADERS["stop-and-search"]
    write(tmp_path, "2015-12", "2015-12-north-street.csv", street,
          'a1,2015-12,North,North,-1.5,52.1,"On or near High St, 5",E01,"Ely 001A, part",Burglary,Local resolution,',
          ",2015-12,North,North,,,,,,Anti-social behaviour,,")
    write(tmp_path, "2016-01", "2016-01-north-street.csv", street,
          'b1,2016-01,North,North,-1.5,52.1,"5 ""A"" Rd",E01,Ely 001A,Drugs,"Investigation complete; no suspect identified",',
          "b2,2016-01,North,North,-1.5,52.1,Rd,E01,Ely 001A,Drugs,Local resolution,,extra")
    write(tmp_path, "2015-12", "2015-12-north-outcomes.csv", outcomes, "a1,2015-12,N,N,-1.5,52.1,Rd,E01,Ely,Fined")
    write(tmp_path, "2015-12", "2015-12-south-outcomes.csv", street, "a1,2015-12,N,N,-1.5,52.1,Rd,E01,Ely,Fined")
    write(tmp_path, "2015-12", "2015-12-north-stop-and-search.csv", search, "Person search,2015-12-01,,,52.1,-1.5,,,,,,,,,")
    write(tmp_path, "2016-01", "2016-01-north-stop-and-search.csv",
          search.replace("Latitude,Longitude", "Longitude,Latitude"), "Person search,2016-01-01,,,52.1,-1.5,,,,,,,,,")
    write(tmp_path, "2016-01", "2016-01-north-neighbourhood.csv", "whatever", "1")
    write(tmp_path, "2016-01", "2016-01-empty-street.csv", "")
    return tmp_path


def short(path):
    return path.rsplit("/", 1)[-1]


def test_files_are_listed_without_reading_them(spark, root):
    listed = files.list_files(spark, str(root))
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    kinds = {short(r["path"]): r["kind"] for r in files.classify_files(listed).collect()}
    assert kinds["2015-12-north-street.csv"] == "street"
    assert kinds["2015-12-north-stop-and-search.csv"] == "stop-and-search"
    assert kinds["2015-12-south-outcomes.csv"] == "outcomes"
    assert kinds["2016-01-north-neighbourhood.csv"] == files.UNIDENTIFIED
    assert len(kinds) == 7


def test_spark_written_folders_have_a_kind(spark):
    df = spark.createDataFrame(
        [("x/2015-12-a-street.csv/month=2015-12/part-0.csv",), ("x/street.csv/a-outcomes.csv",), ("x/main-street.txt",)],
        "path string")
    assert [r["kind"] for r in files.classify_files(df).collect()] == ["street", "outcomes", files.UNIDENTIFIED]


def test_header_offenders(spark, root):
    bad = {short(r["path"]): r["header"] for r in files.offenders(files.validate_headers(spark, str(root))).collect()}
    assert set(bad) == {
        "2015-12-south-outcomes.csv", "2016-01-north-stop-and-search.csv",
        "2016-01-north-neighbourhood.csv"}
    assert bad["2016-01-north-neighbourhood.csv"] == "whatever"


def test_quotes_commas_blanks_and_ragged_rows(spark, root):
    df = records.read_records(spark, records.kind_glob(str(root), "street"), "street", keep_corrupt=True)
    rows = {r["crime_id"]: r for r in df.collect()}
    assert rows["a1"]["location"] == "On or near High St, 5"
    assert rows["a1"]["area_name"] == "Ely 001A, part"
    assert rows["b1"]["location"] == '5 "A" Rd'
    assert rows[None]["area_code"] is None and rows[None]["crime_type"] == "Anti-social behaviour"
    assert rows["b2"]["outcome"] == "Local resolution" and rows["b2"][records.CORRUPT].endswith(",extra")
    assert rows["a1"][records.CORRUPT] is None


def test_stop_and_search_has_latitude_first(spark, root):
    path = str(root / "2015-12" / "2015-12-north-stop-and-search.csv")
    only = records.read_records(spark, path, "stop-and-search").first()
    assert (only["latitude"], only["longitude"]) == ("52.1", "-1.5")


def test_compact_partitions_by_month(spark, root, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("compact") / "street")
    df = records.read_records(spark, records.kind_glob(str(root), "street"), "street")
    records.compact(df, out)
    back = staging.read_stage(spark, out, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    one = back.filter("month = '2016-01'")
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 2


def test_a_year_slice_reads_only_its_months(spark, tmp_path):
    df = spark.createDataFrame(
        [("2014-12", "a"), ("2015-01", "b"), ("2015-02", "c"), ("2016-01", "d")], "month string, v string")
    records.compact(df, str(tmp_path / "t"))
    sliced = year_slice(with_year(staging.read_stage(spark, str(tmp_path / "t"), df.schema)), [2015])
    assert sorted(r["v"] for r in sliced.collect()) == ["b", "c"]
    read = sliced.select("v", F.input_file_name().alias("f")).collect()
    assert {r["f"].split("month=")[1][:7] for r in read} == {"2015-01", "2015-02"}
    text = sliced._jdf.queryExecution().executedPlan().toString()
    scan = text[text.index("PartitionFilters"):]
    assert "month" in scan[:scan.index("]")]


def test_a_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        df = spark.range(0, 100_000, 1, 8).selectExpr("CAST(uuid() AS STRING) AS v", "'2015-01' AS month")
        records.compact(df, str(tmp_path / "hot"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "hot" / "month=2015-01").glob("*.parquet"))) > 1


def test_new_files_are_added_once(spark, root, tmp_path_factory):
    base = tmp_path_factory.mktemp("stream")
    args = (str(root), "street", str(base / "out"), str(base / "checkpoint"))
    compact_new_files(spark, *args)
    assert read_compacted(spark, args[2], "street").count() == 4
    compact_new_files(spark, *args)
    assert read_compacted(spark, args[2], "street").count() == 4
    write(root, "2016-02", "2016-02-north-street.csv", HEADERS["street"], "c1,2016-02,N,N,1,2,Rd,E01,Ely,Drugs,,")
    compact_new_files(spark, *args)
    got = read_compacted(spark, args[2], "street")
    assert got.count() == 5 and got.filter("crime_id = 'c1'").first()["month"] == "2016-02"


def test_stage_keeps_types_and_text_months(spark, tmp_path):
    df = spark.createDataFrame([("2015-01", 1, 2.5), (None, None, None)], "month string, n bigint, x double")
    staging.write_stage(df, str(tmp_path / "s"), "month")
    back = staging.read_stage(spark, str(tmp_path / "s"), df.schema)
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_export_of_a_small_result_is_one_file(spark, tmp_path):
    df = spark.range(100).repartition(8).selectExpr("CONCAT('a,', id) AS district", "id AS count")
    staging.export_csv(df, str(tmp_path / "e"))
    parts = list((tmp_path / "e").glob("*.csv"))
    assert len(parts) == 1 and parts[0].read_text().splitlines()[0] == "district,count"
    assert staging.read_export(spark, str(tmp_path / "e"), df.schema).count() == 100


def test_crosswalk_file_to_one_row_per_small_area(spark, tmp_path):
    (tmp_path / "x.csv").write_text("\n".join([
        CROSSWALK_HEADER, "O1,E01,Ely 1A,M1,Ely 1,L1,Ely,", "O2,E01,Ely 1A,M1,Ely 1,L1,Ely,",
        CROSSWALK_HEADER, 'O3,E02,"Bath, North 2",M2,Bath 2,L2,"Bath, City of",']))
    rows = crosswalk_distinct(records.read_crosswalk(spark, str(tmp_path / "x.csv"))).orderBy("small_code").collect()
    assert [tuple(r) for r in rows] == [
        ("E01", "Ely 1A", "M1", "Ely 1", "L1", "Ely"),
        ("E02", "Bath, North 2", "M2", "Bath 2", "L2", "Bath, City of")]


def test_rate_table_file(spark, tmp_path):
    names = [*RATE_COLUMNS, "Conf interval", "Numerator - x"]
    lines = [",".join(f'"{n}"' for n in names)]
    for text in ("7.3", "!", "-", "~", "*", "#", "n/a", ""):
        lines.append(f'"Bristol, City of",2011,{text},100,0.1,1')
    lines.append("Column Total,2011,5.0,900,0.1,1")
    (tmp_path / "r.csv").write_text("\n".join(lines))
    raw = tables.read_wide_text(spark, str(tmp_path / "r.csv"))
    clean = tables.clean_rate_table(raw)
    assert clean.columns == ["district", "year", "rate", "population"]
    assert sorted((r["rate"] for r in clean.collect()), key=str) == [7.3, None, None]
    assert {r["district"] for r in clean.collect()} == {"Bristol, City of"}
    assert tables.normalise_names(raw).columns[2] == "Unemployment_rate___aged_16_64"


def test_skeleton_and_label_files(spark, tmp_path):
    (tmp_path / "k.csv").write_text('district,year\nAdur,2011\n"Bristol, City of",2012\n')
    rows = tables.read_table(spark, str(tmp_path / "k.csv"), tables.SKELETON_SCHEMA).collect()
    assert [tuple(r) for r in rows] == [("Adur", 2011), ("Bristol, City of", 2012)]
    (tmp_path / "c.csv").write_text("district,rate,crime,cluster\nAdur,5.5,10,2\nArun,6,11,\n")
    rows = tables.read_table(spark, str(tmp_path / "c.csv"), tables.CLUSTER_SCHEMA).collect()
    assert [tuple(r) for r in rows] == [("Adur", 5.5, 10.0, 2), ("Arun", 6.0, 11.0, None)]


def test_materialised_table_lives_in_the_named_folder(spark):
    df = staging.materialise(spark.range(3).select(F.col("id").alias("v")), "t")
    source = df.inputFiles()[0]
    assert staging.shared_folder(spark).removeprefix("file:") in source and "/beatgrid/t-" in source


def test_shared_folder_prefers_the_setting(monkeypatch, tmp_path):
    class Context:
        folder, master = None, "local[1]"

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, path):
            self.folder = path

    class Session:
        sparkContext = Context()

        class conf:
            value = None

            @classmethod
            def get(cls, key, default):
                return cls.value or default

    monkeypatch.setattr(staging.tempfile, "mkdtemp", lambda prefix: str(tmp_path / prefix))
    own = staging.shared_folder(Session)
    assert own == str(tmp_path / "run-") == staging.shared_folder(Session)
    Context.folder, Session.sparkContext.folder, Context.master = None, None, "spark://cluster"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session)
    Session.conf.value = "hdfs://cluster/checkpoints/"
    assert staging.scratch_path(Session, "x").startswith("hdfs://cluster/checkpoints/beatgrid/x-")


def test_export_keeps_quotes_and_commas(spark, tmp_path):
    rows = [('a"b,c', 2011, 3), ("plain", 2012, 4), ('"', 2013, None)]
    df = spark.createDataFrame(rows, "district string, year int, n long")
    staging.export_csv(df, str(tmp_path / "out"))
    assert sorted(map(tuple, staging.read_export(spark, str(tmp_path / "out"), df.schema).collect())) == sorted(rows)
    assert any('"a""b,c",2011,3' in p.read_text() for p in (tmp_path / "out").glob("*.csv"))


def test_rows_meet_few_bins_without_a_shuffle(spark, tmp_path, monkeypatch):
    """A listing is judged by the bytes of its files until it is written; the files here are over the limit of a broadcast."""
    row = "1,2020-01,Force,Force,1,2,Road,E1,Area,Open"
    for month in ("2020-01", "2020-02"):
        (tmp_path / "in" / month).mkdir(parents=True)
        (tmp_path / "in" / month / f"{month}-x-outcomes.csv").write_text("\n".join([HEADERS["outcomes"], *[row] * 2000]) + "\n")
    joined = []
    monkeypatch.setattr(records, "join_reduced", lambda *a, f=records.join_reduced: joined.append(f(*a)) or joined[-1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        records.compact_by_bytes(spark, str(tmp_path / "in"), "outcomes", str(tmp_path / "out"), 50_000)
        assert "BroadcastHashJoin" in joined[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4000


def test_records_by_month_are_moved_before_they_are_text(spark, tmp_path):
    spark.range(60).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "id % 15 AS l_suppkey", "'A' AS l_returnflag", "'O' AS l_linestatus",
        "IF(id = 9, NULL, timestamp_seconds(id * 1000000)) AS l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    plain, moved = views.incidents(spark, str(tmp_path)), views.incidents(spark, str(tmp_path), by_month=True)
    assert sorted(map(repr, moved.collect())) == sorted(map(repr, plain.collect()))
    plan_text = moved._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan_text.split("RebalancePartitions")
    assert "concat(" in above and "concat(" not in below
