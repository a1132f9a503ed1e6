import datetime as dt
import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.operators.aggregates import resolve_duplicates, rollup_interval
from countflow.operators.gates import GateError, file_manifest, snapshot_diff
from countflow.operators.windows import baseline
from countflow.sources import archives, counts, weather
from countflow.streaming import counts as st


def test_layers_and_discovery(spark, tmp_path):
    with gzip.open(tmp_path / "loop_1h_road1_20261003.csv.gz", "wt") as f:
        f.write("time,code,n,lon\n202610030800,0012,5,139\n202610030900,0012,,139\n")
    (tmp_path / "other.txt").write_text("x")
    df = counts.read_layer(spark, str(tmp_path / "*.csv.gz"), {"time": "time_code", "code": "counter", "n": "vehicles"}, drop=["lon"])
    assert sorted(tuple(r) for r in df.collect()) == [("202610030800", "0012", "5"), ("202610030900", "0012", None)]
    with pytest.raises(GateError, match="new: \\['lon'\\]"):
        counts.read_layer(spark, str(tmp_path / "*.csv.gz"), {"time": "time_code", "code": "counter", "n": "vehicles"})
    found = {r["sensor"]: r for r in counts.discover_partitions(spark, str(tmp_path)).collect()}
    assert found["loop"]["day"] == dt.date(2026, 10, 3) and found["loop"]["chunk"] == "2026-10_01-10" and found[None]["res"] is None


def test_layers_with_columns_in_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("time,code,n\n202610030800,12,5\n")
    (tmp_path / "b.csv").write_text("n,code,time\n77,13,202610030900\n")
    (tmp_path / "empty.csv").write_text("")
    names = {"time": "time_code", "code": "counter", "n": "vehicles"}
    rows = counts.read_layer(spark, str(tmp_path), names).collect()
    assert {(r["time_code"], r["counter"], r["vehicles"]) for r in rows} == {("202610030800", "12", "5"), ("202610030900", "13", "77")}
    (tmp_path / "c.csv").write_text("n,code,time,more\n77,13,202610030900,1\n")
    with pytest.raises(GateError, match="c.csv: .*new: \\['more'\\]"):
        counts.read_layer(spark, str(tmp_path), names)


def test_members_larger_than_a_piece(spark, tmp_path, monkeypatch):
    lines = [f"2026/8/1 0:{i % 60:02d},地点{i},{i}" for i in range(5000)]
    with zipfile.ZipFile(tmp_path / "typeB_osaka_2026_08.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", "\r\n".join(["時刻,地点,量", *lines]).encode("cp932"))
        z.writestr("b.csv", "\r\n".join(["量,時刻,地点", "1,x,y"]).encode("cp932"))
    monkeypatch.setattr(archives, "PIECE", 1001)
    m = archives.read_archive_members(spark, str(tmp_path), r"\.csv$", r"typeB_([a-z]+)_")
    rows = archives.read_detector_csv(m, {"時刻": "time", "地点": "point", "量": "n"}, ["time", "point", "n"], []).collect()
    assert {(r["time"], r["point"], r["n"]) for r in rows} == {tuple(x.split(",")) for x in lines} | {("x", "y", "1")} and {r["region"] for r in rows} == {"osaka"}


def test_many_members_are_few_files(spark, tmp_path, monkeypatch):
    """A thousand members, with all kinds of line ends, blank and missing last lines and an empty one, cut at any place: as many text files as tasks, and each row of each member."""
    (tmp_path / "in").mkdir()
    ends, want = ["\r\n", "\n", "\r"], set()
    for a in range(2):
        with zipfile.ZipFile(tmp_path / "in" / f"typeB_osaka_{a}.zip", "w") as z:
            for k in range(500):
                rows = [(f"{a}-{k}", str(i)) for i in range(k % 4)]
                lines = ["地点,量" if k % 2 else "量,地点", "", *[",".join(r if k % 2 else r[::-1]) for r in rows]]
                z.writestr(f"{k}.csv", (ends[k % 3].join(lines) + ends[k % 3] * (k % 5)).encode("cp932") if k else b"")
                want |= set(rows)
    monkeypatch.setattr(archives, "PIECE", 7)
    m = archives.read_archive_members(spark, str(tmp_path / "in"), r"\.csv$", r"typeB_([a-z]+)_", to=f"file://{tmp_path}/to")
    assert m.filter("problem IS NULL").count() == 1000 and len(list((tmp_path / "to").glob("*"))) <= 2
    rows = archives.read_detector_csv(m, {"地点": "point", "量": "n"}, ["point", "n"], []).collect()
    assert {(r["point"], r["n"]) for r in rows} == want and len(rows) == len(want)


def test_writers(spark, tmp_path):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ '2024-02-09', TIMESTAMP_NTZ '2024-02-22', INTERVAL 1 DAY)) AS ts").withColumn("k", F.lit(1)).withColumn("res", F.lit("1h"))
    counts.write_chunks(df, f"{tmp_path}/c", "ts", ["ts", "k"], "res")
    assert {r["chunk"] for r in spark.read.parquet(f"{tmp_path}/c").collect()} == {"2024-02_01-10", "2024-02_11-20", "2024-02_21-29"}
    counts.write_region_parts(df, f"{tmp_path}/r", ["k", "ts"])
    counts.write_csv_dimension(df, f"{tmp_path}/d")
    assert spark.read.parquet(f"{tmp_path}/r").count() == spark.read.option("header", True).csv(f"{tmp_path}/d").count() == 14
    assert snapshot_diff(file_manifest(spark, f"{tmp_path}/r"), file_manifest(spark, f"{tmp_path}/r")).count() == 0


def test_positional(spark, tmp_path):
    (tmp_path / "aomori.csv").write_text("12,a,b,3.5\n7,c\n")
    rows = counts.read_positional_csv(spark, [str(tmp_path / "aomori.csv")], {0: "section", 3: "km"}, key="section", width=5).collect()
    assert [tuple(r) for r in rows] == [("00012", "3.5", "aomori"), ("00007", None, "aomori")]


def test_weather(spark):
    body = json.dumps({"11": {"temp": [1.5, 0], "odd": [1, 0]}, "12": {"rain": [0.5, 1]}})
    df = spark.createDataFrame([(dt.datetime(2026, 10, 1, 9), body), (dt.datetime(2026, 10, 1, 10), "not json")], "at timestamp_ntz, body string")
    rows = {r["station_id"]: r for r in weather.read_weather_json(df, "at", "body", ["temp", "rain"]).collect()}
    assert rows["11"]["temp"] == 1.5 and rows["11"]["rain"] is None and rows["11"]["unknown"] == ["odd"] and rows["12"]["rain_aqc"] == 1
    assert rows["11"]["hour_start"] == dt.datetime(2026, 10, 1, 8)
    s = spark.createDataFrame([(json.dumps({"11": {"lat": [35, 30.0], "lon": [139, 0.6], "alt": 4, "name": "x"}}),)], "body string")
    assert [tuple(r) for r in weather.read_stations_json(s, "body").collect()] == [("11", 35.5, 139.01, 4.0, "x")]
    g = spark.createDataFrame([("a", json.dumps([{"geometry": {"coordinates": [1.0, 2.0]}, "properties": {"title": "t"}}])), ("b", "[]")], "address string, body string")
    assert {tuple(r) for r in weather.read_geocode_cache(g, "address", "body").collect()} == {("a", 1.0, 2.0, "t"), ("b", None, None, None)}


def test_latest_station_table(spark, tmp_path):
    for name, lat in (("s_20260101.csv", 1), ("s_20260301.csv", 3)):
        (tmp_path / name).write_text(f"station_id,lat\nx,{lat}\n")
    schema = T.StructType([T.StructField("station_id", T.StringType()), T.StructField("lat", T.DoubleType())])
    assert [tuple(r) for r in weather.latest_file(spark, str(tmp_path), schema).collect()] == [("x", 3.0)]


def test_archives(spark, tmp_path):
    csv = "時刻,地点,量\r\n2026/8/1 0:00, 5 ,7\r\n2026/8/1 0:05,5\r\n".encode("cp932")
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("a.csv", csv)
        z.writestr("b.csv", csv)
        z.writestr("readme.txt", "x")
    with zipfile.ZipFile(tmp_path / "month.zip", "w") as z:
        z.writestr("typeB_tokyo_2026_08.zip", inner.getvalue())
    (tmp_path / "broken.zip").write_bytes(b"no")
    m = archives.read_archive_members(spark, str(tmp_path), r"\.csv$", r"typeB_([a-z]+)_")
    problems = {(r["member"], r["problem"]) for r in m.collect() if r["problem"]}
    assert problems == {("readme.txt", "unexpected member"), (None, "not a zip file")}
    kept = archives.drop_identical_members(m.filter("file IS NOT NULL"))
    assert {(r["member"], r["kept_as"]) for r in kept.collect()} == {("a.csv", "a.csv"), ("b.csv", "a.csv")}
    rows = archives.read_detector_csv(kept.filter("is_kept"), {"時刻": "time", "地点": "point", "量": "n"}, ["time", "point", "n", "link"], ["link"]).collect()
    assert sorted((tuple(r) for r in rows), key=str) == [("tokyo", "2026/8/1 0:00", "5", "7", None), ("tokyo", "2026/8/1 0:05", "5", None, None)]


COUNTS = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.IntegerType())])


def _drops(spark, tmp_path, rows, parts=3):
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], COUNTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    end = dt.datetime(2030, 1, 1)
    return end


def _run(df, tmp_path, name, spark):
    q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmp_path}/cp-{name}").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_streams_equal_batch(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(k, base + dt.timedelta(minutes=5 * i), None if i % 7 == 0 else i % 5) for k in (1, 2) for i in range(600)]
    rows += [(1, base + dt.timedelta(minutes=5), 1), (2, base + dt.timedelta(minutes=10), 99)]
    rows += [(9, dt.datetime(2030, 1, 1), 0)]  # moves the watermark past the rest
    _drops(spark, tmp_path, rows, 1)
    batch = spark.createDataFrame(rows, COUNTS).filter("k < 9")
    live = lambda: st.stream_counts(spark, f"{tmp_path}/in", COUNTS, "parquet")
    key = lambda df: sorted((tuple(r) for r in df.collect() if r[0] != 9), key=str)
    got = _run(st.stream_rollup(live(), ["k"], "ts", "v"), tmp_path, "rolled", spark)
    want = rollup_interval(batch, ["k"], "ts", "v").withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    assert key(got) == key(want)
    got = _run(st.stream_dedup(live(), ["k"], "ts", "v"), tmp_path, "deduped", spark)
    assert key(got) == key(resolve_duplicates(batch, ["k", "ts"], "v"))
    days = {r["day"].day: r["status"] for r in _run(st.stream_completeness(live(), "ts"), tmp_path, "complete", spark).collect() if r["day"].year == 2024}
    assert days == {1: "settled", 2: "settled", 3: "keep"}


def test_stopped_stream(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(k, base + dt.timedelta(hours=i), 0 if k == 1 else 5) for k in (1, 2) for i in range(48)] + [(9, dt.datetime(2030, 1, 1), 0)]
    _drops(spark, tmp_path, rows, 1)
    got = _run(st.stream_stopped(st.stream_counts(spark, f"{tmp_path}/in", COUNTS, "parquet"), ["k"], "ts", "v"), tmp_path, "stopped", spark)
    assert {(r["k"], r["date"].day) for r in got.collect()} == {(1, 1), (1, 2)}


def test_baseline_in_batches(spark, tmp_path):
    first = dt.date(2026, 7, 1)
    rows = [(k, first + dt.timedelta(days=i), (i * 7 + k) % 40) for k in (1, 2) for i in range(70)]
    df = spark.createDataFrame(rows, "k int, day date, v int").withColumn("class", F.weekday("day"))
    run = st.baseline_batch(f"{tmp_path}/a", ["k", "class"], "day", "v")
    for a, b in ((0, 30), (30, 50), (50, 70)):
        lo, hi = first + dt.timedelta(days=a), first + dt.timedelta(days=b - 1)
        run(df.filter(F.col("day").between(lo, hi)), 0)
    got = {(r["k"], r["day"]): r["baseline"] for r in spark.read.parquet(f"{tmp_path}/a").collect()}
    want = {(r["k"], r["day"]): r["baseline"] for r in baseline(df, ["k", "class"], "day", "v").collect()}
    assert got == want and any(v is not None for v in want.values())


def test_registry_versions(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("pos", T.StringType()), T.StructField("last_seen", T.StringType())])
    run = st.registry_batch(lambda k: f"{tmp_path}/v{k}", ["k"], ["pos"], schema)
    run(spark.createDataFrame([(1, "a", "01"), (2, "b", "01")], schema), 0)
    run(spark.createDataFrame([(1, "c", "02"), (1, "d", "03"), (3, "e", "02")], schema), 1)
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/v1").collect()) == [(1, "d", "03"), (2, "b", "01"), (3, "e", "02")]


def test_cells_without_quotes_are_split(spark):
    """each line went through a CSV parser of its own; cells, blanks, short and long lines are those that it gave."""
    import csv

    from countflow.sources.counts import rows_by_header

    lines = [("1,2,3"), (" 4 ,\t5, "), ("6"), ('"7,8",9'), ("a,b,c,d"), (",,x"), ("   "), ("p\\,q,r")]
    df = spark.createDataFrame([("f", v) for v in ["x,y,z", *lines]], "_file string, value string")
    heads = spark.createDataFrame([("f", "x,y,z")], "_file string, header string")
    got = rows_by_header(df, heads, ["z", "x", "w"], lambda found, file: {"x": "x", "z": "z"}, {"quote": "", "nullValue": "\x01", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}, csv.QUOTE_NONE)
    parsed = df.filter("trim(value) <> '' AND value <> 'x,y,z'").selectExpr("from_csv(value, 'x STRING, y STRING, z STRING', map('quote', '', 'nullValue', '\x01', 'ignoreLeadingWhiteSpace', 'true', 'ignoreTrailingWhiteSpace', 'true')) AS r")
    assert sorted(map(str, ((r["x"], r["z"]) for r in got.collect()))) == sorted(map(str, ((r["x"], r["z"]) for r in parsed.select("r.*").collect())))
    assert "csv" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_archives_are_bounded(spark, monkeypatch):
    """four archives a flag, whatever their size, were made in a task's memory."""
    from pyspark.sql import functions as F

    from countflow.plans import io

    monkeypatch.setattr(io, "ARCHIVE", 50, raising=False)
    src = "/root/testdata/sf0.001"
    names = spark.read.format("binaryFile").load(io._archives(spark, src)).select("path").distinct().count()
    assert names > 3 * 4
    got = io.QUERIES["s7_archive_members"](spark, src).agg(F.count("*"), F.count_distinct("region", "member"), F.count("problem")).first()
    want = spark.read.parquet(f"{src}/lineitem.parquet").select("l_returnflag", "l_suppkey", "l_linenumber").distinct().count()
    assert tuple(got) == (want, want, 0)
