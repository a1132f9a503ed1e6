import datetime as dt
import hashlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.operators import gates, matching
from countflow.operators.gates import GateError
from countflow.sources import counts
from countflow.streaming.counts import stream_counts, stream_stopped

SERIES = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.IntegerType())])
DAY = dt.datetime(2026, 8, 1)


def _hours(k, hours, value=0, day=DAY):
    return [(k, day + dt.timedelta(hours=h), value) for h in hours]


def test_a_stopped_day_comes_with_the_batch_that_fills_it(spark, tmp_path):
    """The watermark waits for ten days, the rows don't; each run starts again from the checkpoint."""

    def batch(rows):
        spark.createDataFrame(rows, SERIES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        live = stream_stopped(stream_counts(spark, f"{tmp_path}/in", SERIES, "parquet"), ["k"], "ts", "v", late="10 days")
        live.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start().awaitTermination(120)
        return sorted(map(tuple, spark.read.schema(live.schema).parquet(f"{tmp_path}/out").collect()))

    one, two = (1, DAY.date(), 1), (2, DAY.date(), 0)
    assert batch(_hours(1, range(23)) + _hours(2, range(10)) + _hours(3, range(24), 5)) == []
    assert batch(_hours(1, [23], 1) + [(2, DAY + dt.timedelta(hours=10), None)]) == [one]
    assert batch(_hours(1, [5], 900) + _hours(2, range(10, 24)) + _hours(4, range(23), 0)) == [one, two]  # a slot counts once, a full day is given once
    far = DAY + dt.timedelta(days=60)
    assert batch(_hours(9, [0], 0, far)) == [one, two]  # the timers of the old days go off
    assert batch(_hours(9, range(1, 24), 0, far)) == sorted([one, two, (9, far.date(), 0)])


def test_chunks_of_many_files_are_in_order(spark, tmp_path):
    n = 30_000
    df = spark.range(n).select(F.timestamp_seconds(F.lit(1_785_542_400) + F.col("id") * 97 % 864_000).cast("timestamp_ntz").alias("ts"), F.col("id").alias("counter"), F.lit("5m").alias("res"))
    counts.write_chunks(df, f"{tmp_path}/out", "ts", ["ts", "counter"], "res", rows=4000, group_rows=1000)
    seen = 0
    for folder in sorted((tmp_path / "out").glob("res=*/chunk=*")):
        rows, files = [], sorted(folder.glob("*.parquet"))
        for f in files:
            p = pq.ParquetFile(f)
            assert p.metadata.num_rows <= 4000 and all(p.metadata.row_group(g).num_rows <= 1000 for g in range(p.metadata.num_row_groups))
            own = p.read().to_pylist()
            assert own == sorted(own, key=lambda r: (r["ts"], r["counter"]))
            rows += own
        assert [(r["ts"], r["counter"]) for r in rows] == sorted((r["ts"], r["counter"]) for r in rows)
        seen += len(rows)
        assert len(files) > 1
    assert seen == n
    counts.write_chunks(df.limit(0), f"{tmp_path}/none", "ts", ["ts"], "res")


def test_layers_of_several_layouts_in_one_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿time,code,n\r\n1,x,\"5,5\"\r\n2,y\r\n\r\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("n,extra,code,time\n7,q,z,3\n", encoding="utf-8")
    df = counts.read_layer(spark, f"{tmp_path}/b.csv", {"time": "t", "code": "c", "n": "v"}, drop=["extra"])
    assert [tuple(r) for r in df.collect()] == [("3", "z", "7")]
    df = counts.read_layouts(spark, str(tmp_path), ["t", "v", "q"], lambda found, file: {"t": "time", "v": "n"})
    assert sorted((r["t"], r["v"], r["q"], r["_file"][-5:]) for r in df.collect()) == [("1", "5,5", None, "a.csv"), ("2", None, None, "a.csv"), ("3", "7", None, "b.csv")]
    with pytest.raises(GateError, match="a.csv.*missing.*extra"):
        counts.read_layer(spark, str(tmp_path), {"time": "t", "code": "c", "n": "v"}, drop=["extra"])


def test_files_are_hashed_in_pieces(spark, tmp_path, monkeypatch):
    body = bytes(range(256)) * 5000
    (tmp_path / "one.bin").write_bytes(body)
    (tmp_path / "empty.bin").write_bytes(b"")
    got = {r["name"]: (r["bytes"], r["sha256"]) for r in gates.file_manifest(spark, str(tmp_path)).collect()}
    assert got == {"one.bin": (len(body), hashlib.sha256(body).hexdigest())}


def test_domains_in_one_scan(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", None), (None, 9)], "x string, y int")
    out = gates.domain_violations(df, {"x": ["a"], "y": [1]})
    assert sorted(map(tuple, out.collect())) == [("x", "b", 2), ("y", "2", 1), ("y", "9", 1)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1 and "Union" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_partitions_to_audit(spark):
    sizes = spark.createDataFrame([(f"r{i:02d}", i * i, i in (3, 30)) for i in range(40)], "p string, n long, lzh boolean")
    usual = [f"r{i:02d}" for i in range(40) if i not in (3, 30)]
    seen = set()
    for m in range(1, 13):
        got = {r["p"] for r in gates.audit_partitions(sizes, "p", "n", F.col("lzh"), f"2026-{m:02d}").collect()}
        assert {"r00", "r01", "r03", "r30"} <= got and len(got) == 5
        seen |= got - {"r00", "r01", "r03", "r30"}
    assert len(seen) > 3 and all(usual.index(p) < 3 * len(usual) // 4 for p in seen)
    assert {r["p"] for r in gates.audit_partitions(sizes.filter("p < 'r01'"), "p", "n", F.col("lzh"), "2026-01").collect()} == {"r00"}


def test_names_of_places(spark):
    places = [("01100", "札幌市", "ｻｯﾎﾟﾛｼ"), ("01101", "札幌市中央区", "ｻｯﾎﾟﾛｼﾁｭｳｵｳｸ"), ("13101", "千代田区", "チヨダク"), ("01300", "当別町", "トウベツチヨウ"), ("05000", "大潟村", "オオガタムラ"), ("09000", "那須町", "ナスマチ"), ("09001", "謎町", "ナゾムラ"), ("09002", "無名町", "ムメイマチ"), ("09003", "二名町", "ニメイマチ"), ("09004", "数町", "カズマチ")]
    labels = [("01100", "Sapporo"), ("01101", "Chūō-ku, Sapporo"), ("13101", "Chiyoda"), ("01300", "Tōbetsu"), ("05000", "Ōgata"), ("05000", "Ogata village"), ("09000", "Nasu Town"), ("09001", "Nazo"), ("09003", "Nimei"), ("09003", "Futana"), ("09004", "Kazu 2")]
    out = matching.place_names(spark.createDataFrame(places, "code string, n string, r string"), spark.createDataFrame(labels, "code string, en string"), "code", "n", "r", "en")
    assert {r["code"]: (r["en"], r["problem"]) for r in out.collect()} == {
        "01100": ("Sapporo-shi", None), "01101": ("Sapporo-shi Chuo-ku", None), "13101": ("Chiyoda-ku", None), "01300": ("Tobetsu-cho", None), "05000": ("Ogata-mura", None), "09000": ("Nasu-machi", None),
        "09001": (None, "reading"), "09002": (None, "none"), "09003": (None, "several"), "09004": (None, "label"),
    }
