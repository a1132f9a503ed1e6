"""Queries of the sources, sinks and streaming forms: tables are written to the shared folder in a raw layout and read back by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countflow import functions as fn
from countflow.plans.views import hourly, hourly_users, sql, table
from countflow.session import shared_dir
from countflow.sources import archives, counts, weather
from countflow.streaming import counts as live

QUERIES: dict = {}
ORACLE_SQL: dict = {}
c = F.col


def query(name: str, oracle: str | None):
    def keep(f):
        QUERIES[name] = f
        if oracle:
            ORACLE_SQL[name] = oracle
        return f

    return keep


def folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/io-{uuid.uuid4().hex}"


def raw_layer(s: SparkSession, d: str) -> str:
    """Events as gzip CSV files of text: time code, counter, vehicles; those of odd users with the columns in another order."""
    at = folder(s)
    e = table(s, d, "events").select(F.date_format("ts", "yyyyMMddHHmm").alias("time"), F.lpad(c("user_id").cast("string"), F.greatest(F.lit(4), F.length(c("user_id").cast("string"))), F.lit("0")).alias("code"), F.floor("value").cast("string").alias("n"), F.lit("139").alias("lon"))
    odd = c("code").cast("int") % 2 == 1
    e.filter(~odd).write.option("header", True).option("compression", "gzip").csv(at)
    e.filter(odd).select("n", "lon", "code", "time").write.mode("append").option("header", True).csv(at)
    return at


@query("s1_read_layer", "SELECT date_trunc('minute', ts) AS ts, CAST(user_id AS INT) AS counter, CAST(floor(value) AS INT) AS vehicles FROM events")
def _(s, d):
    x = counts.read_layer(s, raw_layer(s, d), {"time": "time_code", "code": "counter", "n": "vehicles"}, drop=["lon"])
    return x.select(fn.parse_time_code(c("time_code"), ["yyyyMMddHHmm"]).alias("ts"), fn.safe_int(c("counter"), 0, 10**6).alias("counter"), fn.safe_int(c("vehicles"), 0, 10**6).alias("vehicles"))


@query("s2_discover_partitions", "SELECT DISTINCT 'typed' AS kind, CAST(day(o_orderdate) AS VARCHAR) AS day FROM orders")
def _(s, d):
    at = folder(s)
    table(s, d, "orders").select("o_orderkey", F.day("o_orderdate").alias("day")).write.partitionBy("day").parquet(at)
    found = counts.discover_partitions(s, at, r"(day)=()()(\d+)/[^/]*\.parquet$")
    return found.filter("sensor = 'day'").select(F.lit("typed").alias("kind"), F.regexp_extract("path", r"day=(\d+)", 1).alias("day")).distinct()


@query("s4_weather_json", "SELECT l_orderkey * 8 + l_linenumber AS k, CAST(l_suppkey AS VARCHAR) AS station_id, l_quantity AS rain, CAST(l_linenumber % 2 AS INT) AS rain_aqc, CAST(NULL AS DOUBLE) AS temp FROM lineitem")
def _(s, d):
    li = table(s, d, "lineitem")
    body = F.to_json(F.create_map(c("l_suppkey").cast("string"), F.create_map(F.lit("rain"), F.array(c("l_quantity"), (c("l_linenumber") % 2).cast("double")))))
    x = li.select((F.lit("2024-01-01").cast("timestamp_ntz")).alias("at"), (c("l_orderkey") * 8 + c("l_linenumber")).alias("k"), body.alias("body"))
    return _weather_rows(x)


@query("s5_weather_csv", sql("weather", "SELECT CAST(station AS VARCHAR) AS station_id, date, rain, rain_aqc FROM weather"))
def _(s, d):
    """Weather written as CSV files by year and read back by a fixed schema."""
    from pyspark.sql import types as T

    from countflow.plans.views import weather as rain

    at = folder(s)
    rain(s, d).select(c("station").cast("string").alias("station_id"), "date", "rain", "rain_aqc").write.option("header", True).csv(at)
    schema = T.StructType([T.StructField("station_id", T.StringType()), T.StructField("date", T.DateType()), T.StructField("rain", T.IntegerType()), T.StructField("rain_aqc", T.IntegerType())])
    return weather.read_weather_csv(s, at, schema)


@query("s5_latest_stations", "SELECT CAST(s_suppkey AS VARCHAR) AS station_id, CAST(s_acctbal + 2 AS DOUBLE) AS alt_m FROM supplier")
def _(s, d):
    """The station table in three versions, each a CSV file named by its day; the newest one counts."""
    from pyspark.sql import types as T

    at, t = folder(s), table(s, d, "supplier")
    for k, day in enumerate(("20240101", "20240301", "20240215")):
        t.select(c("s_suppkey").cast("string").alias("station_id"), (c("s_acctbal") + (2 if day == "20240301" else k)).cast("double").alias("alt_m")).coalesce(1).write.option("header", True).csv(f"{at}/parts{k}")
        fs = s._jvm.org.apache.hadoop.fs.Path(at).getFileSystem(s._jsc.hadoopConfiguration())
        path = s._jvm.org.apache.hadoop.fs.Path
        for f in fs.globStatus(path(f"{at}/parts{k}/part-*.csv")):
            fs.rename(f.getPath(), path(f"{at}/stations_{day}.csv"))
        fs.delete(path(f"{at}/parts{k}"), True)
    schema = T.StructType([T.StructField("station_id", T.StringType()), T.StructField("alt_m", T.DoubleType())])
    return weather.latest_file(s, at, schema)


def _weather_rows(x: DataFrame) -> DataFrame:
    keyed = x.select(c("body"), (c("at") + F.make_dt_interval(days=F.lit(0), hours=F.lit(0), mins=F.lit(0), secs=c("k").cast("decimal(18,6)"))).alias("at"))
    w = weather.read_weather_json(keyed, "at", "body", ["rain", "temp"])
    k = F.unix_timestamp(c("at").cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-01").cast("timestamp"))
    return w.select(k.alias("k"), "station_id", "rain", "rain_aqc", "temp")


@query("s6_stations_json", "SELECT CAST(s_suppkey AS VARCHAR) AS station_id, round_even(30 + s_suppkey % 10 + (s_suppkey % 60) / 60, 5) AS lat FROM supplier")
def _(s, d):
    k = c("s_suppkey")
    deg, minutes = (F.lit(30) + k % 10).cast("double"), (k % 60).cast("double")
    body = F.to_json(F.create_map(k.cast("string"), F.struct(F.array(deg, minutes).alias("lat"), F.array(F.lit(139.0), F.lit(0.0)).alias("lon"), F.lit(1.0).alias("alt"), c("s_name").alias("name"))))
    return weather.read_stations_json(table(s, d, "supplier").select(body.alias("body")), "body").select("station_id", "lat")


#: Rows of an archive, about.
ARCHIVE = 100_000


def _archives(s: SparkSession, d: str) -> str:
    """Zip archives by return flag, with a CSV member for each supplier and line number: line items, in one of two column orders. A task makes one archive, of about ``ARCHIVE`` rows however many there are."""
    import io
    import zipfile

    import numpy as np
    import pandas as pd
    import pyarrow.fs as pafs

    at = folder(s)
    li = table(s, d, "lineitem").select("l_returnflag", "l_suppkey", "l_linenumber", "l_orderkey", c("l_quantity").cast("int").alias("n"))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fs, root = pafs.FileSystem.from_uri(at)
        fs.create_dir(root, recursive=True)
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
            rows = rows.sort_values(["l_suppkey", "l_linenumber"], kind="stable")
            supplier, line, order, n = (rows[x].to_numpy() for x in ("l_suppkey", "l_linenumber", "l_orderkey", "n"))
            begin = np.flatnonzero(np.r_[True, (supplier[1:] != supplier[:-1]) | (line[1:] != line[:-1])])
            for i, j in zip(begin, [*begin[1:], len(rows)]):
                names, first, second = ("番号,量", order, n) if line[i] % 2 else ("量,番号", n, order)
                body_lines = [names, *map("{},{}".format, first[i:j].tolist(), second[i:j].tolist()), ""]
                z.writestr(f"{supplier[i]}-{line[i]}.csv", "\r\n".join(body_lines).encode("cp932"))
        with fs.open_output_stream(f"{root}/typeB_{key[0].lower()}{key[1]}_2026_08.zip", compression=None) as f:
            f.write(body.getvalue())
        return pd.DataFrame({"n": [len(rows)]})

    spread = li.withColumn("_part", F.pmod(F.xxhash64("l_suppkey"), F.lit(max(4, -(-li.count() // (3 * ARCHIVE))))))
    spread.groupBy("l_returnflag", "_part").applyInPandas(pack, "n long").agg(F.sum("n")).collect()
    return at


def _members(s: SparkSession, d: str) -> DataFrame:
    return archives.read_archive_members(s, _archives(s, d), r"\.csv$", r"typeB_([a-z]+)\d+_")


@query("s7_archive_members", "SELECT lower(l_returnflag) AS region, l_suppkey || '-' || l_linenumber || '.csv' AS member, CAST(NULL AS VARCHAR) AS problem FROM lineitem GROUP BY ALL")
def _(s, d):
    return _members(s, d).select("region", "member", "problem")


@query("s9_detector_csv", "SELECT lower(l_returnflag) AS region, CAST(l_orderkey AS VARCHAR) AS point, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS n, CAST(NULL AS VARCHAR) AS link FROM lineitem")
def _(s, d):
    return archives.read_detector_csv(_members(s, d), {"番号": "point", "量": "n"}, ["point", "n", "link"], ["link"])


@query("s8_drop_identical_members", "SELECT l_returnflag AS region, l_orderkey || '-' || l_linenumber AS member, first_value(l_orderkey || '-' || l_linenumber) OVER (PARTITION BY l_returnflag, l_quantity ORDER BY l_orderkey || '-' || l_linenumber) AS kept_as FROM lineitem")
def _(s, d):
    name = F.concat(c("l_orderkey").cast("string"), F.lit("-"), c("l_linenumber").cast("string"))
    m = table(s, d, "lineitem").select(c("l_returnflag").alias("region"), F.lit("a").alias("archive"), name.alias("member"), F.sha2(c("l_quantity").cast("string"), 256).alias("sha256"))
    return archives.drop_identical_members(m).select("region", "member", "kept_as")


@query("s10_geocode_cache", "SELECT c_custkey AS address, CASE WHEN c_custkey % 4 > 0 THEN CAST(130 + c_custkey % 10 AS DOUBLE) END AS lon, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS title FROM customer")
def _(s, d):
    one = F.struct(F.struct(F.array((130 + c("c_custkey") % 10).cast("double"), F.lit(35.0)).alias("coordinates")).alias("geometry"), F.struct(c("c_mktsegment").alias("title")).alias("properties"))
    body = F.when(c("c_custkey") % 4 == 0, "[]").otherwise(F.to_json(F.array(one, one)))
    return weather.read_geocode_cache(table(s, d, "customer").select(c("c_custkey").alias("address"), body.alias("body")), "address", "body").select("address", "lon", "title")


@query("s11_positional_csv", "SELECT lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS section, CAST(p_size AS VARCHAR) AS km FROM part")
def _(s, d):
    at = folder(s)
    table(s, d, "part").select("p_partkey", "p_brand", "p_type", "p_size").write.csv(at)
    return counts.read_positional_csv(s, [at], {0: "section", 3: "km"}, key="section").select("section", "km")


@query("s12_write_chunks", sql("hourly", "SELECT counter, ts, vehicles, strftime(ts, '%Y-%m') || '_' || CASE WHEN day(ts) <= 10 THEN '01-10' WHEN day(ts) <= 20 THEN '11-20' ELSE '21-' || day(last_day(ts)) END AS chunk FROM hourly"))
def _(s, d):
    at = folder(s)
    counts.write_chunks(hourly(s, d).withColumn("res", F.lit("1h")), at, "ts", ["ts", "counter"], "res")
    return s.read.parquet(at).select("counter", "ts", "vehicles", "chunk")


@query("s13_write_region_parts", "SELECT l_suppkey AS source, l_orderkey AS point, l_shipdate AS at FROM lineitem")
def _(s, d):
    at = folder(s)
    counts.write_region_parts(table(s, d, "lineitem").select(c("l_suppkey").alias("source"), c("l_orderkey").alias("point"), c("l_shipdate").alias("at")), at, ["source", "point", "at"])
    return s.read.parquet(at)


@query("s14_csv_dimension", "SELECT CAST(s_suppkey AS VARCHAR) AS k, s_name AS name FROM supplier")
def _(s, d):
    at = folder(s)
    counts.write_csv_dimension(table(s, d, "supplier").select(c("s_suppkey").alias("k"), c("s_name").alias("name")), at, "gzip")
    return s.read.option("header", True).csv(at)


# -- streams: each is run over the given table, then, from the same checkpoint, over an end mark that lets the last windows close

END = "2100-01-01 00:00:00"


def _minutes(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select(c("event_type").alias("source"), c("user_id").alias("point"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"), F.floor("value").cast("bigint").alias("vehicles"))


def _run(rows: DataFrame, live_form) -> DataFrame:
    """What ``live_form`` of a stream of ``rows`` (columns with ``ts``) emits; the rows are written in their own partitions."""
    s, at, to = rows.sparkSession, folder(rows.sparkSession), folder(rows.sparkSession)
    rows.write.parquet(at)
    df = live_form(live.stream_counts(s, at, rows.schema, "parquet"))

    def finish() -> None:
        df.writeStream.format("parquet").option("path", to).option("checkpointLocation", f"{to}-state").outputMode("append").trigger(availableNow=True).start().awaitTermination()

    finish()
    end = [F.lit(END).cast(f.dataType).alias(f.name) if f.name == "ts" else (F.lit("end") if f.dataType.simpleString() == "string" else F.lit(0)).cast(f.dataType).alias(f.name) for f in rows.schema]
    s.range(1).select(*end).write.mode("append").parquet(at)
    finish()
    return s.read.schema(df.schema).parquet(to)


@query("x1_stream_counts", "SELECT event_type AS source, user_id AS point, date_trunc('minute', ts) AS ts, CAST(floor(value) AS BIGINT) AS vehicles FROM events")
def _(s, d):
    return _run(_minutes(s, d), lambda x: x).filter("source <> 'end'")


@query("x2_stream_rollup", "SELECT event_type AS source, date_trunc('hour', ts) AS hour, CAST(sum(floor(value)) AS BIGINT) AS vehicles, count(*) AS n FROM events GROUP BY 1, 2")
def _(s, d):
    return _run(_minutes(s, d), lambda x: live.stream_rollup(x, ["source"], "ts", "vehicles", late="40 days")).filter("source <> 'end'")


@query("x3_stream_dedup", "SELECT event_type AS source, user_id % 3 AS point, date_trunc('minute', ts) AS ts, CAST(min(floor(value)) AS BIGINT) AS vehicles FROM events GROUP BY 1, 2, 3 HAVING min(floor(value)) = max(floor(value))")
def _(s, d):
    return _run(_minutes(s, d).withColumn("point", c("point") % 3), lambda x: live.stream_dedup(x, ["source", "point"], "ts", "vehicles", "40 days")).filter("source <> 'end'")


@query("x4_stream_completeness", "SELECT CAST(ts AS DATE) AS day, count(DISTINCT hour(ts)) AS hours, count(*) AS rows, CASE WHEN count(DISTINCT hour(ts)) >= 24 THEN 'settled' ELSE 'keep' END AS status FROM events GROUP BY 1")
def _(s, d):
    return _run(_minutes(s, d), lambda x: live.stream_completeness(x, "ts", late="40 days")).filter("day < DATE '2100-01-01'")


@query("x5_baseline_batch", sql("hourly", """, x AS (SELECT counter, CAST(ts AS DATE) AS day, CAST(sum(vehicles) AS BIGINT) AS vehicles FROM hourly GROUP BY 1, 2), y AS (SELECT *, list(vehicles ORDER BY day) FILTER (vehicles IS NOT NULL) OVER (PARTITION BY counter ORDER BY day RANGE BETWEEN INTERVAL 35 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS l FROM x)
SELECT counter, day, vehicles, CASE WHEN len(l) >= 3 THEN CAST(list_aggregate(list_slice(l, -4, -1), 'median') AS DOUBLE) END AS baseline FROM y"""))
def _(s, d):
    """Whole days through the archive of ``baseline_batch``, in three batches in order of the days; the SQL is one window over all days."""
    at = folder(s)
    days = hourly(s, d).groupBy("counter", F.to_date("ts").alias("day")).agg(F.sum("vehicles").alias("vehicles"))
    run = live.baseline_batch(at, ["counter"], "day", "vehicles")
    for k, (a, b) in enumerate((("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "2024-01-31"))):
        run(days.filter(c("day").between(F.lit(a).cast("date"), F.lit(b).cast("date"))), k)
    return s.read.parquet(at).select("counter", "day", "vehicles", "baseline")


@query("x6_registry_batch", "SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS pos, c_custkey % 30 + CASE WHEN c_custkey % 2 = 0 THEN 100 ELSE 0 END AS last_seen FROM customer")
def _(s, d):
    """A registry kept over two batches: all customers, then every second one at another place."""
    from pyspark.sql import types as T

    at = folder(s)
    k, t = c("c_custkey"), table(s, d, "customer")
    one = t.select(k.alias("k"), c("c_nationkey").cast("bigint").alias("pos"), (k % 30).alias("last_seen"))
    two = t.filter(k % 2 == 0).select(k.alias("k"), (c("c_nationkey") + 100).cast("bigint").alias("pos"), (k % 30 + 100).alias("last_seen"))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("k", "pos", "last_seen")])
    run = live.registry_batch(lambda n: f"{at}/{n}", ["k"], ["pos"], schema)
    run(one, 0)
    run(two, 1)
    return s.read.schema(schema).parquet(f"{at}/1")


STOPPED = """, x AS (SELECT counter, CAST(ts AS DATE) AS date, CAST(sum(vehicles) AS BIGINT) AS total, count(*) AS n FROM hourly_users GROUP BY 1, 2) SELECT counter, date, total FROM x WHERE n = 24 AND total < 24"""


@query("x7_stream_stopped", sql("hourly_users", STOPPED))
def _(s, d):
    h = hourly_users(s, d).select("counter", "ts", "vehicles")
    return _run(h, lambda x: live.stream_stopped(x, ["counter"], "ts", "vehicles", late="40 days")).filter("counter > 0")
