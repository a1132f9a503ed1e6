"""Counter tables made from the general test tables, once as DataFrames and once as SQL with the same arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countflow.operators.windows import dense_grid

FIRST, LAST = "2024-01-01 00:00:00", "2024-01-30 23:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly(spark, d) -> DataFrame:
    """counter, ts (hour), vehicles: events of each type per hour; hours without any are null."""
    n = table(spark, d, "events").groupBy(F.col("event_type").alias("counter"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.count("*").alias("vehicles"))
    return dense_grid(n, ["counter"], "ts", F.lit(FIRST).cast("timestamp_ntz"), F.lit(LAST).cast("timestamp_ntz"))


def hourly_users(spark, d) -> DataFrame:
    """counter (1 .. 100, by user), ts (hour), vehicles: events per hour on a dense grid, 0 where there are none."""
    n = table(spark, d, "events").groupBy((F.col("user_id") % 100 + 1).alias("counter"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.count("*").alias("vehicles"))
    return dense_grid(n, ["counter"], "ts", F.lit(FIRST).cast("timestamp_ntz"), F.lit(LAST).cast("timestamp_ntz")).withColumn("vehicles", F.coalesce("vehicles", F.lit(0)))


def hourly_ten(spark, d) -> DataFrame:
    """counter (1 .. 10, by user), ts (hour), vehicles: as ``hourly_users``, with ten times the traffic a counter."""
    n = table(spark, d, "events").groupBy((F.col("user_id") % 10 + 1).alias("counter"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.count("*").alias("vehicles"))
    return dense_grid(n, ["counter"], "ts", F.lit(FIRST).cast("timestamp_ntz"), F.lit(LAST).cast("timestamp_ntz")).withColumn("vehicles", F.coalesce("vehicles", F.lit(0)))


def hourly_rain(spark, d) -> DataFrame:
    """station (1 .. 10), ts (hour), rain (0 .. 3)."""
    n = table(spark, d, "events").groupBy((F.floor(F.col("user_id") / 10) % 10 + 1).alias("station"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.count("*").alias("_n"))
    return n.select("station", "ts", ((F.col("_n") * 7 + F.hour("ts")) % 4).cast("int").alias("rain"))


def five_minutes(spark, d) -> DataFrame:
    """source (event type), point (user), ts (5-minute mark), vehicles: the event's value without its fraction."""
    e = table(spark, d, "events")
    mark = F.timestamp_seconds(F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 300) * 300).cast("timestamp_ntz")
    return e.select(F.col("event_type").alias("source"), F.col("user_id").alias("point"), mark.alias("mark"), F.col("ts"), F.floor("value").cast("bigint").alias("vehicles"))


def daily(spark, d) -> DataFrame:
    """counter (supplier), date, vehicles (quantity shipped), large (in lines of over 40), lines."""
    q = F.col("l_quantity").cast("bigint")
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("counter"), F.to_date("l_shipdate").alias("date")).agg(
        F.sum(q).alias("vehicles"), F.coalesce(F.sum(F.when(F.col("l_quantity") > 40, q)), F.lit(0)).alias("large"), F.count("*").alias("lines")
    )


def flags(spark, d) -> DataFrame:
    """line key, f1, f2 (unknown on every seventh line number), three parts and a total."""
    li = table(spark, d, "lineitem")
    known = F.col("l_linenumber") % 7 != 0
    return li.select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), F.when(known, F.col("l_returnflag") == "R").alias("f1"), F.when(known, F.col("l_linestatus") == "O").alias("f2"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("bigint")).alias("small"), F.when(F.col("l_linenumber") != 5, F.col("l_suppkey")).alias("large"), F.col("l_linenumber").cast("bigint").alias("rest"), F.col("l_partkey").alias("total"),
    )


def registry(spark, d) -> DataFrame:
    """Customers as counters, with a position."""
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("counter"), F.col("c_nationkey").alias("nation"), (F.lit(30) + (k * 7919 % 15000) / 1000).alias("lat"), (F.lit(130) + (k * 104729 % 15000) / 1000).alias("lon"), F.col("c_acctbal").alias("size"))


def stations(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("station"), (F.lit(30) + (k * 7919 % 15000) / 1000).alias("lat"), (F.lit(130) + (k * 104729 % 15000) / 1000).alias("lon"), (k % 3 != 0).alias("has_rain"), F.col("s_acctbal").alias("s_size"))


def weather(spark, d) -> DataFrame:
    """station, date, rain (null unless its flag is 0), rain_aqc."""
    li = table(spark, d, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("station"), F.to_date("l_shipdate").alias("date")).agg(F.max(F.round(F.col("l_tax") * 100).cast("int")).alias("rain"), (F.min("l_linenumber") % 5).cast("int").alias("rain_aqc"))


def edges(spark, d) -> DataFrame:
    """A road graph on the parts: k to k + 1 and to 37 k modulo their number, (p_size % 20) / 10 km long."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"), (F.col("p_size") % 20 / 10).cast("double").alias("km"))
    n = p.agg(F.count("*").alias("n"))
    both = p.crossJoin(F.broadcast(n)).select(F.explode(F.array(F.struct(F.col("k").alias("a"), (F.col("k") + 1).alias("b"), "km", "n"), F.struct(F.col("k").alias("a"), (F.col("k") * 37 % F.col("n")).alias("b"), "km", "n"))).alias("e")).select("e.*")
    return both.filter((F.col("b") < F.col("n")) & (F.col("a") != F.col("b"))).select("a", "b", "km")


def holidays(spark, d) -> DataFrame:
    """Days on which many orders were placed stand in for holidays: those whose day of the month is that of their month; every third is unnamed."""
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return o.filter(F.day("date") - F.month("date") <= 2).filter(F.day("date") >= F.month("date")).select("date", F.when(F.day("date") == F.month("date") + 1, "holiday").otherwise(F.concat(F.lit("day "), F.day("date").cast("string"))).alias("name"))


VIEWS = {
    "hourly": f"""SELECT g.counter, g.ts, c.vehicles FROM (SELECT counter, ts FROM (SELECT DISTINCT event_type AS counter FROM events), (SELECT unnest(generate_series(TIMESTAMP '{FIRST}', TIMESTAMP '{LAST}', INTERVAL 1 HOUR)) AS ts)) g
LEFT JOIN (SELECT event_type AS counter, date_trunc('hour', ts) AS ts, count(*) AS vehicles FROM events GROUP BY 1, 2) c USING (counter, ts)""",
    "hourly_users": f"""SELECT g.counter, g.ts, coalesce(c.vehicles, 0) AS vehicles FROM (SELECT counter, ts FROM (SELECT DISTINCT user_id % 100 + 1 AS counter FROM events), (SELECT unnest(generate_series(TIMESTAMP '{FIRST}', TIMESTAMP '{LAST}', INTERVAL 1 HOUR)) AS ts)) g
LEFT JOIN (SELECT user_id % 100 + 1 AS counter, date_trunc('hour', ts) AS ts, count(*) AS vehicles FROM events GROUP BY 1, 2) c USING (counter, ts)""",
    "hourly_ten": f"""SELECT g.counter, g.ts, coalesce(c.vehicles, 0) AS vehicles FROM (SELECT counter, ts FROM (SELECT DISTINCT user_id % 10 + 1 AS counter FROM events), (SELECT unnest(generate_series(TIMESTAMP '{FIRST}', TIMESTAMP '{LAST}', INTERVAL 1 HOUR)) AS ts)) g
LEFT JOIN (SELECT user_id % 10 + 1 AS counter, date_trunc('hour', ts) AS ts, count(*) AS vehicles FROM events GROUP BY 1, 2) c USING (counter, ts)""",
    "hourly_rain": "SELECT user_id // 10 % 10 + 1 AS station, date_trunc('hour', ts) AS ts, CAST((count(*) * 7 + hour(date_trunc('hour', ts))) % 4 AS INT) AS rain FROM events GROUP BY 1, 2",
    "five": "SELECT event_type AS source, user_id AS point, time_bucket(INTERVAL 5 MINUTE, ts) AS mark, ts, CAST(floor(value) AS BIGINT) AS vehicles FROM events",
    "daily": "SELECT l_suppkey AS counter, CAST(l_shipdate AS DATE) AS date, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS vehicles, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_quantity > 40), 0) AS BIGINT) AS large, count(*) AS lines FROM lineitem GROUP BY 1, 2",
    "flags": """SELECT l_orderkey AS k, l_linenumber AS line, CASE WHEN l_linenumber % 7 <> 0 THEN l_returnflag = 'R' END AS f1, CASE WHEN l_linenumber % 7 <> 0 THEN l_linestatus = 'O' END AS f2,
CASE WHEN l_linenumber <> 3 THEN CAST(l_quantity AS BIGINT) END AS small, CASE WHEN l_linenumber <> 5 THEN l_suppkey END AS large, CAST(l_linenumber AS BIGINT) AS rest, l_partkey AS total FROM lineitem""",
    "registry": "SELECT c_custkey AS counter, c_nationkey AS nation, 30 + (c_custkey * 7919 % 15000) / 1000 AS lat, 130 + (c_custkey * 104729 % 15000) / 1000 AS lon, c_acctbal AS size FROM customer",
    "stations": "SELECT s_suppkey AS station, 30 + (s_suppkey * 7919 % 15000) / 1000 AS lat, 130 + (s_suppkey * 104729 % 15000) / 1000 AS lon, s_suppkey % 3 <> 0 AS has_rain, s_acctbal AS s_size FROM supplier",
    "weather": "SELECT l_suppkey AS station, CAST(l_shipdate AS DATE) AS date, max(CAST(round(l_tax * 100) AS INT)) AS rain, CAST(min(l_linenumber) % 5 AS INT) AS rain_aqc FROM lineitem GROUP BY 1, 2",
    "edges": """SELECT a, b, km FROM (SELECT p_partkey AS a, p_partkey + 1 AS b, (p_size % 20) / 10 AS km FROM part UNION ALL SELECT p_partkey, p_partkey * 37 % (SELECT count(*) FROM part), (p_size % 20) / 10 FROM part)
WHERE b < (SELECT count(*) FROM part) AND a <> b""",
    "holidays": "SELECT date, CASE WHEN day(date) = month(date) + 1 THEN 'holiday' ELSE 'day ' || day(date) END AS name FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) WHERE day(date) - month(date) <= 2 AND day(date) >= month(date)",
}

#: Great-circle kilometres between (a.lat, a.lon) and (b.lat, b.lon).
KM = "2 * 6371.0 * asin(sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))"


def sql(views: str, body: str) -> str:
    """``body`` after the named views."""
    names = views.split()
    return ("WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names) + ("" if body.startswith(",") else " ") if names else "") + body
