"""Weather observations and stations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OBSERVATION = T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(T.DoubleType())))
STATION = T.MapType(T.StringType(), T.StructType([T.StructField("lat", T.ArrayType(T.DoubleType())), T.StructField("lon", T.ArrayType(T.DoubleType())), T.StructField("alt", T.DoubleType()), T.StructField("name", T.StringType())]))


def read_weather_json(df: DataFrame, obs_time: str, body: str, elements: Sequence[str]) -> DataFrame:
    """One row per station and observation of {station: {element: [value, flag]}} texts: each element with its flag, the hour that the
    observation ends, and ``unknown``, elements that aren't in the list. A text that isn't JSON gives no row."""
    s = df.select(obs_time, F.explode(F.from_json(body, OBSERVATION)).alias("station_id", "_e"))
    at = lambda e, i: F.get(F.try_element_at("_e", F.lit(e)), F.lit(i))
    cols = [x for e in elements for x in (at(e, 0).alias(e), at(e, 1).cast("int").alias(f"{e}_aqc"))]
    unknown = F.array_sort(F.array_except(F.map_keys("_e"), F.array(*[F.lit(e) for e in elements])))
    return s.select(obs_time, (F.col(obs_time) - F.expr("INTERVAL 1 HOUR")).alias("hour_start"), "station_id", *cols, unknown.alias("unknown"))


def read_stations_json(df: DataFrame, body: str) -> DataFrame:
    """Stations with positions of [degrees, minutes] as degrees, to five decimals."""
    s = df.select(F.explode(F.from_json(body, STATION)).alias("station_id", "_s"))
    degrees = lambda c: F.bround(F.col(f"_s.{c}")[0] + F.col(f"_s.{c}")[1] / 60, 5)
    return s.select("station_id", degrees("lat").alias("lat"), degrees("lon").alias("lon"), F.col("_s.alt").alias("alt_m"), F.col("_s.name").alias("name"))


def read_weather_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def latest_file(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the file whose name sorts last: the newest station table."""
    rows = spark.read.schema(schema).option("header", True).csv(path).select("*", F.col("_metadata.file_name").alias("_file"))
    last = rows.agg(F.max("_file").alias("_file"))
    return rows.join(F.broadcast(last), "_file", "left_semi").drop("_file")


def read_geocode_cache(df: DataFrame, address: str, body: str) -> DataFrame:
    """The first candidate of each address: lon, lat and title, null where there is none."""
    kind = "ARRAY<STRUCT<geometry: STRUCT<coordinates: ARRAY<DOUBLE>>, properties: STRUCT<title: STRING>>>"
    first = F.get(F.from_json(body, kind), F.lit(0))
    return df.select(address, first["geometry"]["coordinates"][0].alias("lon"), F.get(first["geometry"]["coordinates"], F.lit(1)).alias("lat"), first["properties"]["title"].alias("title"))
