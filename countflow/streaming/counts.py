"""Incremental forms of the counter operators as Structured Streaming queries.

Each gives what the batch operator gives on the same files. Watermarks need TIMESTAMP, so times are cast at the edge (session time zone UTC).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from countflow.operators.matching import attach_registry
from countflow.operators.windows import baseline


def stream_counts(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", max_files: int = 100) -> DataFrame:
    """Files as they arrive, in any order, by a fixed schema."""
    return spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", max_files).format(fmt).load(path)


def stream_rollup(df: DataFrame, keys: Sequence[str], ts: str, value: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Sum and number of present values per interval, once no more late rows are waited for."""
    g = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(*keys, F.window(ts, width).alias("_w"))
    return g.agg(F.sum(value).alias(value), F.count(value).alias("n")).select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("hour"), value, "n")


def stream_dedup(df: DataFrame, key: Sequence[str], ts: str, value: str, late: str = "2 hours") -> DataFrame:
    """One row for each key whose rows agree, null counting as a value; others are dropped. ``ts`` is part of the key. State is a few figures a key, until the watermark passes."""
    g = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(*key, F.window(ts, "1 second").alias("_w"))
    few = g.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(value).alias("_n"), F.count("*").alias("_rows"))
    agree = ((F.col("_n") == F.col("_rows")) & (F.col("_lo") == F.col("_hi"))) | (F.col("_n") == 0)
    return few.filter(agree).select(*key, F.col("_w.start").cast("timestamp_ntz").alias(ts), F.col("_hi").alias(value))


def stream_completeness(df: DataFrame, ts: str, expected_hours: int = 24, late: str = "1 day") -> DataFrame:
    """Per day the hours that have come and whether all have, emitted when the watermark passes the day."""
    day = F.window(ts, "1 day").alias("_w")
    g = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(day).agg(F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(ts)))).alias("hours"), F.count("*").alias("rows"))
    status = F.when(F.col("hours") >= expected_hours, "settled").otherwise("keep")
    return g.select(F.to_date("_w.start").alias("day"), "hours", "rows", status.alias("status"))


def stream_stopped(df: DataFrame, keys: Sequence[str], ts: str, value: str, slots: int = 24, late: str = "2 hours") -> DataFrame:
    """Days with a value in every slot and a total below their number, each in the batch that brings its last slot, whatever the watermark.

    State is kept for each key and day: which slots have come, their total, and whether the day is full. Its timer goes off when the watermark passes the day's end, and the state goes. A slot
    counts once: a later row for it changes nothing, and of several in a batch the smallest value counts. A null value leaves its slot open.
    """
    seconds = 86_400 // slots
    t = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).withColumn("_date", F.to_date(ts)).filter(F.col(value).isNotNull())
    at = F.unix_timestamp(ts) - F.unix_timestamp(F.col("_date").cast("timestamp"))
    t = t.withColumn("_slot", F.floor(at / seconds).cast("int")).withColumn("_end", (F.unix_timestamp(F.date_add("_date", 1).cast("timestamp")) * 1000))
    out = T.StructType([*(df.schema[k] for k in keys), T.StructField("date", T.DateType()), T.StructField("total", T.LongType())])
    state_schema = T.StructType([T.StructField("slots", T.StringType()), T.StructField("total", T.LongType()), T.StructField("full", T.BooleanType())])

    def take(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, total, full = state.get if state.exists else ("0", 0, False)
        seen, end = int(seen, 16), 0
        for part in parts:
            end = int(part["_end"].iloc[0])
            first = part.sort_values(["_slot", value]).drop_duplicates("_slot")
            for slot, v in zip(first["_slot"].tolist(), first[value].tolist()):
                if not seen >> slot & 1:
                    seen, total = seen | 1 << slot, total + int(v)
        if seen.bit_count() == slots and not full:
            full = True
            if total < slots:
                yield pd.DataFrame([[*key, total]], columns=[*keys, "date", "total"])
        if end > state.getCurrentWatermarkMs():
            state.update((f"{seen:x}", total, full))
            state.setTimeoutTimestamp(end)
        elif state.exists:
            state.remove()

    return t.groupBy(*keys, "_date").applyInPandasWithState(take, out, state_schema, "append", GroupStateTimeout.EventTimeTimeout)


def baseline_batch(archive: str, keys: Sequence[str], day: str, value: str, lookback: int = 35, **options) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the baseline of a batch of whole days from it and the archive's ``lookback`` days before it; the batch is then added
    to the archive (Parquet by day, which a repeated batch overwrites). Days must come in order."""

    def run(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        span = batch.agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
        if span["a"] is None:
            return
        try:
            old = spark.read.parquet(archive).select(batch.columns).filter(F.col(day).between(F.date_sub(F.lit(span["a"]), lookback), F.date_sub(F.lit(span["a"]), 1)))
        except Exception as e:  # no archive before the first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = batch.limit(0)
        both = old.withColumn("_old", F.lit(True)).unionByName(batch.withColumn("_old", F.lit(False)))
        done = baseline(both, keys, day, value, lookback=lookback, **options).filter(~F.col("_old")).drop("_old")
        done.withColumn("_part", F.col(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(archive)

    return run


def registry_batch(path: Callable[[int], str], key: Sequence[str], cols: Sequence[str], schema: T.StructType, last_seen: str = "last_seen") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps a registry: version k is written to ``path(k)`` from version k - 1 and batch k, so a repeated batch gives the same table."""

    def run(batch: DataFrame, k: int) -> None:
        spark = batch.sparkSession
        old = spark.read.schema(schema).parquet(path(k - 1)) if k else spark.createDataFrame([], schema)
        latest = batch.groupBy(*key).agg(F.max_by(F.struct(*cols), F.col(last_seen)).alias("_r"), F.max(last_seen).alias(last_seen)).select(*key, *[F.col(f"_r.{c}").alias(c) for c in cols], last_seen)
        attach_registry(latest, old, key, cols, last_seen).write.mode("overwrite").parquet(path(k))

    return run
