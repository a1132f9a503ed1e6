"""The calendar table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countflow.functions import customary_break
from countflow.operators.windows import between_named, next_flag, run_length


def build_calendar(holidays: DataFrame, first: str | None = None, last: str | None = None, generic: str = "holiday", between: str = "citizens' holiday", substitute: str = "substitute holiday") -> DataFrame:
    """One row per day from ``first`` to ``last``, or without them of all years that have a holiday: weekday, holiday and its name, day_off, days_off_in_run, next_day_off, customary_break.

    ``holidays`` (date, name); days named ``generic`` get the name of their kind. Runs at the ends are cut there, and the last day's next day counts as
    a working one. Windows run in one partition: a calendar has some thousand rows. Without holidays or a span it is empty.
    """
    spark: SparkSession = holidays.sparkSession
    span = holidays.agg(F.trunc(F.min("date"), "year").alias("a"), F.last_day(F.make_date(F.year(F.max("date")), F.lit(12), F.lit(1))).alias("b"))  # one row
    if first is not None and last is not None:
        span = spark.range(1).select(F.lit(first).cast("date").alias("a"), F.lit(last).cast("date").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("date"), F.lit(0).alias("_all"))
    cal = days.join(holidays.select("date", F.col("name").alias("holiday_name")), "date", "left")
    cal = cal.withColumn("is_holiday", F.col("holiday_name").isNotNull()).withColumn("weekday", F.weekday("date"))
    cal = between_named(cal, ["_all"], "date", "is_holiday", "holiday_name", generic, between, substitute)
    cal = cal.withColumn("day_off", F.col("is_holiday") | (F.col("weekday") >= 5))
    cal = run_length(cal, ["_all"], "date", "day_off", "days_off_in_run")
    cal = next_flag(cal, ["_all"], "date", "day_off", "next_day_off")
    return cal.withColumn("customary_break", customary_break(F.col("date"))).select("date", "weekday", "is_holiday", "holiday_name", "day_off", "days_off_in_run", "next_day_off", "customary_break")


def holiday_names(df: DataFrame, names: DataFrame, name: str = "name", english: str = "name_en") -> DataFrame:
    """``df`` with English names; a name without one stops the job."""
    out = df.join(names.select(name, english), name, "left")
    return out.withColumn(english, F.when(F.col(name).isNotNull() & F.col(english).isNull(), F.raise_error(F.concat(F.lit("no English name: "), F.col(name)))).otherwise(F.col(english)))


def clip_calendar(calendar: DataFrame, facts: DataFrame, ts: str) -> DataFrame:
    """Only the days from the first to the last of the facts."""
    span = facts.agg(F.min(F.to_date(F.col(ts))).alias("_first"), F.max(F.to_date(F.col(ts))).alias("_last"))
    return calendar.crossJoin(F.broadcast(span)).filter(F.col("date").between(F.col("_first"), F.col("_last"))).drop("_first", "_last")
