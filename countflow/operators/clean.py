"""Cleaning of counts and observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countflow.functions import any_flag


def direction_volume(parts: Sequence[Column], flags: Sequence[Column] = (), total: Column | None = None, min_parts: int | None = None, unknown_flag: str = "dirty", null_as_zero: bool = False) -> Column:
    """The volume of one direction from its parts, under fault flags.

    ``min_parts``: how many of the parts must be known (all by default); the unknown others then count as nothing. ``total`` takes over
    where too few parts are known. A true flag blanks the volume; an unknown one does too, unless ``unknown_flag`` is "clean".
    ``null_as_zero`` makes what is unknown 0.
    """
    need = len(parts) if min_parts is None else min_parts
    known = sum((p.isNotNull().cast("int") for p in parts[1:]), parts[0].isNotNull().cast("int"))
    volume = sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0)))
    value = F.when(known >= need, volume)
    if total is not None:
        value = F.coalesce(value, total)
    if flags:
        value = F.when(F.coalesce(~any_flag(list(flags)), F.lit(unknown_flag == "clean")), value)
    return F.coalesce(value, F.lit(0)) if null_as_zero else value


def blank_unless_normal(df: DataFrame, elements: Sequence[str], suffix: str = "_aqc") -> DataFrame:
    """Each element's value only where its quality flag is 0."""
    return df.withColumns({e: F.when(F.col(e + suffix) == 0, F.col(e)) for e in elements})


def in_periods(df: DataFrame, ts: str, periods: DataFrame, margin_days: int = 1, out: str = "in_period") -> DataFrame:
    """``df`` with whether the day of ``ts`` lies in a period (first, last) widened by ``margin_days``, ends included.

    The periods become single days, which join by equality; a null time lies in none.
    """
    days = periods.select(F.explode(F.sequence(F.date_sub("first", margin_days), F.date_add("last", margin_days))).alias("_day")).distinct()
    return df.withColumn("_at", F.to_date(ts)).join(days, F.col("_at") == F.col("_day"), "left").withColumn(out, F.col("_day").isNotNull()).drop("_at", "_day")


def unify_layers(layers: Sequence[DataFrame], schema) -> DataFrame:
    """All layers in one schema and column order; columns that a layer lacks are typed nulls, unknown ones are an error."""
    fields = {f.name: f for f in schema.fields}
    out = None
    for layer in layers:
        if unknown := set(layer.columns) - set(fields):
            raise ValueError(f"columns outside the schema: {sorted(unknown)}")
        one = layer.select(*[(F.col(n) if n in layer.columns else F.lit(None)).cast(f.dataType).alias(n) for n, f in fields.items()])
        out = one if out is None else out.unionByName(one)
    return out
