"""Column expressions for counter data; each takes and returns Columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def parse_time_code(col: Column, formats: Sequence[str]) -> Column:
    """Text to timestamp_ntz by the first format that fits; text that fits none is null."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(col), F.lit(f)) for f in formats]).cast("timestamp_ntz")


def coded_flag(col: Column) -> Column:
    """'1' true, '0' false, empty or null unknown. Other codes are unknown too; ``gates.check_domain`` finds them."""
    return F.when(col == "1", True).when(col == "0", False)


def coded_int(col: Column, allowed: Sequence[int]) -> Column:
    return F.when(col.isin([str(a) for a in allowed]), col.try_cast("int"))


def safe_int(col: Column, low: int, high: int, kind: str = "int") -> Column:
    """The integer that the text states in ASCII digits, if it is within the limits, else null."""
    n = F.when(F.trim(col).rlike("^[+-]?[0-9]+$"), F.trim(col).try_cast("bigint"))
    return F.when(n.between(low, high), n).cast(kind)


def both_directions(up: Column, down: Column) -> Column:
    """The sum, null where either is."""
    return up + down


def any_flag(flags: Sequence[Column]) -> Column:
    """True if any is, false if all are false, else unknown."""
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return out


def ten_day_chunk(date: Column) -> Column:
    """The ten-day part of the month: YYYY-MM_01-10, 11-20 or 21 to the last day."""
    last = F.date_format(F.last_day(date), "dd")
    day = F.day(date)
    part = F.when(day <= 10, F.lit("01-10")).when(day <= 20, F.lit("11-20")).otherwise(F.concat(F.lit("21-"), last))
    return F.concat(F.date_format(date, "yyyy-MM"), F.lit("_"), part)


def valid_time_mark(ts: Column, start: Column, end: Column, minutes: int = 5) -> Column:
    """Within [start, end) and on a mark of the step; null is not valid."""
    on = (F.minute(ts) % minutes == 0) & (F.second(ts) == 0)
    return F.coalesce((ts >= start) & (ts < end) & on, F.lit(False))


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """box: west, south, east, north, with its edges."""
    return lon.between(box[0], box[2]) & lat.between(box[1], box[3])


def is_workday(weekday: Column, holiday: Column) -> Column:
    return (weekday < 5) & ~holiday


def norm_address(address: Column, prefix: Column) -> Column:
    """Without spaces of either width, beginning with ``prefix``."""
    bare = F.regexp_replace(address, "[ 　]", "")
    return F.when(bare.startswith(prefix), bare).otherwise(F.concat(prefix, bare))


def norm_town(town: Column) -> Column:
    """Without a leading 字 and a trailing block number."""
    return F.regexp_replace(F.regexp_replace(town, "^字", ""), "[0-9０-９一二三四五六七八九十]+丁目$", "")


def measured_only(value: Column, flag: Column) -> Column:
    """The number that ``value`` states where it was measured (flag 1) and is above zero."""
    v = value.cast("string").try_cast("double")
    return F.when((flag.cast("string") == "1") & (v > 0), v)


def band(value: Column, edges: Sequence[float], labels: Sequence[str], right_closed: bool = True) -> Column:
    """The label of the band (edge, next edge], or [edge, next edge) if not ``right_closed``; null outside. One label fewer than edges."""
    out = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(edges, edges[1:], labels))):
        inside = (value > low) & (value <= high) if right_closed else (value >= low) & (value < high)
        out = F.when(inside, F.lit(name)).otherwise(out)
    return out


def log_ratio(num: Column, den: Column) -> Column:
    """log(num / den) where both are above zero, else null."""
    return F.when((num > 0) & (den > 0), F.log(num) - F.log(den))


def safe_ratio(num: Column, den: Column, digits: int = 3) -> Column:
    """num / den to ``digits`` places, halves to even; null where ``den`` is null or zero."""
    return F.bround(num / F.nullif(den, F.lit(0)), digits)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    dlat, dlon = (b - a) / 2, F.radians(lon2 - lon1) / 2
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.pow(F.sin(dlat), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(dlon), 2)))


def day_class(weekday: Column, holiday: Column) -> Column:
    """0 (Monday) .. 6; holidays count as Sunday."""
    return F.when(holiday, 6).otherwise(weekday)


def customary_break(date: Column) -> Column:
    """The days of mid-August and of the turn of the year on which people are customarily off; empty on other days, null without a date."""
    md = F.month(date) * 100 + F.day(date)
    return F.when(md.between(813, 816), "obon").when((md >= 1229) | (md <= 103), "new_year").when(md.isNotNull(), "")


def register_sql_functions(spark: SparkSession) -> None:
    """``haversine_km`` and ``ten_day_chunk`` for SQL text, as SQL functions of the session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION haversine_km(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE RETURN "
        f"2 * {EARTH_KM} * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION ten_day_chunk(d DATE) RETURNS STRING RETURN concat(date_format(d, 'yyyy-MM'), '_', "
        "CASE WHEN day(d) <= 10 THEN '01-10' WHEN day(d) <= 20 THEN '11-20' ELSE concat('21-', date_format(last_day(d), 'dd')) END)"
    )
