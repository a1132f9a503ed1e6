"""Aggregations of counts, each with explicit rules for missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countflow.functions import safe_ratio
from countflow.operators.quantiles import medians


def full_group(value: Column, rows: Column, values: Column, expected: int) -> Column:
    """``value`` where a group has ``expected`` rows and all of them a value, else null."""
    return F.when((rows == expected) & (values == expected), value)


def daily_summary(df: DataFrame, keys: Sequence[str], ts: str, value: str, large: str | None = None, baseline: str | None = None, rain: str | None = None, temp: str | None = None, slots: int = 24) -> DataFrame:
    """One row per day and key: hours with a value, whether the day stands still, and for full, moving days the total, large
    total, peak hour (earliest of equals), baseline total (rounded) and ratio to it; rain total, wet hours and mean temperature of full days of weather.

    A day is full with ``slots`` rows that all have a value; it stands still if its total is below ``slots``. More rows than that stop the job.
    """
    hour = F.hour(ts)
    some = lambda c: F.col(c) if c else F.lit(None).cast("double")
    g = df.groupBy(F.to_date(ts).alias("date"), *keys).agg(
        F.count("*").alias("_rows"),
        F.count(value).alias("hours"),
        F.sum(value).alias("_total"),
        F.sum(some(large)).alias("_large"),
        F.count(some(large)).alias("_nl"),
        F.max_by(F.when(F.col(value).isNotNull(), hour), F.when(F.col(value).isNotNull(), F.struct(F.col(value), -hour))).alias("_peak"),
        F.sum(some(baseline)).alias("_base"),
        F.count(some(baseline)).alias("_nb"),
        F.sum(some(rain)).alias("_rain"),
        F.count(some(rain)).alias("_nr"),
        F.sum((some(rain) >= 1).cast("int")).alias("_wet"),
        F.avg(some(temp)).alias("_temp"),
        F.count(some(temp)).alias("_nt"),
    )
    rows = F.when(F.col("_rows") > slots, F.raise_error(F.format_string("%d rows in a day", "_rows")).cast("bigint")).otherwise(F.col("_rows"))
    g = g.withColumn("_rows", rows)
    full = (F.col("_rows") == slots) & (F.col("hours") == slots)
    still = full & (F.col("_total") < slots)
    moving = full & ~still
    base = F.when(moving & (F.col("_nb") == slots), F.bround("_base", 0))
    return g.select(
        "date",
        *keys,
        "hours",
        F.coalesce(still, F.lit(False)).alias("stopped"),
        F.when(moving, F.col("_total")).alias("total"),
        F.when(moving & (F.col("_nl") == slots), F.col("_large")).alias("large_total"),
        F.when(moving, F.col("_peak")).alias("peak_hour"),
        base.alias("baseline_total"),
        F.when(moving, safe_ratio(F.col("_total"), base, 3)).alias("vs_baseline"),
        full_group(F.col("_rain"), F.col("_rows"), F.col("_nr"), slots).alias("rain"),
        full_group(F.col("_wet"), F.col("_rows"), F.col("_nr"), slots).alias("wet_hours"),
        F.when(F.col("_nt") == slots, F.bround("_temp", 1)).alias("mean_temp"),
    )


def rollup_interval(df: DataFrame, keys: Sequence[str], ts: str, value: str, to: str = "hour") -> DataFrame:
    """Sum of the present values and their number per interval; the sum is null, not 0, where none is present."""
    return df.groupBy(*keys, F.date_trunc(to, ts).alias(to)).agg(F.sum(value).alias(value), F.count(value).alias("n"))


def duplicate_counts(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Per key: rows, and how many different values they have, null counting as one."""
    different = F.count_distinct(value) + F.max(F.col(value).isNull().cast("int"))
    return df.groupBy(*key).agg(F.count("*").alias("rows"), different.alias("different"), F.max(value).alias(value))


def resolve_duplicates(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """One row for each key whose rows agree; keys with different values, null included, are dropped. One aggregate of four figures, without a distinct count."""
    few = df.groupBy(*key).agg(F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(value).alias("_n"), F.count("*").alias("_rows"))
    agree = (F.col("_n") == 0) | ((F.col("_n") == F.col("_rows")) & (F.col("_low") == F.col("_high")))
    return few.filter(agree).select(*key, F.col("_high").alias(value))


def partition_quality(df: DataFrame, partition: str, key: str, ts_ok: str, value: str, value_ok: str, ts: str) -> DataFrame:
    """Counts of each partition and, with a null partition, of all: rows in, rows without a key, key 0, outside the time marks, bad value,
    repeats, conflicting keys and their rows, rows out and points. A row counts under the first thing that is wrong with it.

    One scan: rows are summed up by (partition, key, time), these by (partition, key), these by partition. Rows that are no candidates
    for a conflict share one group each kind and are summed up before the shuffle.
    """
    good_key = F.col(key).isNotNull() & (F.col(key) != 0)
    kind = F.when(F.col(key).isNull(), "no_key").when(F.col(key) == 0, "key_zero").when(good_key & ~F.col(ts_ok), "outside").when(good_key & F.col(ts_ok), "usable")
    own = lambda c: F.when(F.col("_kind") == "usable", F.col(c))
    good = F.when(F.col(value_ok), F.col(value))
    rows = df.select(F.col(partition).alias("partition"), kind.alias("_kind"), F.col(key).alias("_key"), F.col(ts).alias("_ts"), good.alias("_v"), (~F.col(value_ok)).alias("_bad"))
    keyed = rows.groupBy("partition", "_kind", own("_key").alias("_k"), own("_ts").alias("_t")).agg(F.count("*").alias("_n"), F.count("_v").alias("_known"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count_if("_bad").alias("_b"))
    usable, agree = F.col("_kind") == "usable", (F.col("_known") == 0) | ((F.col("_known") == F.col("_n")) & (F.col("_lo") == F.col("_hi")))
    count = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    by_key = keyed.groupBy("partition", "_k").agg(
        F.sum("_n").alias("rows_in"),
        *[count(F.col("_kind") == k, "_n").alias(k) for k in ("no_key", "key_zero", "outside")],
        count(usable, "_b").alias("bad_value"),
        F.coalesce(F.sum(F.when(usable & agree, F.col("_n") - 1)), F.lit(0)).alias("repeats"),
        F.count_if(usable & ~agree).alias("conflict_keys"),
        count(usable & ~agree, "_n").alias("conflict_rows"),
        F.count_if(usable & agree).alias("rows_out"),
    )
    sums = [c for c in by_key.columns if c not in ("partition", "_k")]
    return by_key.rollup("partition").agg(*[F.sum(c).alias(c) for c in sums], F.count_if(F.col("rows_out") > 0).alias("points"))


def point_profile(df: DataFrame, key: Sequence[str], attrs: Sequence[str], ts: str) -> DataFrame:
    """Per point: rows, first and last time, and of each attribute the most frequent non-empty value (the smallest of equals) and how
    many there are."""
    filled = {a: F.when(F.trim(F.col(a).cast("string")) != "", F.col(a).cast("string")) for a in attrs}
    aggs = [F.count("*").alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")]
    for a in attrs:
        aggs += [F.mode(filled[a], deterministic=True).alias(a), F.count_distinct(filled[a]).alias(f"n_{a}")]
    return df.groupBy(*key).agg(*aggs)


def mode_min(value: Column) -> Column:
    """The most frequent value, the smallest of equals."""
    return F.mode(value, deterministic=True)


def reports_element(df: DataFrame, station: str, flags: Sequence[str], share: float = 0.5) -> DataFrame:
    """Per station whether each flag is present in at least ``share`` of its rows."""
    return df.groupBy(station).agg(*[(F.avg(F.col(f).isNotNull().cast("int")) >= share).alias(f"reports_{f}") for f in flags])


def profile_by_slot(df: DataFrame, keys: Sequence[str], slot: Column, value: str, scale: float = 1.0, name: str = "slot") -> DataFrame:
    return df.groupBy(*keys, slot.alias(name)).agg((F.avg(value) * scale).alias("mean"), F.count(value).alias("n"))


def heat_table(df: DataFrame, row: Column, col: Column, value: str, cols: Sequence[int], row_name: str = "row") -> DataFrame:
    """Mean value by row and a fixed list of columns, which are named c0, c1 and so on."""
    out = df.select(row.alias(row_name), col.alias("_c"), value).groupBy(row_name).pivot("_c", list(cols)).agg(F.avg(value))
    return out.select(row_name, *[F.col(str(c)).alias(f"c{c}") for c in cols])


def ratio_of_sums(df: DataFrame, by: Sequence[str], num: str, den: str) -> DataFrame:
    """Sum of ``num`` over sum of ``den`` per group, over rows that have both."""
    both = F.col(num).isNotNull() & F.col(den).isNotNull()
    total = F.sum(F.when(both, F.col(den)))
    return df.groupBy(*by).agg((F.sum(F.when(both, F.col(num))) / F.nullif(total, F.lit(0))).alias("ratio"))


def usual_two_sided(df: DataFrame, keys: Sequence[str], value: str, min_n: int = 5, min_median: float = 20) -> DataFrame:
    """Median and number of values per group, for groups with enough of both."""
    return medians(df, value, keys, "usual").filter((F.col("n") >= min_n) & (F.col("usual") >= min_median))


def volume_profile(df: DataFrame, key: str, ts: str, up: str, down: str, large: str, weekday: Column, min_days: int = 5, slots: int = 24) -> DataFrame:
    """Per key over full weekdays: median daily volume and large volume, large share of 7-19 h, day/night ratio and share of direction up."""
    total = F.col(up) + F.col(down)
    h = F.hour(ts)
    day = F.when(h.between(7, 18), total)
    days = df.filter(weekday < 5).groupBy(key, F.to_date(ts).alias("date")).agg(
        F.count("*").alias("rows"), F.count(total).alias("n"), F.sum(total).alias("vol"), F.sum(large).alias("large"), F.sum(F.when(h.between(7, 18), F.col(large))).alias("large12"), F.sum(day).alias("vol12"), F.sum(up).alias("up")
    )
    full = days.filter((F.col("rows") == slots) & (F.col("n") == slots))
    return full.groupBy(key).agg(
        F.count("*").alias("days"),
        F.median("vol").alias("vol24"),
        F.median("large").alias("large24"),
        (F.sum("large12") / F.nullif(F.sum("vol12"), F.lit(0))).alias("large12_share"),
        (F.sum("vol") / F.nullif(F.sum("vol12"), F.lit(0))).alias("day_night"),
        (F.sum("up") / F.nullif(F.sum("vol"), F.lit(0))).alias("up_share"),
    ).filter(F.col("days") >= min_days)


def peak_share(df: DataFrame, key: str, ts: str, value: str, first: int = 7, last: int = 18) -> DataFrame:
    """Median over full days of the largest hour's share of the hours ``first`` .. ``last``."""
    h = F.hour(ts)
    days = df.filter(h.between(first, last)).groupBy(key, F.to_date(ts).alias("date")).agg(F.count(value).alias("n"), F.max(value).alias("top"), F.sum(value).alias("total"))
    full = days.filter((F.col("n") == last - first + 1) & (F.col("total") > 0))
    return full.groupBy(key).agg(F.median(F.col("top") / F.col("total")).alias("peak_share"), F.count("*").alias("days"))


def direction_share_gap(df: DataFrame, key: str, up: str, down: str, large_up: str, large_down: str) -> DataFrame:
    """Per key the large share of direction up minus that of direction down."""
    share = lambda a, b: F.sum(a) / F.nullif(F.sum(b), F.lit(0))
    return df.groupBy(key).agg((share(large_up, up) - share(large_down, down)).alias("gap"))


def coverage_by_day(df: DataFrame, ts: str, hit: Column) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.count_distinct(F.date_trunc("hour", ts)).alias("hours"), F.count_if(hit).alias("hits"))


def best_covered_day(coverage: DataFrame) -> DataFrame:
    """The day with most hours, then most hits, then the earliest; and of full days (24 hours) the one with most hits."""
    return coverage.agg(
        F.max_by("date", F.struct("hours", "hits", -F.unix_date("date"))).alias("best_day"),
        F.max_by(F.when(F.col("hours") == 24, F.col("date")), F.when(F.col("hours") == 24, F.struct("hits", -F.unix_date("date")))).alias("best_full_day"),
    )


def latest_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``."""
    cols = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return best.select(*key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def first_last(df: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*key).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def pooled_effect(df: DataFrame, by: Sequence[str], ratio: str, min_n: int, weight: str | None = None) -> DataFrame:
    """Number and median of the ratio per class; the median is null below ``min_n``. ``weight``: how often a row counts, once if not given."""
    g = medians(df, ratio, by, "_m", weight)
    return g.select(*by, "n", F.when(F.col("n") >= min_n, F.col("_m")).alias("median"))


def share_where(df: DataFrame, cond: Column, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows for which the condition holds; rows for which it is unknown count in neither."""
    return df.groupBy(*by).agg(F.avg(cond.cast("int")).alias("share"), F.count(cond.cast("int")).alias("n"))


def error_scores(df: DataFrame, actual: str, predicted: str, kind: str) -> DataFrame:
    """WAPE and mean absolute error per kind and, as ``all``, over all rows that have both values."""
    err = F.abs(F.col(actual) - F.col(predicted))
    rows = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    both = rows.withColumn("_kind", F.explode(F.array(F.col(kind).cast("string"), F.lit("all"))))
    return both.groupBy(F.col("_kind").alias("kind")).agg((F.sum(err) / F.nullif(F.sum(actual), F.lit(0))).alias("wape"), F.avg(err).alias("mae"), F.count("*").alias("n"))


def completeness(df: DataFrame, expected: DataFrame, day: str, code: str, thin: float = 0.8) -> DataFrame:
    """Per day: codes present and expected, codes with under ``thin`` times the day's upper median of rows, and a status: empty, settled (all
    there, none thin), retry (some lacking), keep (all there, some thin)."""
    n = df.groupBy(day, code).agg(F.count("*").alias("_n"))
    w = n.groupBy(day).agg(F.array_sort(F.collect_list("_n")).alias("_all")).select(day, F.get("_all", F.floor(F.size("_all") / 2).cast("int")).alias("_median"))
    got = n.join(w, day).groupBy(day).agg(F.count("*").alias("present"), F.count_if(F.col("_n") < thin * F.col("_median")).alias("thin"))
    want = expected.groupBy(day).agg(F.count_distinct(code).alias("expected"))
    out = want.join(got, day, "left").na.fill(0, ["present", "thin"])
    status = F.when(F.col("present") == 0, "empty").when(F.col("present") < F.col("expected"), "retry").when(F.col("thin") > 0, "keep").otherwise("settled")
    return out.select(day, "expected", "present", "thin", (F.col("expected") - F.col("present")).alias("lacking"), status.alias("status"))


def band_crosstab(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """Median and count by row class and column class, in long form."""
    return df.groupBy(row, col).agg(F.median(value).alias("median"), F.count(value).alias("n"))
