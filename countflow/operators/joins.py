"""Joins of facts with dimensions, neighbours in space and neighbours in time."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.functions import haversine_km
from countflow.operators.sets import assert_unique
from countflow.session import checkpoint, shuffle_partitions

#: Kilometres of one degree of latitude, a little less than on the sphere of radius 6371 so that cells are never too small.
DEGREE_KM = 111.0
EARTH_KM = 6371.0
#: Keys of one place that go together, about.
LIST = 1000
#: Differences of values that rounding may make equal.
CLOSE = 1e-8


def attach_dimension(df: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """``df`` with the columns of ``dim``. A key that ``dim`` has twice stops the job, so rows are never multiplied. Spark
    broadcasts ``dim`` where its size allows."""
    return df.join(assert_unique(dim, on), list(on), how)


def attach_calendar(df: DataFrame, calendar: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("date", F.to_date(ts)).join(calendar, "date", "left")


def unknown_keys(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """The keys of ``df`` that ``dim`` lacks, once each."""
    return df.select(*on).distinct().join(dim, list(on), "left_anti")


def semi_filter(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys, list(on), "left_semi")


def asof_prior(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, value: str, strict: bool = True) -> DataFrame:
    """``left`` with the ``value`` of the last ``right`` row of the same key that is earlier (or as early, if not ``strict``). Null values of the right
    rows are passed over.

    Both sides meet in one window over the key, in order of time: one shuffle, no pairs.
    """
    cols = [c for c in left.columns]
    a = left.select(*cols, F.lit(None).cast(right.schema[value].dataType).alias("_value"), F.lit(0 if strict else 1).alias("_side"), F.lit(True).alias("_left"))
    b = right.select(*[F.col(c) if c in (*by, on) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in cols], F.col(value).alias("_value"), F.lit(1 if strict else 0).alias("_side"), F.lit(False).alias("_left"))
    w = Window.partitionBy(*by).orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = a.unionByName(b).withColumn(f"prior_{value}", F.last("_value", ignorenulls=True).over(w))
    return both.filter("_left").select(*cols, f"prior_{value}")


def _cells_around(row: Column, km: float) -> Column:
    """How many cells a row of the grid has. Two points within ``km``, one in this row and the other in it or next to it, differ by at most one cell's width in longitude,
    so cells get wider towards the poles, and a row near a pole is one cell."""
    step = km / DEGREE_KM
    highest = F.greatest(F.abs((row - 1) * step), F.abs((row + 2) * step))
    half = math.sin(min(math.pi / 2, km * 1.001 / (2 * EARTH_KM)))
    part = F.lit(half) / F.cos(F.radians(highest))
    return F.when((highest >= 90) | (part >= 1), F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(180 / F.degrees(F.asin(part))))).cast("bigint")


def _cell(lon: str, around: Column) -> Column:
    return F.pmod(F.floor(F.pmod(F.col(lon) + 180, F.lit(360.0)) / 360 * around), around)


def _cells(df: DataFrame, lat: str, lon: str, km: float, spread: bool) -> DataFrame:
    """``df`` with its cell (_y, _x) of a grid whose rows are at least ``km`` high; or, if ``spread``, once for each cell that may hold a point within ``km``."""
    row = F.floor(F.col(lat) / (km / DEGREE_KM))
    if not spread:
        return df.withColumn("_y", row).withColumn("_x", _cell(lon, _cells_around(row, km)))
    out = df.withColumn("_y", F.explode(F.array(row - 1, row, row + 1)))
    n = _cells_around(F.col("_y"), km)
    return out.withColumn("_x", F.explode(F.array_distinct(F.array(*[F.pmod(_cell(lon, n) + k, n) for k in (-1, 0, 1)]))))


def within_km(left: DataFrame, right: DataFrame, km: float, lat: str = "lat", lon: str = "lon", on: Sequence[str] = (), prefix: str = "r_") -> DataFrame:
    """All pairs of rows within ``km`` (column ``km``), with equal values in ``on``; the right row's columns get ``prefix``.

    Right rows go to the cells around theirs, at most nine, and meet left rows by an equality of cells, so only near rows are compared. Cells are as wide as each latitude needs, and the
    first and the last of a row are neighbours, so pairs near the poles and over the 180th meridian are found like others. Rows without a position pair with none. Left rows are dealt out first: few bytes may make many pairs.
    """
    a = _cells(left.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).repartition(shuffle_partitions(left.sparkSession)), lat, lon, km, False)
    b = right.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    b = _cells(b, lat, lon, km, True).select(*[F.col(c).alias(prefix + c) if c not in ("_x", "_y") else F.col(c) for c in [*right.columns, "_x", "_y"]])
    for c in on:
        b = b.withColumnRenamed(prefix + c, c)
    d = haversine_km(F.col(lat), F.col(lon), F.col(prefix + lat), F.col(prefix + lon))
    return a.join(b, [*on, "_y", "_x"]).withColumn("km", d).filter(F.col("km") <= km).drop("_y", "_x")


def near_places(left: DataFrame, right: DataFrame, km: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(place, r_place, km): the places (structs of latitude and longitude) of ``left`` and of ``right`` that are within ``km``, once each, however many rows stand there."""
    pairs = within_km(left.select(lat, lon).distinct(), right.select(lat, lon).distinct(), km, lat, lon)
    return pairs.select(place(lat, lon).alias("place"), place("r_" + lat, "r_" + lon, lat, lon).alias("r_place"), "km")


def place(lat: str = "lat", lon: str = "lon", *names: str) -> Column:
    """A position as a struct; ``names``: its fields', if not those of the columns."""
    return F.struct(*[F.col(c).alias(n) for c, n in zip((lat, lon), names or (lat, lon))])


def pairs_within_km(df: DataFrame, key: str, km: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(a, b, km), a < b: the keys of all rows within ``km`` of each other. Places are compared once each; only pairs of the result are made."""
    near = near_places(df, df, km, lat, lon).filter("place <= r_place")
    rows = df.select(place(lat, lon).alias("place"), F.col(key).alias("k"))
    both = near.join(rows.withColumnRenamed("k", "_a"), "place").join(rows.select(F.col("place").alias("r_place"), F.col("k").alias("_b")), "r_place")
    return both.filter((F.col("place") < F.col("r_place")) & (F.col("_a") != F.col("_b")) | (F.col("_a") < F.col("_b"))).select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), "km")


def keys_within_km(left: DataFrame, right: DataFrame, left_key: str, right_key: str, km: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(left_key, right_key, km): the keys of all pairs of rows within ``km``. Places are compared once each and carry their keys in lists of at most ``LIST``, so what is shuffled are lists of keys by pairs of places; the pairs of
    rows, which the result has, are made where they are read."""

    def lists(df: DataFrame, key: str, at: str, out: str) -> DataFrame:
        rows = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(place(lat, lon).alias(at), F.col(key).alias("_k"))
        many = rows.groupBy(at).agg(F.ceil(F.count("*") / LIST).alias("_lists"))
        return rows.join(many, at).groupBy(at, F.pmod(F.xxhash64("_k"), F.col("_lists")).alias("_list")).agg(F.collect_list(F.struct("_k")).alias(out)).drop("_list")

    near = near_places(left, right, km, lat, lon)
    both = near.join(lists(right, right_key, "r_place", "_rights"), "r_place").join(lists(left, left_key, "place", "_lefts"), "place")
    return both.select("km", "_lefts", F.explode("_rights").alias("_r")).select("km", "_r", F.explode("_lefts").alias("_l")).select(F.col("_l._k").alias(left_key), F.col("_r._k").alias(right_key), "km")


def closest_within_km(left: DataFrame, right: DataFrame, km: float, value: str, most: int, lat: str = "lat", lon: str = "lon", prefix: str = "r_") -> DataFrame:
    """Pairs of rows as ``within_km`` (without the distance), but of a left row's partners only those whose ``value`` is among the ``most`` closest to its own, or as close up to ``CLOSE``. Values aren't null.

    Places are compared once each. The rows near a place meet there in order of their values, where the closest are looked up, so no other pairs are made. Places of many left rows are dealt into parts.
    """
    left, right = (t.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()) for t in (left, right))
    part = left.groupBy(lat, lon).agg(F.ceil(F.count("*") / (100 * LIST)).alias("_parts"))
    own = left.join(part, [lat, lon]).withColumn("_part", F.pmod(F.xxhash64(value), F.col("_parts"))).drop("_parts")
    near = near_places(left, right, km, lat, lon).select(F.col(f"place.{lat}").alias(lat), F.col(f"place.{lon}").alias(lon), F.col(f"r_place.{lat}").alias(prefix + lat), F.col(f"r_place.{lon}").alias(prefix + lon))
    near = near.join(part, [lat, lon]).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))).drop("_parts")
    others = near.join(right.select([F.col(c).alias(prefix + c) for c in right.columns]), [prefix + lat, prefix + lon])
    mine, theirs = left.columns, [prefix + c for c in right.columns]
    schema = T.StructType([*left.select(mine).schema.fields, *others.select(theirs).schema.fields])

    def closest(a: pa.Table, b: pa.Table) -> pa.Table:
        x, y = a.column(value).to_numpy(), b.column(prefix + value).to_numpy()
        order = np.argsort(y, kind="stable")
        y = y[order]
        at = np.searchsorted(y, x)[:, None] + np.arange(-most, most)
        far = np.where((at >= 0) & (at < len(y)), np.abs(y.take(at, mode="clip") - x[:, None]) if len(y) else np.inf, np.inf)
        reach = np.sort(far, axis=1)[:, most - 1] + CLOSE
        low, high = np.searchsorted(y, x - reach, "left"), np.searchsorted(y, x + reach, "right")
        n = high - low
        l = np.repeat(np.arange(len(x)), n)
        r = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        a, b = a.select(mine).take(pa.array(l, pa.int64())), b.select(theirs).take(pa.array(order[r], pa.int64()))
        return pa.table([*a.columns, *b.columns], schema=pa.schema([*a.schema, *b.schema]))

    keys = [lat, lon, "_part"]
    return own.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInArrow(closest, schema)


def nearest_within(left: DataFrame, right: DataFrame, left_key: str, right_key: str, km: float, order: Column | None = None, eligible: Column | None = None, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """``left`` with ``{right_key}`` and ``{right_key}_km`` (two decimals) of the nearest eligible right row within ``km``; null where there is
    none. Of equally near ones the first by ``order`` (by key, if not given).

    Each place of ``left`` is looked up once, and of the right rows at one place only the first counts."""
    r = right if eligible is None else right.filter(eligible)
    r = r.withColumn("_order", order if order is not None else F.col(right_key))
    first = r.groupBy(lat, lon).agg(F.min(F.struct("_order", F.col(right_key).alias("key"))).alias("_f"))
    pairs = within_km(left.select(lat, lon).distinct(), first, km, lat, lon)
    best = pairs.groupBy(place(lat, lon).alias("_place")).agg(F.min(F.struct("km", "r__f")).alias("_b"))
    out = left.withColumn("_place", place(lat, lon)).join(best, "_place", "left").withColumn(right_key, F.col("_b.r__f.key")).withColumn(right_key + "_km", F.bround("_b.km", 2))
    return out.select(*[c for c in left.columns if c not in (right_key, right_key + "_km")], right_key, right_key + "_km")


def shift_join(df: DataFrame, keys: Sequence[str], date: str, cols: Sequence[str], days: int) -> DataFrame:
    """``df`` with each of ``cols`` as it was exactly ``days`` calendar days earlier for the same key (``{col}_lag{days}``)."""
    old = df.select(*keys, F.date_add(date, days).alias(date), *[F.col(c).alias(f"{c}_lag{days}") for c in cols])
    return df.join(old, [*keys, date], "left")


def neighbour_join(df: DataFrame, edges: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """(key, ts, neighbours, neighbour_mean): the mean of ``value`` over the neighbours of each key at each time that any of them has one.
    ``edges`` (a, b) count in both directions."""
    both = edges.select(F.col("a").alias(key), F.col("b").alias("_n")).union(edges.select(F.col("b").alias(key), F.col("a").alias("_n"))).distinct()
    near = both.join(df.select(F.col(key).alias("_n"), ts, value), "_n")
    return near.groupBy(key, ts).agg(F.count(value).alias("neighbours"), F.avg(value).alias("neighbour_mean"))


def pair_series_join(df: DataFrame, pairs: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """(a, b, ts, value_a, value_b) at the times that both have a value."""
    v = df.filter(F.col(value).isNotNull())
    x = v.select(F.col(key).alias("a"), ts, F.col(value).alias("value_a"))
    y = v.select(F.col(key).alias("b"), ts, F.col(value).alias("value_b"))
    return pairs.select("a", "b").join(x, "a").join(y, ["b", ts]).select("a", "b", ts, "value_a", "value_b")


def swap_candidates(matches: DataFrame, key: str, own: str, other: str, check: Column | None = None, least: int = 2) -> DataFrame:
    """Pairs a < b of matches to be swapped: the text ``own`` (a town, of ``least`` characters or more) stands in the other's text ``other`` (a section's address) for both, and
    in its own for neither. ``check`` is a further condition on the structs x (the row a) and y (the row b). Of the pairs in order of (a, b), each is taken if neither of
    its ends is in one taken before.

    Containment is an equality join of towns with the substrings of addresses that are as long as some town. Without a ``check``, and if no two rows share a key, rows of equal texts are one class, and classes are paired instead of rows
    (``_swap_classes``). With one the pairs are taken in rounds: one that comes first at both its ends is taken, and those that touch it go; the rounds end when none is left.
    """
    if check is None and not matches.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").limit(1).count():
        return _swap_classes(matches, key, own, other, least)
    row = F.struct(*[F.col(c) for c in matches.columns])
    m = matches.filter((F.char_length(own) >= least) & F.col(other).isNotNull() & ~F.contains(other, own)).select(F.col(key).alias("k"), F.col(own).alias("t"), F.col(other).alias("o"), row.alias("row"))
    lengths = m.agg(F.array_sort(F.collect_set(F.char_length("t"))).alias("_n"))  # one row
    parts = F.flatten(F.transform("_n", lambda n: F.when(F.char_length("o") >= n, F.transform(F.sequence(F.lit(1), F.char_length("o") - n + 1), lambda i: F.substr("o", i, n))).otherwise(F.array().cast("array<string>"))))
    inside = m.crossJoin(F.broadcast(lengths)).select(F.col("k").alias("b"), F.col("row").alias("y"), F.col("t").alias("_tb"), F.explode(F.array_distinct(parts)).alias("_p"))
    pairs = m.select(F.col("k").alias("a"), F.col("row").alias("x"), F.col("t").alias("_p"), F.col("o").alias("_oa")).join(inside, "_p").filter((F.col("a") < F.col("b")) & F.contains("_oa", "_tb"))
    left = checkpoint((pairs if check is None else pairs.filter(check)).select("a", "b").distinct())
    taken = left.limit(0)
    while left.limit(1).count():
        ends = left.select(F.col("a").alias("n"), F.struct("a", "b").alias("e")).union(left.select("b", F.struct("a", "b")))
        first = ends.groupBy("n").agg(F.min("e").alias("e"))
        both = first.groupBy("e").agg(F.count("*").alias("c")).filter("c = 2").select("e.a", "e.b")
        taken = checkpoint(taken.union(both))
        gone = both.select(F.col("a").alias("n")).union(both.select("b"))
        left = checkpoint(left.join(gone.select(F.col("n").alias("a")), "a", "left_anti").join(gone.select(F.col("n").alias("b")), "b", "left_anti").select("a", "b"))
    return taken


def _swap_classes(matches: DataFrame, key: str, own: str, other: str, least: int) -> DataFrame:
    """``swap_candidates`` by classes of rows with equal texts, for keys that no two rows share.

    Of two classes that may swap, the rows of lowest keys are the first pair. So while both classes' lowest keys come before those of all other classes that either may swap with, the first row of one pairs with the
    first of the other, the second with the second, and so on: a round takes all of these at once, for all such pairs of classes. Classes that swap only with each other take one round, whatever their size.
    """
    rows = matches.filter((F.char_length(own) >= least) & F.col(other).isNotNull() & ~F.contains(other, own) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.struct(F.col(own).alias("t"), F.col(other).alias("o")).alias("c"))
    rows = checkpoint(rows)
    classes = checkpoint(rows.select("c").distinct())
    m = classes.select("c", "c.t", "c.o")
    lengths = m.agg(F.array_sort(F.collect_set(F.char_length("t"))).alias("_n"))  # one row
    parts = F.flatten(F.transform("_n", lambda n: F.when(F.char_length("o") >= n, F.transform(F.sequence(F.lit(1), F.char_length("o") - n + 1), lambda i: F.substr("o", i, n))).otherwise(F.array().cast("array<string>"))))
    inside = m.crossJoin(F.broadcast(lengths)).select(F.col("c").alias("d"), F.col("t").alias("_td"), F.explode(F.array_distinct(parts)).alias("_p"))
    links = checkpoint(m.select("c", F.col("t").alias("_p"), F.col("o").alias("_oc")).join(inside, "_p").filter(F.contains("_oc", "_td")).select("c", "d"))  # both ways
    left = checkpoint(rows.join(links.select("c").distinct(), "c", "left_semi"))
    taken = left.limit(0).select(F.col("k").alias("a"), F.col("k").alias("b"))
    while True:
        heads = left.groupBy("c").agg(F.min("k").alias("head"))
        ends = links.join(heads.select("c"), "c", "left_semi").join(heads.withColumnRenamed("c", "d"), "d")
        w = Window.partitionBy("c").orderBy("head")
        best = checkpoint(ends.select("c", "d", F.row_number().over(w).alias("_r"), F.lead("head").over(w).alias("other")).filter("_r = 1").select("c", "d", "other"))
        back = best.select(F.col("c").alias("d"), F.col("d").alias("c"), F.col("other").alias("own"))
        mutual = checkpoint(best.join(back, ["c", "d"]).filter("c < d"))
        if not mutual.limit(1).count():
            return taken
        sides = mutual.select("c", "c", "other").toDF("c", "pair", "bound").withColumn("first", F.lit(True)).unionByName(mutual.select("d", "c", "own").toDF("c", "pair", "bound").withColumn("first", F.lit(False)))
        placed = left.join(sides, "c").withColumn("_i", F.row_number().over(Window.partitionBy("c").orderBy("k")))
        x = placed.filter("first").select("pair", "_i", F.col("k").alias("_x"), F.col("bound").alias("_bx"))
        y = placed.filter("NOT first").select("pair", "_i", F.col("k").alias("_y"), F.col("bound").alias("_by"))
        # a side's bound is the lowest key of the other classes that it may swap with: the partner has to come before it
        now = x.join(y, ["pair", "_i"]).filter("(_bx IS NULL OR _y < _bx) AND (_by IS NULL OR _x < _by)").select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"))
        now = checkpoint(now)
        taken = checkpoint(taken.union(now))
        left = checkpoint(left.join(now.select(F.col("a").alias("k")).union(now.select("b")), "k", "left_anti"))


def prefix_join(names: DataFrame, prefixes: DataFrame, name: str, prefix: str) -> DataFrame:
    """``names`` with the longest ``prefix`` that each name begins with, null if none. Every prefix length that occurs is an equality join key."""
    lengths = F.array_sort(F.array_distinct(F.collect_list(F.char_length(prefix))))
    few = prefixes.select(prefix).distinct()
    sized = names.crossJoin(F.broadcast(few.agg(lengths.alias("_n"))))  # one row
    cut = sized.withColumn("_len", F.explode_outer("_n")).withColumn("_p", F.substr(name, F.lit(1), F.col("_len")))
    hit = cut.join(few.withColumnRenamed(prefix, "_hit"), F.col("_p") == F.col("_hit"), "left")
    return hit.groupBy(*names.columns).agg(F.max_by("_hit", F.when(F.col("_hit").isNotNull(), F.col("_len"))).alias(prefix))


def full_outer_diff(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that only one side has, with ``only_in`` left or right."""
    x = a.select(*key).distinct().withColumn("_a", F.lit(True))
    y = b.select(*key).distinct().withColumn("_b", F.lit(True))
    both = x.join(y, list(key), "full_outer")
    return both.filter(F.col("_a").isNull() | F.col("_b").isNull()).select(*key, F.when(F.col("_b").isNull(), "left").otherwise("right").alias("only_in"))


def rule_chain(df: DataFrame, rules: Sequence[tuple[str, Column]], out: str = "reason") -> DataFrame:
    """``df`` with the name of the first rule that rejects the row, null if none does. A rule that is unknown doesn't reject."""
    reason = F.lit(None).cast("string")
    for name, cond in reversed(rules):
        reason = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn(out, reason)


def add_names(registry: DataFrame, names: DataFrame, code: str, name: str) -> DataFrame:
    """``registry`` with ``name`` by ``code``; codes without one, or with an empty one, stop the job and are listed."""
    out = registry.join(assert_unique(names.select(code, name), [code]), code, "left")
    bad = F.col(name).isNull() | (F.trim(name) == "")
    return out.withColumn(name, F.when(bad, F.raise_error(F.concat(F.lit("no name for code "), F.coalesce(F.col(code).cast("string"), F.lit("null"))))).otherwise(F.col(name)))
