"""Operators on places and classes of equal rows: the same results as by rows, and work that doesn't grow with the copies."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from countflow.operators import joins, matching, quantiles
from countflow.operators import windows as wn


@pytest.fixture(scope="module")
def units(spark):
    """Random places, some with several units, two with close neighbours."""
    rng = np.random.default_rng(5)
    places = [(float(a), float(o)) for a, o in zip(rng.uniform(35, 36, 40), rng.uniform(139, 140, 40))]
    places += [(35.5, 139.5), (35.5001, 139.5), (35.2, 139.2), (35.2001, 139.2)]
    rows = [(i, *places[int(p)]) for i, p in enumerate(np.concatenate([np.arange(44), rng.integers(0, 43, 25), [2, 2, 2]]))]
    return spark.createDataFrame([*rows, (900, None, 1.0)], "k long, lat double, lon double").cache()


def by_rows(units, km):
    return joins.within_km(units, units, km).filter("k < r_k").select(F.col("k").alias("a"), F.col("r_k").alias("b"), "km")


def test_pairs_and_their_directness_are_those_of_the_rows(units):
    want = {(r["a"], r["b"]): (r["km"], r["direct"]) for r in matching.direct_pairs(by_rows(units, 30)).collect()}
    got = matching.direct_pairs_within_km(units, "k", 30).collect()
    assert {(r["a"], r["b"]): (r["km"], r["direct"]) for r in got} == want and len(got) == len(want)
    assert {d for _, d in want.values()} == {True, False}
    pairs = joins.pairs_within_km(units, "k", 30).collect()
    assert {(r["a"], r["b"]): r["km"] for r in pairs} == {p: km for p, (km, _) in want.items()} and len(pairs) == len(want)


def test_degrees_are_those_of_the_rows(units):
    for km in (0.001, 5, 30):
        want = matching.degree_and_coverage(by_rows(units, km).withColumn("direct", F.col("km") < 10), units, "k").first()
        assert matching.degree_and_coverage_within_km(units, "k", km, F.col("km") < 10).first().asDict() == want.asDict()


def test_the_nearest_one_is_looked_up_once_a_place(spark, monkeypatch):
    sizes, within = [], joins.within_km
    monkeypatch.setattr(joins, "within_km", lambda a, b, *more: sizes.append((a.count(), b.count())) or within(a, b, *more))
    left = spark.range(500).select(F.col("id").alias("k"), (35 + F.col("id") % 5 / 10).alias("lat"), F.lit(139.0).alias("lon"))
    right = spark.range(300).select((300 - F.col("id")).alias("s"), (35 + F.col("id") % 3 / 10).alias("lat"), F.lit(139.0).alias("lon"))
    got = {r["k"]: r["s"] for r in joins.nearest_within(left, right, "k", "s", 5).collect()}
    assert got == {k: {0: 3, 1: 2, 2: 1}.get(k % 5) for k in range(500)} and sizes == [(5, 3)]


def swaps(rows):
    out, used = [], set()
    for (a, t, o), (b, u, p) in itertools.combinations(sorted(rows), 2):
        if t not in o and u not in p and t in p and u in o and not {a, b} & used:
            out.append((a, b))
            used |= {a, b}
    return out


def test_swaps_of_classes(spark, monkeypatch):
    rng = np.random.default_rng(8)
    towns = ["aa", "bb", "cc", "aab", "dd"]
    rows = [(i, str(rng.choice(towns)), " ".join(rng.choice(towns, 2))) for i in range(150)]
    df = spark.createDataFrame(rows, "k long, own string, other string")
    assert sorted(tuple(r) for r in joins.swap_candidates(df, "k", "own", "other").collect()) == swaps(rows)
    # a key of two rows is taken once
    twice = spark.createDataFrame([(1, "aa", "bb"), (1, "cc", "dd"), (2, "bb", "aa"), (3, "dd", "cc")], df.schema)
    assert [tuple(r) for r in joins.swap_candidates(twice, "k", "own", "other").collect()] == [(1, 2)]
    rounds, write = [], joins.checkpoint
    monkeypatch.setattr(joins, "checkpoint", lambda t: rounds.append(1) or write(t))
    same = [(i, "aa" if i % 2 else "bb", "bb" if i % 2 else "aa") for i in range(400)]
    got = joins.swap_candidates(spark.createDataFrame(same, df.schema), "k", "own", "other").collect()
    assert sorted(tuple(r) for r in got) == swaps(same) and len(got) == 200 and len(rounds) < 20


def test_weighted_quality_and_quantiles(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, 1.05, 3, "x"), (2.0, 2.25, 2, "x"), (None, 1.0, 9, "x"), (1.0, 3.0, 0, "x"), (None, 1.0, 1, None)], "a double, b double, w int, g string")
    long = df.withColumn("_r", F.explode(F.expr("array_repeat(1, w)")))
    for by in ((), ("g",)):
        want = matching.match_quality(long, "a", "b", by=by).collect()
        assert sorted(matching.match_quality(df, "a", "b", by=by, weight="w").collect(), key=str) == sorted(want, key=str)
    r = matching.match_quality(df, "a", "b", weight="w").first()
    assert (r["n"], round(r["median_gap"], 9), r["within_10"], r["within_30"]) == (5, 0.05, 0.6, 1.0)
    # many rows of few values are counted, not dealt out
    monkeypatch.setattr(quantiles, "_blocks", lambda *_: pytest.fail("few values are sorted at once"))
    few = spark.range(20_000).select((F.col("id") % 4).alias("v"))
    assert list(quantiles.exact_quantiles(few, "v", [0.25, 0.5, 1.0], most=100).first()["quantiles"]) == [0.75, 1.5, 3.0]


def test_ids_of_five_digits_are_read_whole(spark, tmp_path):
    from countflow import catalog

    rows = spark.range(6).select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), (F.col("id") * 7001).alias("user_id"), F.lit(2.5).alias("value"))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    assert sorted(r["counter"] for r in catalog.QUERIES["s1_read_layer"](spark, str(tmp_path)).collect()) == [i * 7001 for i in range(6)]


def test_references_by_place(spark):
    rng = np.random.default_rng(2)
    rows = [(k, 35 + k % 7 / 5, 139 + k % 3 / 2, t, float(rng.integers(1, 6)), int(rng.integers(0, 9))) for k in range(40) for t in range(6)]
    df = spark.createDataFrame(rows, "k long, lat double, lon double, t int, ratio double, rain int")
    p = df.select("k", "lat", "lon").distinct()
    pairs = joins.within_km(p, p, 60).filter("k <> r_k").select(F.col("k").alias("a"), F.col("r_k").alias("b"))
    want = wn.local_reference(df, pairs, "k", "t", "ratio", F.col("rain") >= 5, 2).collect()
    got = wn.local_reference_within_km(df, "k", "t", "ratio", F.col("rain") >= 5, 60, 2).collect()
    assert sorted(got) == sorted(want) and len(want) > 20


def test_medians_around_positions(spark):
    rng = np.random.default_rng(3)
    own, near = (np.stack([rng.uniform(-89, 89, n), rng.choice([rng.uniform(-180, 180), 179.9, -179.9], n)], 1) for n in (60, 200))
    near[:20] = own[:20]
    values, weights = np.sort(rng.integers(0, 50, 200) / 8), rng.integers(1, 4, 200)
    rows = spark.createDataFrame([(i, float(a), float(o)) for i, (a, o) in enumerate(own)], "i int, lat double, lon double")
    others = spark.createDataFrame([(float(v), int(w), float(a), float(o)) for v, w, (a, o) in zip(values, weights, near)], "v double, w int, lat double, lon double")
    for km in (0.0, 900.0, 30000.0):
        far = joins.haversine_km(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) <= km
        want = {r["i"]: (r["m"], r["n"]) for r in rows.alias("a").crossJoin(others.alias("b")).filter(far).groupBy("i").agg(F.percentile("v", 0.5, F.col("w")).alias("m"), F.sum("w").alias("n")).collect()}
        got = wn.medians_within_km(own, near, values, weights, km, cells=1000)
        assert {i: (m, n) for i, (m, n) in enumerate(zip(*got)) if n} == want and len(want) >= 20


def test_references_make_no_pairs(spark):
    """Rows of one time over a wide region: what meets is shuffled as rows, at most two of each, never as pairs."""
    df = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 7 % 4000 / 1000 + 33).alias("lat"), (F.col("id") * 13 % 4000 / 1000 + 133).alias("lon"), F.lit(1).alias("t"), (F.col("id") % 9 + 1.0).alias("ratio"), (F.col("id") % 10).alias("rain"))
    out = wn.local_reference_within_km(df, "k", "t", "ratio", F.col("rain") >= 6, 200, 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "percentile" not in plan and out.count() == 1600


def test_keys_within_km_are_those_of_the_rows(spark, units, monkeypatch):
    monkeypatch.setattr(joins, "LIST", 2)
    other = units.filter("k % 3 = 0").select((F.col("k") % 40).alias("s"), "lat", "lon")  # keys may repeat
    want = joins.within_km(units, other, 30).select("k", F.col("r_s").alias("s"), "km")
    got = joins.keys_within_km(units, other, "k", "s", 30)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 300
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(_lefts") < plan.index("Join")  # pairs of rows are made after the last join
