import math
import random

import duckdb
import numpy as np
import pytest

from countflow import catalog
from countflow.operators import joins
from countflow.operators.joins import nearest_within, within_km


def km_between(a, b):
    (la, oa), (lb, ob) = ([math.radians(x) for x in p] for p in (a, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - oa) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


def places(kind, n=150):
    rng = np.random.default_rng(7)
    if kind == "mid":
        lat, lon = rng.uniform(33, 37, n), rng.uniform(138, 142, n)
    elif kind == "north":
        lat, lon = rng.uniform(59, 84, n), rng.uniform(-30, 30, n)
    elif kind == "pole":
        lat, lon = np.concatenate([rng.uniform(88.5, 90, n - 2), [90.0, -90.0]]), rng.uniform(-180, 180, n)
    elif kind == "south pole":
        lat, lon = rng.uniform(-90, -89, n), rng.uniform(0, 360, n)
    else:
        lat, lon = rng.uniform(-3, 3, n), np.where(rng.random(n) < 0.5, rng.uniform(177, 180, n), rng.uniform(-180, -177, n))
    return [(i, float(a), float(o)) for i, (a, o) in enumerate(zip(lat, lon))]


@pytest.mark.parametrize("kind, km", [("mid", 60.0), ("north", 150.0), ("pole", 60.0), ("pole", 900.0), ("south pole", 40.0), ("meridian", 100.0)])
def test_all_pairs_of_every_latitude(spark, kind, km):
    rows = places(kind)
    df = spark.createDataFrame([*rows, (1000, None, 5.0), (1001, 5.0, None)], "k long, lat double, lon double")
    got = [(r["k"], r["r_k"]) for r in within_km(df, df, km).collect()]
    want = {(i, j) for i, *p in rows for j, *q in rows if km_between(p, q) <= km}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > len(rows)


def test_the_nearest_one_may_be_over_the_meridian(spark):
    a = spark.createDataFrame([(1, 10.0, 179.99), (2, 75.0, 0.0)], "k long, lat double, lon double")
    b = spark.createDataFrame([(10, 10.0, -179.99), (11, 10.0, 179.5), (12, 75.0, 0.5)], "s long, lat double, lon double")
    assert {r["k"]: (r["s"], r["s_km"]) for r in nearest_within(a, b, "k", "s", 30).collect()} == {1: (10, 2.19), 2: (12, 14.39)}


def test_closest_values_within_km(spark):
    """all pairs within the distance were made to find two of each row."""
    rng = random.Random(7)
    place = lambda: (30 + rng.randrange(6) / 5, 139 + rng.randrange(6) / 5)
    left, right = ([(k, *place(), rng.randrange(40) / 8) for k in range(n)] for n in (300, 80))
    a, b = (spark.createDataFrame(rows, "k long, lat double, lon double, v double") for rows in (left, right))
    every, got = {}, {}
    for r in within_km(a, b, 60).collect():
        every.setdefault(r["k"], []).append((abs(r["v"] - r["r_v"]), r["r_k"]))
    for r in joins.closest_within_km(a, b, 60, "v", 2).collect():
        got.setdefault(r["k"], []).append((abs(r["v"] - r["r_v"]), r["r_k"]))
    assert got.keys() == every.keys() and sum(map(len, got.values())) < sum(map(len, every.values())) / 2
    assert all(sorted(got[k])[:2] == sorted(every[k])[:2] for k in every)
    assert joins.closest_within_km(a.limit(0), b, 60, "v", 2).count() == 0 == joins.closest_within_km(a, b.limit(0), 60, "v", 2).count()


def test_best_candidates_as_sql(spark):
    con = duckdb.connect()
    for t in ("customer", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    want = con.execute(catalog.ORACLE_SQL["w14_rank_candidates"]).fetchall()
    assert sorted(map(str, map(tuple, catalog.QUERIES["w14_rank_candidates"](spark, "/root/testdata/sf0.01").collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("listed, ties", [(1 << 20, False), (20, False), (20, True)])
def test_quality_without_pairs(spark, monkeypatch, listed, ties):
    """all pairs within the distance were made for one row of shares and a median."""
    from countflow.operators import matching

    monkeypatch.setattr(matching, "LISTED", listed)
    rng = random.Random(3)
    left, right = ([(30 + rng.randrange(6) / 5, 139 + rng.randrange(6) / 5, rng.randrange(9) / 8 if ties else rng.random()) for _ in range(n)] for n in (201, 83))
    a, b = (spark.createDataFrame([*rows, (30.0, 139.0, None)], "lat double, lon double, v double") for rows in (left, right))
    want = matching.match_quality(within_km(a, b, 60), "v", "r_v").first()
    got = matching.match_quality_within_km(a, b, 60, "v", "v").first()
    assert got.asDict().keys() == want.asDict().keys() and got["n"] == want["n"] > 1000
    assert all(abs(x - y) < 1e-12 for x, y in zip(got, want))
    assert tuple(matching.match_quality_within_km(a.limit(0), b, 60, "v", "v").first()) == (0, None, None, None, None)
