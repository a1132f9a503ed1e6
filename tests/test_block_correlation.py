"""Correlations of many pairs by blocks of series: exact, without a row for each pair and time."""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from countflow import catalog
from countflow.operators import statistics as stt


def test_blocks_give_every_correlation(spark):
    rng, first = random.Random(8), dt.date(2025, 1, 1)
    rows = [(k, first + dt.timedelta(days=d), None if rng.random() < 0.05 else 4 if k == 3 else rng.randrange(50) + 10**6 * (k == 5)) for k in range(40) for d in range(60) if rng.random() < 0.5]
    df = spark.createDataFrame([*rows, (None, first, 7), (77, None, 7)], "k long, date date, v long")
    pairs = spark.createDataFrame([(a, b) for a in range(42) for b in range(42) if rng.random() < 0.4], "a long, b long")
    by = {k: {d: v for j, d, v in rows if j == k and v is not None} for k in range(42)}
    want = {}
    for a, b in map(tuple, pairs.collect()):
        both = [(by[a][d], by[b][d]) for d in by[a] if d in by[b]]
        if len(both) >= 12:
            x, y = zip(*both)
            want[a, b] = len(both), None if 3 in (a, b) else statistics.correlation(x, y)
    for size in (7, 1000):
        got = {(r["a"], r["b"]): (r["n"], r["r"]) for r in stt.dense_pair_correlation(df, pairs, "k", "date", "v", 12, size=size).collect()}
        assert {k: n for k, (n, _) in got.items()} == {k: n for k, (n, _) in want.items()} and len(got) > 300
        assert all((r is None) == (want[k][1] is None) and (r is None or abs(r - want[k][1]) < 1e-9) for k, (_, r) in got.items())
    assert stt.dense_pair_correlation(df.limit(0), pairs, "k", "date", "v", 1).count() == 0 == stt.dense_pair_correlation(df, pairs.limit(0), "k", "date", "v", 1).count()


def test_no_row_for_a_pairs_time(spark, monkeypatch):
    """the query joined each pair with the series of both."""
    monkeypatch.setattr(stt, "pair_series_join", None)
    assert catalog.QUERIES["q16_distance_bands"](spark, "/root/testdata/sf0.001").agg(F.sum("n")).first()[0] is not None
