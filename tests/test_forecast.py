"""The forecast on planted counts, against the naive ones, with an error that the plan allows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from countflow.operators import statistics as stt


@pytest.fixture(scope="module")
def scores(spark):
    """Twelve counters over 200 days: a level each, a weekly shape, a slow trend and noise of 4 percent."""
    rng, first = np.random.default_rng(11), dt.date(2025, 1, 1)
    week = np.array([1.0, 1.02, 1.03, 1.05, 1.1, 0.8, 0.65])
    rows = []
    for k in range(12):
        level = rng.uniform(900, 1100)
        for i in range(200):
            day = first + dt.timedelta(days=i)
            usual = level * week[day.weekday()]
            rows.append((k, day, float(round(usual * (1 + 0.001 * i) * rng.normal(1, 0.04))), float(usual), day.weekday() >= 5))
    df = spark.createDataFrame(rows, "counter int, date date, vehicles double, base double, off boolean")
    f = stt.time_split(stt.daily_features(df, ["counter"], "date", "vehicles", "base", "off"), "date", 40).withColumn("prev", F.col("prev_day_off").cast("int")).cache()
    model = stt.fit_forecast(f.filter("NOT is_test"), ["lag1", "lag7", "lag14", "ratio7", "log_base", "weekday", "prev"], "y", trees=30, depth=4)
    scored = model.transform(f.filter("is_test")).withColumn("predicted", F.exp("prediction")).withColumn("last_week", F.exp("lag7")).withColumn("kind", F.when(F.col("off"), "off").otherwise("work"))
    from countflow.operators.aggregates import error_scores

    own = error_scores(scored, "vehicles", "predicted", "kind").withColumn("forecast", F.lit("boosted"))
    return {(r["forecast"], r["kind"]): r["wape"] for r in own.unionByName(stt.naive_forecasts(scored, "vehicles", "last_week", "base", "kind")).collect()}


def test_the_forecast_beats_the_naive_ones(scores):
    assert scores["boosted", "all"] < scores["last_week", "all"] < 0.07
    assert scores["boosted", "all"] < 0.75 * scores["usual", "all"]  # which doesn't know the trend


def test_every_kind_of_day_has_a_score(scores):
    assert {k for _, k in scores} == {"all", "off", "work"} and all(0 < v < 0.3 for v in scores.values())


def test_a_feature_that_tells_nothing_gains_nothing(spark):
    rng = np.random.default_rng(5)
    x = rng.random((1500, 2))
    rows = [(float(a), float(b), float(3 * a + rng.normal(0, 0.05)), i % 5 == 0) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "useful double, noise double, y double, is_test boolean").cache()
    out = {r["features"]: r for r in stt.ablation(df.filter("NOT is_test"), df.filter("is_test"), {"noise": ["noise"], "useful": ["useful"], "both": ["useful", "noise"]}, "y", trees=8, depth=3).collect()}
    assert out["useful"]["gain"] > 0.7 and abs(out["both"]["mae"] - out["useful"]["mae"]) < 0.05 and {r["n"] for r in out.values()} == {300}


def test_a_permutation_is_one(spark):
    df = spark.range(500).select(F.col("id").alias("k"))
    rows = [(r["k"], r["partner"]) for r in stt.permutation(df, "k", 7).collect()]
    assert sorted(k for k, _ in rows) == sorted(p for _, p in rows) == list(range(500))
    assert sum(k == p for k, p in rows) < 10 and rows != [(r["k"], r["partner"]) for r in stt.permutation(df, "k", 8).collect()]


def test_samples_per_key(spark):
    from countflow.operators.ordering import sample_per_key

    df = spark.range(300).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    one, two = (sorted(map(tuple, sample_per_key(df, ["k"], ["v"], 5, seed).collect())) for seed in (0, 0))
    assert one == two and len(one) == 35 and len({v for _, v in one}) == 35
    assert one != sorted(map(tuple, sample_per_key(df, ["k"], ["v"], 5, 1).collect()))
    assert sample_per_key(df, ["k"], ["v"], 1000).count() == 300
