"""A forecast is fitted to cells of equal bins, a key's days are read in order without copies."""

import numpy as np
from pyspark.sql import functions as F

from countflow import catalog
from countflow.operators import statistics as stt

SF = "/root/testdata/sf0.001"


def test_trees_of_cells_are_trees_of_rows(spark):
    """each round of boosting read and kept every row."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rng = np.random.default_rng(2)
    rows = [(int(a), int(b), float(2 * a - b * b + rng.normal(0, 3))) for a, b in zip(rng.integers(0, 8, 4000), rng.integers(0, 5, 4000))]
    df = spark.createDataFrame(rows, "a int, b int, y double").withColumn("c", F.when(F.col("a") > 2, F.col("b")))
    model = stt.fit_forecast(df, ["a", "b", "c"], "y", trees=4, depth=3)
    got = {(r["a"], r["b"]): r["prediction"] for r in model.transform(df).select("a", "b", "prediction").distinct().collect()}
    plain = VectorAssembler(inputCols=["a", "b", "f", "m"], outputCol="x").transform(df.withColumn("f", F.coalesce("c", F.lit(2))).withColumn("m", F.col("c").isNull().cast("int")))
    trees = GBTRegressor(featuresCol="x", labelCol="y", maxIter=4, maxDepth=3, seed=7).fit(plain)
    want = {(r["a"], r["b"]): r["prediction"] for r in trees.transform(plain).select("a", "b", "prediction").distinct().collect()}
    assert len(got) == len(want) == 40 and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_boosting_reads_cells(spark, monkeypatch):
    written, checkpoint = [], stt.checkpoint

    def watched(df):
        out = checkpoint(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(stt, "checkpoint", watched)
    df = spark.range(5000).select((F.col("id") % 5).alias("a"), (F.col("id") % 7).cast("double").alias("y"))
    model = stt.fit_forecast(df, ["a"], "y", trees=2, depth=2)
    assert written == [5] and model.transform(df).select("prediction").distinct().count() <= 5


def test_days_are_not_copied(spark):
    """each row went to four days before the shuffle."""
    plan = catalog.QUERIES["m5_daily_features"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan
