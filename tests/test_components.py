import numpy as np
import pandas as pd
import pytest

from countflow.operators import components
from countflow.operators.components import connected_components


def smallest(pairs):
    """Union-find: the smallest node that each end is connected to."""
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {x: root(x) for x in list(up)}


@pytest.fixture()
def rounds(monkeypatch):
    seen, pointers = [], components._pointers
    monkeypatch.setattr(components, "_pointers", lambda edges, k: (seen.append(k), pointers(edges, k))[1])
    return seen


def labels(spark, pairs):
    df = connected_components(spark.createDataFrame(pd.DataFrame(pairs, columns=["a", "b"])))
    rows = df.collect()
    assert len(rows) == len({r["node"] for r in rows})
    return {r["node"]: r["label"] for r in rows}, df


def test_random_graphs(spark):
    rng = np.random.default_rng(4)
    pairs = rng.integers(0, 3000, (1800, 2)).tolist() + [[5000, 5000], [5001, 5001], [5001, 5002]]
    assert labels(spark, pairs)[0] == smallest(pairs)


def test_hubs_and_copies_of_edges(spark, rounds):
    pairs = [[0, i] for i in range(1, 4000)] + [[0, 1]] * 500 + [[9000 + i, 9000] for i in range(1, 500)] + [[9000, 17]]
    assert labels(spark, pairs)[0] == smallest(pairs)
    assert len(rounds) <= 3


def test_a_ring(spark, rounds):
    ids = np.random.default_rng(1).permutation(5000)
    found, _ = labels(spark, np.stack([ids, np.roll(ids, 1)], 1))
    assert set(found.values()) == {0} and len(found) == 5000
    assert len(rounds) <= 20


def test_a_long_path(spark, rounds):
    ids = np.random.default_rng(2).permutation(100_000)
    found, df = labels(spark, np.stack([ids[1:], ids[:-1]], 1))
    assert set(found.values()) == {0} and len(found) == 100_000
    assert len(rounds) <= 20
    assert int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < 1 << 60


def test_the_parts_of_the_larger_table(spark, rounds):
    from pyspark.sql import functions as F

    p = spark.read.parquet("/root/testdata/sf0.1/part.parquet").select(F.col("p_partkey").alias("a"), (F.col("p_partkey") * 7 % 4096).alias("b"))
    want = smallest([(r["a"], r["b"]) for r in p.collect()])
    assert {r["node"]: r["label"] for r in connected_components(p).collect()} == want
    assert len(rounds) <= 20


def test_estimates_don_t_grow_over_many_rounds(spark):
    from pyspark.sql import functions as F

    from countflow.session import checkpoint

    df = spark.range(100)
    for _ in range(30):
        df = checkpoint(df.join(df.withColumnRenamed("id", "x"), F.expr("id = x")).select("id"))
    assert int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < 1 << 60


def test_text_nodes_nulls_and_none(spark):
    df = spark.createDataFrame([("l1", "r1"), ("l2", "r1"), ("l3", None), (None, "r9"), ("z", "z")], "a string, b string")
    assert {r["node"]: r["label"] for r in connected_components(df).collect()} == {"l1": "l1", "l2": "l1", "r1": "l1", "z": "z"}
    assert connected_components(df.limit(0)).count() == 0
    assert [tuple(r) for r in connected_components(df.filter("a = 'z'")).collect()] == [("z", "z")]
