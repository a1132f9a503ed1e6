import hashlib
import math

import duckdb
import numpy as np
import pytest

from countflow.llm import centroids
from countflow.llm.centroids import OP12_SQL, cluster, nearest, op12_centroids


def brute(rows, k, rounds, dims, scale, seed):
    """Plain loops over (key, vector)."""
    kept = [(key, [math.floor(scale * float(x)) for x in v]) for key, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:k]]

    def nearest_of(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cs))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest_of(v)[1], []).append(v)
        cs = [[sum(x) // len(members[i]) for x in zip(*members[i])] if i in members else c for i, c in enumerate(cs)]
    found = [(key, *nearest_of(v)) for key, v in kept]
    per = {i: sum(s for _, s, j in found if j == i) for i in range(k)}
    return sorted(((key, j, s, per[j], sum(per.values()), cs[j]) for key, s, j in found), key=str)


def rows_of(df, key="key"):
    return sorted(((r[key], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], list(r["centroid"])) for r in df.collect()), key=str)


SCHEMA = "key long, v array<float>, cluster string, ints string, distance string"


@pytest.fixture()
def vectors():
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(i % 5, 0.3, 6)]) for i in range(300)]
    rows += rows[:7]  # repeated rows
    rows += [(400, None), (401, []), (402, [1.0] * 5), (403, [1.0] * 7), (404, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (405, [float("nan")] * 6), (406, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0]), (407, [-0.0] * 6), (None, [2.5] * 6)]
    rows += [(500 + i, [0.5] * 6) for i in range(200)]  # one very common vector
    return rows


@pytest.mark.parametrize("k, rounds, block", [(8, 10, 4096), (3, 2, 16), (1, 1, 7), (5, 0, 64)])
def test_against_loops(spark, vectors, monkeypatch, k, rounds, block):
    monkeypatch.setattr(centroids, "BLOCK", block)
    df = spark.createDataFrame([(key, v, "x", "y", "z") for key, v in vectors], SCHEMA).repartition(5)
    assert rows_of(cluster(df, "key", "v", k=k, rounds=rounds, dims=6)) == brute([(key, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for key, v in vectors], k, rounds, 6, 1024, 3)


def test_fewer_vectors_than_centroids_and_none(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [5.0, 5.0]), (3, None)], "key long, v array<double>")
    found = cluster(df, "key", "v", dims=2, k=8).collect()
    assert {(r["key"], r["distance"], r["inertia"]) for r in found} == {(1, 0, 0), (2, 0, 0)}
    assert cluster(df.limit(0), "key", "v", dims=2).collect() == []


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(i, [1.0, 1.0]) for i in range(20)]
    found = cluster(spark.createDataFrame(rows, "key long, v array<double>"), "key", "v", dims=2, k=3).collect()
    assert {(r["cluster"], r["distance"], tuple(r["centroid"])) for r in found} == {(0, 0, (1024, 1024))}


def test_large_components_are_exact_or_refused(spark):
    near = 131071.0  # times 1024 just below the limit
    df = spark.createDataFrame([(1, [near] * 64), (2, [-near] * 64), (3, [near] * 64)], "key long, v array<double>")
    found = {r["key"]: r["distance"] for r in cluster(df, "key", "v", k=1, rounds=0).collect()}
    assert sorted(found.values()) in ([0, 0, 64 * (2 * 131071 * 1024) ** 2], [0, 64 * (2 * 131071 * 1024) ** 2, 64 * (2 * 131071 * 1024) ** 2])
    with pytest.raises(Exception, match="or more"):
        cluster(spark.createDataFrame([(1, [1e6] * 64)], "key long, v array<double>"), "key", "v").collect()


def test_tables_give_the_plain_distances():
    rng = np.random.default_rng(1)
    ints, cs = rng.integers(-2000, 2000, (500, 9)), rng.integers(-2000, 2000, (4, 9))
    found = [np.unique(ints[:, d], return_inverse=True) for d in range(9)]
    own, distance = nearest([v for v, _ in found], np.stack([c for _, c in found]), cs)
    plain = ((ints[:, None] - cs[None]) ** 2).sum(2)
    assert (own == plain.argmin(1)).all() and (distance == plain.min(1)).all()


def test_op12_against_sql(spark, sf):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = duckdb.sql(OP12_SQL)
    names = want.columns
    assert sorted(map(tuple, op12_centroids(spark, sf).select(*names).collect())) == sorted(want.fetchall())
