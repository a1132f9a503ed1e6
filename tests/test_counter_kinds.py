"""Pairs of counters that share place, nation and series are told by pairs of kinds, whatever the number of counters."""

import duckdb
from pyspark.sql import functions as F

from countflow import catalog
from countflow.operators import statistics as stt
from countflow.plans import analyses

SRC, STEP = "/root/testdata/sf0.01", {"c_custkey": 15000, "s_suppkey": 15000, "l_suppkey": 15000, "l_orderkey": 10**6}


def three_copies(spark, at):
    for t, keys in {"customer": ["c_custkey"], "supplier": ["s_suppkey"], "lineitem": ["l_suppkey", "l_orderkey"], "part": []}.items():
        one = spark.read.parquet(f"{SRC}/{t}.parquet")
        copies = one.crossJoin(spark.range(3 if keys else 1).select(F.col("id").alias("_i")))
        copies.withColumns({k: (F.col(k) + F.col("_i") * STEP[k]).cast(one.schema[k].dataType) for k in keys}).drop("_i").write.parquet(f"{at}/{t}.parquet")


def test_copies_make_no_more_pairs_of_kinds(spark, tmp_path, monkeypatch):
    """each pair of counters was a row, which was written and shuffled several times."""
    three_copies(spark, tmp_path)
    seen, real = [], stt.dense_pair_correlation
    monkeypatch.setattr(analyses.stt, "dense_pair_correlation", lambda df, pairs, *a, **k: seen.append(pairs.count()) or real(df, pairs, *a, **k))
    rows = {tuple(r)[:2]: tuple(r)[2:] for r in catalog.QUERIES["q16_distance_bands"](spark, str(tmp_path)).collect()}
    counters = spark.read.parquet(f"{SRC}/lineitem.parquet").select("l_suppkey").distinct().count()
    assert seen[0] <= counters * (counters + 1) // 2
    con = duckdb.connect()
    for t in ("customer", "part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = {r[:2]: r[2:] for r in con.execute(catalog.ORACLE_SQL["q16_distance_bands"]).fetchall()}
    assert rows.keys() == want.keys() and len(rows) > 6
    near = lambda x, y: x == y or abs(x - y) < 1e-6
    assert all(near(x, y) for k in rows for x, y in zip(rows[k], want[k]))
