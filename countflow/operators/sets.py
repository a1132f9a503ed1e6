"""Set operations and uniqueness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def except_keys(expected: DataFrame, present: DataFrame, key: Sequence[str]) -> DataFrame:
    """Expected keys that aren't present, once each."""
    return expected.select(*key).distinct().join(present, list(key), "left_anti")


def intersect_keys(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    return a.select(*key).intersect(b.select(*key))


def symmetric_diff(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    x, y = a.select(*key), b.select(*key)
    return x.subtract(y).union(y.subtract(x))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")


def assert_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df``; a key that occurs twice stops the job when it runs. One shuffle, with no action of its own."""
    cols = [c for c in df.columns if c not in key]
    n = F.count("*").alias("_n")
    once = df.groupBy(*key).agg(n, *[F.first(c).alias(c) for c in cols])
    text = F.concat(F.lit("key occurs more than once: "), F.to_json(F.struct(*key)))
    return once.filter(F.when(F.col("_n") > 1, F.raise_error(text).isNotNull()).otherwise(F.lit(True))).select(*df.columns)
