"""Joins whose keys may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countflow.session import shuffle_partitions


def join_back(rows: DataFrame, groups: DataFrame, key: str, count: str, spread: list[str]) -> DataFrame:
    """``rows`` (read more than once, so best a written table) inner joined with ``groups``, which has one row per ``key`` (never null) and in
    ``count`` how many of ``rows`` have it.

    A key with more rows than a task's fair share is dealt out by a hash of the columns ``spread``, and its group is repeated for
    each salt. Fewer keys than there are shuffle partitions can be that frequent, so their list is broadcast.
    """
    parts = shuffle_partitions(rows.sparkSession)
    fair = max(2, rows.count() // parts)
    hot = F.broadcast(groups.filter(F.col(count) > fair).select(key, F.lit(True).alias("_hot")))
    salt = F.when(F.coalesce("_hot", F.lit(False)), F.pmod(F.xxhash64(*spread), F.lit(parts))).otherwise(F.lit(0).cast("bigint"))
    left = rows.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    last = F.when(F.col(count) > fair, F.lit(parts - 1)).otherwise(F.lit(0)).cast("bigint")
    right = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop(count)
    return left.join(right, [key, "_salt"]).drop("_salt")
