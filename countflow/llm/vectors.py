"""Sums of long numeric vectors over all partitions, in two steps."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_over_partitions(df: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None]) -> np.ndarray | None:
    """The sum of ``partial(batches)`` (float64 vectors of one length, or None) over the partitions of ``df``.

    The partitions' vectors are summed in about as many tasks as the square root of their number, so the
    driver gets that many, never one for each partition. None if no partition gives a vector.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = partial(batches)
        if v is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.asarray(v, "<f8").tobytes()], pa.binary())], ["v"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for x in batch.column(0).to_pylist():
                v = np.frombuffer(x, "<f8")
                out = v.copy() if out is None else out + v
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["v"])

    tasks = max(1, math.isqrt(df.rdd.getNumPartitions()))
    sums = df.mapInArrow(each, "v binary").repartition(tasks, F.xxhash64("v")).mapInArrow(total, "v binary").collect()
    vectors = [np.frombuffer(bytes(r["v"]), "<f8") for r in sums]
    return np.sum(vectors, axis=0) if vectors else None
