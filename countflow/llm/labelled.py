"""A bounded sample of labelled documents, and models fitted on it in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countflow.llm.text import forget

SEED = 20240229


def class_counts(labels: DataFrame, label: str) -> dict[int, int]:
    return {int(r[label]): int(r["count"]) for r in labels.filter(F.col(label).isNotNull()).groupBy(label).count().collect()}


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int, doc_id: str = "doc_id", text: str = "text", where: Column | None = None) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of each label 0 and 1: those whose ids hash lowest.

    Only labelled ids are sorted; at most 2 * ``per_class`` of them are broadcast to find the texts. Null labels and null ids
    are no labels; an id that is labelled twice counts by its larger label.
    """
    ids = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    if where is not None:
        ids = ids.filter(where)
    ids = ids.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("label"))
    order = F.xxhash64(F.col("_id"), F.lit(SEED))
    picked = [ids.filter(F.col("label") == k).orderBy(order, "_id").limit(per_class) for k in (0, 1)]
    few = picked[0].unionByName(picked[1])
    return documents.join(F.broadcast(few), F.col(doc_id) == F.col("_id")).select(F.col("_id").alias("doc_id"), F.col(text).alias("text"), "label")


def fit_in_one_task(sample: DataFrame, fit: Callable[[list[tuple[Any, str, int]]], Any]) -> Any:
    """``fit`` of the sample's rows (id, text, label), in id order, run in one task; its result goes to the driver.

    For samples with a fixed bound only. An empty sample gives None.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        rows = [(r["doc_id"], r["text"] or "", int(r["label"])) for b in batches for r in b.to_pylist()]
        if rows:
            rows.sort(key=lambda r: (str(r[0]), r[1]))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], ["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(found[0]["model"])) if found else None
