"""Ranked lexical search: the best documents for each item of a set of queries, exactly, by range maxima over posting lists.

1. One pass over the texts keeps, of each document, its length and how often it holds each term of the queries. Statistics of all documents come from those rows.
2. Tasks index their documents in blocks: posting lists of impacts (a term's share in a document's score) with a sparse table of range maxima each.
3. An item is searched best first. An interval of a block's documents is bounded by the sum of its terms' range maxima. The interval
   with the highest bound is split at the document where its largest maximum lies; that document is scored, the two sides are bounded anew. Intervals that can't reach the items' present
   k-th score are left out, and a task carries that score from block to block.
4. The tasks' best documents of an item meet in one ranking.

Documents of a block are placed by length, so that neighbours have similar impacts, and those that agree in length and all counts are one place with
their k smallest keys: they score alike in every item, so no other of them can be ranked.
"""

from __future__ import annotations

import heapq
import math
import string
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.llm.text import ASCII_LOWER, slices
from countflow.session import checkpoint

#: Items that are searched for at once; their terms, weights and results are all that a task holds beside its block.
ITEMS = 1024
#: Places (documents) and postings of a block; its tables take about 100 bytes a posting.
PLACES, POSTINGS = 8192, 1 << 20
#: Bytes of a text whose terms are listed at once.
STRETCH = 4 << 20
#: Intervals that are split at once, at most.
WIDTH = 256
#: Terms that stand for the number of documents and of terms in the table of statistics.
DOCUMENTS, TERMS = -1, -2

_KEPT = (string.ascii_letters + string.digits).encode()
#: A-Z lower-cased, other ASCII characters than letters and digits a space; bytes of longer characters are as they are.
_CLEAR = bytes(ASCII_LOWER[b] if b >= 0x80 or b in _KEPT else 0x20 for b in range(256))


def stretches(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, in lists of bounded size. Null: none."""
    clear = text.encode("utf-8", "replace").translate(_CLEAR) if text else b""
    at = 0
    while at < len(clear):
        end = clear.find(b" ", at + STRETCH) if at + STRETCH < len(clear) else -1
        end = len(clear) if end < 0 else end
        yield clear[at:end].split()
        at = end


def impact(weight, tf, m):
    """A term's share in the score of a document where it stands ``tf`` times, for integers or arrays of them."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def weight_of(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Item(NamedTuple):
    name: Any
    terms: np.ndarray  # numbers of its terms in the vocabulary
    times: np.ndarray  # how often each stands in it


def counted(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row for each document with a term: ``key``, ``n`` (terms, with repeats), ``terms`` and ``tfs`` (packed: which of the vocabulary it
    holds, ascending, and how often). Written once."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType()), T.StructField("terms", T.BinaryType()), T.StructField("tfs", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                keep, ns, terms, tfs = [], [], [], []
                for row, t in enumerate(part.column(1).to_pylist()):
                    n, found = 0, Counter()
                    for words in stretches(t):
                        n += len(words)
                        found.update(map(get, words))
                    if n:
                        found.pop(None, None)
                        numbers = sorted(found)
                        keep.append(row)
                        ns.append(n)
                        terms.append(np.array(numbers, "<u4").tobytes())
                        tfs.append(np.array([found[i] for i in numbers], "<u4").tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep, pa.int64())), pa.array(ns, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], schema.names)

    return checkpoint(docs.select(key, text).mapInArrow(run, schema))


def statistics(rows: DataFrame, size: int) -> dict[int, int]:
    """How many documents hold each term of a vocabulary of ``size``, and under DOCUMENTS and TERMS how many documents and terms there are in all. A task gives a row for each term at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, terms = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            documents += batch.num_rows
            terms += sum(batch.column(0).to_pylist())
            held += np.bincount(np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4"), minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([*some.tolist(), DOCUMENTS, TERMS], pa.int64()), pa.array([*held[some].tolist(), documents, terms], pa.int64())], ["term", "total"])

    found = rows.select("n", "terms").mapInArrow(run, "term long, total long").groupBy("term").agg(F.sum("total").alias("total"))
    return {r["term"]: r["total"] for r in found.collect()}


def _late(key: Any) -> tuple:
    """Keys in ascending order, null last."""
    return (key is None, 0 if key is None else key)


class Best:
    """The k best (score, key) of one item so far."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def add(self, score: int, keys: list) -> None:
        self.rows += [(-score, _late(key)) for key in keys]
        self.rows.sort()
        del self.rows[self.k :]

    @property
    def least(self) -> int:
        """A score below this can't be ranked."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1


class Block:
    """Posting lists of some documents, one after another by term, with a sparse table of range maxima over all of them."""

    def __init__(self, docs: dict[tuple[int, bytes, bytes], list], weights: np.ndarray, documents: int, all_terms: int):
        """``docs``: by length, terms and counts the keys of the documents that have them."""
        placed = sorted(docs.items(), key=lambda x: (x[0][0], _late(x[1][0])))
        self.keys = [keys for _, keys in placed]
        self.size = len(placed)
        terms = [np.frombuffer(t, "<u4") for (_, t, _), _ in placed]
        m = np.array([100 - 75 + (75 * n * documents) // all_terms for (n, _, _), _ in placed], np.int64)
        counts = [len(t) for t in terms]
        place = np.repeat(np.arange(self.size), counts)
        term = np.concatenate(terms).astype(np.int64)
        tf = np.frombuffer(b"".join(c for (_, _, c), _ in placed), "<u4").astype(np.int64)
        at = term * self.size + place
        order = np.argsort(at)
        self.at = at[order]  # term and place of each posting in one number
        self.place = place[order]
        self.impact = impact(weights[term], tf, m[place])[order]
        self.begin = np.searchsorted(self.at, np.arange(len(weights) + 1) * self.size)
        longest = int(np.diff(self.begin).max(initial=1))
        levels = [np.arange(len(self.at), dtype=np.int32)]
        for j in range(1, max(1, longest).bit_length()):
            half = 1 << (j - 1)
            a, b = levels[-1], np.concatenate([levels[-1][half:], levels[-1][-1:].repeat(min(half, len(self.at)))])
            levels.append(np.where(self.impact[a] >= self.impact[b], a, b))
        self.table = np.stack(levels)

    def maxima(self, low: np.ndarray, high: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For intervals (rows) and terms (columns) of postings low..high-1: each interval's bound, and the place of its largest share."""
        n = high - low
        some = n > 0
        level = np.frexp(np.where(some, n, 1).astype(np.float64))[1] - 1
        last = len(self.at) - 1
        a = self.table[level, np.minimum(low, last)]
        b = self.table[level, np.clip(high - (1 << level), 0, last)]
        best = np.where(self.impact[a] >= self.impact[b], a, b)
        share = np.where(some, self.impact[best] * times, 0)
        top = share.argmax(axis=1)
        return share.sum(axis=1), self.place[best[np.arange(len(best)), top]]

    def search(self, item: Item, best: Best) -> None:
        """Adds this block's documents to the item's best ones."""
        low, high = self.begin[item.terms], self.begin[item.terms + 1]
        some = high > low
        if not some.any():
            return
        terms, times, low, high = item.terms[some], item.times[some], low[some][None, :], high[some][None, :]
        bound, at = self.maxima(low, high, times)
        queue: list[tuple[int, int]] = [(-int(bound[0]), 0)]
        lows, highs, places = [low[0]], [high[0]], [int(at[0])]
        width = 1
        while queue and -queue[0][0] >= best.least:
            least, chosen = best.least, []
            while queue and len(chosen) < width and -queue[0][0] >= least:
                chosen.append(heapq.heappop(queue)[1])
            width = min(2 * width, WIDTH)
            low, high = np.array([lows[i] for i in chosen]), np.array([highs[i] for i in chosen])
            split = np.array([places[i] for i in chosen])
            for i in chosen:
                lows[i] = highs[i] = None
            wanted = terms[None, :] * self.size + split[:, None]
            middle = np.searchsorted(self.at, wanted)
            inside = np.minimum(middle, len(self.at) - 1)
            has = self.at[inside] == wanted
            scores = np.where(has, self.impact[inside] * times, 0).sum(axis=1)
            for s, place in zip(scores.tolist(), split.tolist()):
                if s >= best.least:
                    best.add(s, self.keys[place])
            low, high = np.concatenate([low, middle + has]), np.concatenate([middle, high])
            bound, at = self.maxima(low, high, times)
            for i in np.flatnonzero(bound >= best.least).tolist():
                heapq.heappush(queue, (-int(bound[i]), len(lows)))
                lows.append(low[i])
                highs.append(high[i])
                places.append(int(at[i]))


def _search_items(rows: DataFrame, items: list[Item], weights: np.ndarray, documents: int, all_terms: int, k: int, item_type: T.DataType) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((items, weights))
    schema = T.StructType([T.StructField("_item", T.IntegerType()), T.StructField("item", item_type), T.StructField("key", rows.schema["key"].dataType), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        best = [Best(k) for _ in items]
        docs: dict[tuple[int, bytes, bytes], list] = {}
        postings, kinds = 0, None

        def finish() -> None:
            block = Block(docs, weights, documents, all_terms)
            for item, b in zip(items, best):
                block.search(item, b)

        for batch in batches:
            kinds = batch.schema.field(0).type
            for key, n, terms, tfs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not terms:
                    continue
                keys = docs.setdefault((n, terms, tfs), [])
                if not keys:
                    postings += len(terms) // 4
                keys.append(key)
                if len(keys) > 2 * k:
                    keys.sort(key=_late)
                    del keys[k:]
                if len(docs) >= PLACES or postings >= POSTINGS:
                    for keys in docs.values():
                        keys.sort(key=_late)
                    finish()
                    docs, postings = {}, 0
        if docs:
            for keys in docs.values():
                keys.sort(key=_late)
            finish()
        for number, (item, b) in enumerate(zip(items, best)):
            if b.rows:
                keys = [None if null else key for _, (null, key) in b.rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(keys), pa.int32()), pa.array([item.name] * len(keys), names), pa.array(keys, kinds), pa.array([-s for s, _ in b.rows], pa.int64())],
                    schema.names,
                )

    from pyspark.sql.pandas.types import to_arrow_type

    names = to_arrow_type(item_type)
    return rows.mapInArrow(run, schema)


def search(docs: DataFrame, key: str, text: str, queries: DataFrame, item: str, item_text: str, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item: item, ``rank`` (from 1), key, ``score`` (above 0; equal ones by ascending key, null keys last).

    Null and empty texts have no terms: such documents aren't counted, and such items, like items whose terms no document has, give no rows. Every row of
    ``docs`` is a document, repeated ones too; equal rows of ``queries`` are one item, others with the same name are items of their own. Other columns are left out. Empty tables
    give an empty result. Items are searched for in groups of about ``ITEMS``, each a pass over the documents, so what is broadcast doesn't grow with the queries.
    """
    spark = docs.sparkSession
    wanted = queries.select(F.col(item).alias("item"), F.col(item_text).alias("text")).distinct()
    item_type, key_type = wanted.schema["item"].dataType, docs.schema[key].dataType
    groups = -(-wanted.count() // ITEMS)
    out: list[DataFrame] = []
    for group in range(groups):
        vocabulary: dict[bytes, int] = {}
        items: list[Item] = []
        for row in wanted.filter(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == group).collect():
            times = Counter(w for words in stretches(row["text"]) for w in words)
            numbers = [vocabulary.setdefault(w, len(vocabulary)) for w in times]
            if numbers:
                items.append(Item(row["item"], np.array(numbers, np.int64), np.array(list(times.values()), np.int64)))
        if not items:
            continue
        rows = counted(docs, key, text, vocabulary)
        facts = statistics(rows, len(vocabulary))
        documents, all_terms = facts.get(DOCUMENTS, 0), facts.get(TERMS, 0)
        if not documents:
            continue
        weights = np.array([weight_of(documents, facts.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        found = _search_items(rows, items, weights, documents, all_terms, k, item_type)
        order = Window.partitionBy("_item").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
        out.append(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))
    if not out:
        return spark.createDataFrame([], T.StructType([T.StructField(item, item_type), T.StructField("rank", T.IntegerType()), T.StructField(key, key_type), T.StructField("score", T.LongType())]))
    return reduce(DataFrame.unionAll, out).select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, "doc_id", "text", items, "item_id", "text")


def _terms_sql(table: str, row: str) -> str:
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return rf"SELECT {row}, unnest(regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM {table}"


OP11_SQL = f"""WITH words AS MATERIALIZED ({_terms_sql("documents", "doc_id")}),
    asked AS (SELECT item_id, term, count(*) AS q FROM ({_terms_sql("benchmark", "item_id")}) GROUP BY ALL),
    docs AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
    facts AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM docs),
    tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * max(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, facts GROUP BY term),
    lengths AS (SELECT doc_id, 25 + (75 * n * nn) // ll AS m FROM docs, facts),
    scores AS (SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY ALL)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0 QUALIFY rank <= 10"""
