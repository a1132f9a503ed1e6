"""Removal of documents whose set of word shingles has a Jaccard similarity from a bound on to that of a document that stays, exactly, by prefix filtering."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.llm.bloom import may_repeat, split_members, without
from countflow.llm.simhash import shingle_hashes
from countflow.llm.skew import join_back
from countflow.llm.text import forget, slices
from countflow.session import checkpoint

SIZE = 5
#: The least similarity, as a fraction: 4 / 5.
LEAST = (4, 5)
#: One text in so many is looked through for common shingles; those in ``COMMON`` of them come last in the order, the most common ``MOST`` at most.
#: The order changes the cost only.
ONE_IN, COMMON, MOST = 4, 2, 2_000_000
#: Rounds in which each shingle's sets meet the first of them only; then what is left of a shingle's sets meets pair by pair, in blocks of about ``BLOCK`` sets.
ROUNDS, BLOCK = 6, 64
#: Rounds end early where the sets left make at most so many pairs for each time that one is at a shingle: then pairs cost less than another round's jobs.
FEW = 8


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """The hashes of the text's different shingles, in order."""
    return np.unique(shingle_hashes(text, size).view(np.int64))


def common_shingles(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are in several texts of a sample, in order, and in how many each is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, 1 << 20):
                found = [shingle_set(t, size) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, np.int64)]), pa.int64())], ["token"])

    some = rows.filter(F.pmod(F.xxhash64("text"), F.lit(ONE_IN)) == 0).select("text").mapInArrow(run, "token long")
    often = some.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON)
    found = often.orderBy(F.desc("n"), "token").limit(MOST).select("token", F.least("n", F.lit(1 << 30)).cast("int").alias("n")).toArrow()
    tokens, counts = found.column(0).to_numpy(), found.column(1).to_numpy()
    order = np.argsort(tokens)
    return tokens[order], counts[order]


def in_order(own: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The shingles of a set by rising frequency in the sample; those that aren't common in it come first, equally frequent ones go by their hash. One order of all shingles."""
    tokens, counts = common
    late = _among(own, tokens)
    last = own[late]
    return np.concatenate([own[~late], last[np.argsort(counts[np.searchsorted(tokens, last)], kind="stable")]])


def _among(own: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of ``own`` are in the sorted array ``ordered``."""
    if not len(ordered):
        return np.zeros(len(own), bool)
    return ordered[np.minimum(np.searchsorted(ordered, own), len(ordered) - 1)] == own


def _prefixes(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (doc_id, mark, text) as doc_id, mark, kind (a digest of the text's set of shingles), m (its size) and the first ``tokens`` of the set."""
    common = rows.sparkSession.sparkContext.broadcast(common_shingles(rows, size))
    up, down = LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                digests, sizes, firsts = [], [], []
                for t in part.column(2).to_pylist():
                    own = shingle_set(t, size)
                    digests.append(xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63))
                    sizes.append(len(own))
                    firsts.append(in_order(own, common.value)[: len(own) + (-up * len(own)) // down + 1])
                arrays = [part.column(0), part.column(1), pa.array(digests, pa.int64()), pa.array(sizes, pa.int32()), pa.array(firsts, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "mark", "kind", "m", "tokens"])

    schema = T.StructType([rows.schema["doc_id"], T.StructField("mark", T.LongType()), T.StructField("kind", T.LongType()), T.StructField("m", T.IntegerType()), T.StructField("tokens", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(run, schema)


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """``texts`` (kind, text) as kind and the whole set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingle_set(t, size).tobytes() for t in part.column(1).to_pylist()], pa.binary())], ["kind", "own"])

    return texts.mapInArrow(run, "kind long, own binary")


def _similar(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The ``pairs`` (x, y: kinds) whose whole sets are similar. ``sets_of``: the sets of a table of kinds, computed apart for either side, since each has few of the other's."""
    up, down = LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.int64), np.frombuffer(y.as_py(), np.int64)
                both = int(_among(x, y).sum())
                keep.append(down * both >= up * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    xs, ys = (sets_of(pairs.select(F.col(n).alias("kind")).distinct()).select(F.col("kind").alias(n), F.col("own").alias(f"{n}s")) for n in ("x", "y"))
    return pairs.join(xs, "x").join(ys, "y").select("x", "y", "xs", "ys").mapInArrow(run, "x long, y long")


def _fits(x: str, y: str) -> Column:
    """Whether two sets that share a shingle may be similar, by their sizes and its place in each."""
    up, down = LEAST
    xm, ym = F.col(f"{x}.m"), F.col(f"{y}.m")
    # a shared shingle is the first that two sets share, or an earlier one meets too: so many can be shared from there on
    most = F.least(xm - F.col(f"{x}.at"), ym - F.col(f"{y}.at"))
    return (xm * down >= ym * up) & (ym * down >= xm * up) & (most * (up + down) >= (xm + ym) * up)


def similar_rows(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(id, mark: the text's XXH64) of the rows to drop: in order of ids, a row is dropped if it is similar to an earlier one that stays. So no two rows that stay are similar, and each
    row that goes has a similar one that stays. Rows without an id are left out.

    Shingles are known by 64-bit hashes. In any one order of all shingles, two sets of a similarity of 4 / 5 or more share one among the first
    fifth (and one more) of each, so equality on those finds every pair; sizes and places are compared too, and whole sets decide. Common
    shingles come last in the order; a Bloom filter tells which of the first ones may be in two sets, and only those are shuffled. Equal sets count as one from the start.

    A set that comes first at all its shingles stays, for what came before it there is gone or was compared with it. In a round such sets meet all others at their shingles; those
    similar to them go, so a group of copies costs a pair for each of them. What is left after ``ROUNDS``, or once it makes few pairs, meets pair by pair, each shingle's sets in blocks that spread over tasks, and the
    similar pairs are settled in the same order.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    marked = checkpoint(_prefixes(rows, size))
    narrow = checkpoint(marked.select("doc_id", "mark", "kind"))
    kinds = checkpoint(narrow.groupBy("kind").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.count("*").alias("copies")))
    copies = join_back(narrow, kinds, "kind", "copies", ["doc_id", "mark"]).filter(F.struct("doc_id", "mark") != F.col("first")).select(F.col("doc_id").alias("id"), "mark")
    tokens = marked.select("doc_id", "kind", "m", F.posexplode("tokens").alias("at", "token"))
    count = marked.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()[0]
    maybe = may_repeat(tokens, "token", count, {"_maybe": 2}).filter("_maybe")
    met = checkpoint(maybe.groupBy("token", "kind").agg(F.min("doc_id").alias("id"), F.first("m").alias("m"), F.first("at").alias("at")))
    similar = lambda pairs: _similar(pairs, lambda need: _sets(_texts(rows, kinds, need), size))
    gone: list[DataFrame] = []
    open_ = 1
    for _ in range(ROUNDS):
        met, dead = _settle_first(met, similar)
        gone += dead
        left = met.groupBy("token").agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows"), F.sum(F.expr("n * (n - 1) div 2")).alias("pairs")).first()
        open_ = left["rows"] or 0
        if not open_ or left["pairs"] <= FEW * open_:
            break
    if open_:
        gone += _settle_pairs(checkpoint(similar(checkpoint(_pairs(met)))))
    out = copies
    if gone:
        out = out.unionByName(narrow.join(reduce(DataFrame.unionByName, gone).distinct(), "kind", "left_semi").select(F.col("doc_id").alias("id"), "mark"))
    return out.distinct()


def _settle_first(met: DataFrame, similar: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list[DataFrame]]:
    """One round: sets that come first at all their shingles stay, and those similar to them go. ``met`` (token, kind, id, m, at) of the sets that are still open, and the kinds that go (none or one table)."""
    lead = met.groupBy("token").agg(F.min(F.struct("id", "kind", "m", "at")).alias("x"), F.count("*").alias("n")).filter("n > 1")
    lead = checkpoint(lead.select("token", F.struct("x.kind", "x.m", "x.at").alias("x"), "n"))
    both = checkpoint(join_back(met, lead, "token", "n", ["kind"]))
    second = F.col("kind") != F.col("x.kind")
    stay = checkpoint(both.groupBy("kind").agg(F.max(second).alias("waits")).filter("NOT waits").select("kind"))
    near = both.filter(second).select("x", F.struct("m", "at").alias("y"), "kind").filter(_fits("x", "y")).select(F.col("x.kind").alias("x"), F.col("kind").alias("y"))
    pairs = checkpoint(near.join(stay.select(F.col("kind").alias("x")), "x", "left_semi").distinct())
    left = both.select("token", "kind", "id", "m", "at").join(stay, "kind", "left_anti")
    if not pairs.limit(1).count():
        return checkpoint(left), []
    dead = checkpoint(similar(pairs).select(F.col("y").alias("kind")).distinct())
    return checkpoint(left.join(dead, "kind", "left_anti")), [dead]


def _pairs(met: DataFrame) -> DataFrame:
    """(x, y): the pairs of open sets that share a shingle and may be similar, x before y. A shingle with many sets is cut into blocks of them, and each pair of blocks meets apart."""
    blocks = met.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = met.join(blocks, "token").withColumn("b", F.pmod(F.xxhash64("kind"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = lambda n, low, high: dealt.select("token", F.col(low).alias("_low"), F.col(high).alias("_high"), F.struct("id", "kind", "m", "at").alias(n))
    # at the blocks (low, high) the sets of the one on the left meet those of the other on the right, so two sets meet once in either order
    met_pairs = side("x", "b", "c").join(side("y", "c", "b"), ["token", "_low", "_high"])
    earlier = F.struct("x.id", "x.kind") < F.struct("y.id", "y.kind")
    return met_pairs.filter(earlier & _fits("x", "y")).select(F.col("x.kind").alias("x"), F.col("y.kind").alias("y")).distinct()


def _settle_pairs(pairs: DataFrame) -> list[DataFrame]:
    """The kinds that go, by all similar ``pairs`` (x, y) of open sets: round by round, sets that are behind no other stay, and those behind them go."""
    gone = []
    while pairs.limit(1).count():
        stay = pairs.select("x").distinct().join(pairs.select(F.col("y").alias("x")).distinct(), "x", "left_anti")
        dead = checkpoint(pairs.join(stay, "x", "left_semi").select(F.col("y").alias("kind")).distinct())
        gone.append(dead)
        lost = dead.select(F.col("kind").alias("x"))
        pairs = checkpoint(pairs.join(lost, "x", "left_anti").join(lost.select(F.col("x").alias("y")), "y", "left_anti"))
    return gone


def _texts(rows: DataFrame, kinds: DataFrame, need: DataFrame) -> DataFrame:
    """(kind, text) of the first row of each of the kinds ``need`` (of each of its copies, if rows share id and text); only rows that a Bloom filter of their marks lets pass are shuffled."""
    wanted = checkpoint(kinds.join(need, "kind").select("kind", F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_mark")))
    hit, _ = split_members(rows, "mark", wanted, "_mark")
    return hit.join(wanted, (F.col("mark") == F.col("_mark")) & (F.col("doc_id") == F.col("_id"))).select("kind", "text")


def drop_similar(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``documents`` without the rows of ``similar_rows``: no two rows that stay are similar. Empty and null texts count as equal. Ids may repeat: a row goes for its
    own text, and rows that share id and text are one document. Rows without an id stay. An empty table stays empty."""
    return without(documents, checkpoint(similar_rows(documents, doc_id, text, size)), doc_id, text)
