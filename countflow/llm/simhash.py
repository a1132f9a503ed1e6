"""SimHash near-duplicates by the generalised pigeonhole principle (Qin and others, 2018)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.llm.bloom import without
from countflow.llm.skew import join_back
from countflow.llm.text import forget, slices, words_of
from countflow.llm.vectors import sum_over_partitions
from countflow.operators.components import connected_components
from countflow.session import checkpoint

SHINGLE = 3
SEED = 42
BITS = 64
#: Counters of a group's values at most.
COUNTERS = 1 << 20
#: What a probe costs, in values met.
PROBE = 4
#: For each byte value its bits, lowest first: (256, 8).
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words, repeats included; of the whole sequence where there are fewer words."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = [0, *ends[:-size].tolist()]
    return np.array([digest(joined[b:e], SEED) for b, e in zip(begins, (ends[size - 1 :] - 1).tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set where over half of the hashes have it; no hashes give zero."""
    if not len(hashes):
        return 0
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 200:
        ones = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ BYTE_BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Each document's id, mark (its text's XXH64) and fingerprint (the unsigned value's bits as a signed long). Map-only, over whole texts."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("mark", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in slices(batch, 2, 8 << 20):
                found = np.array([fingerprint(shingle_hashes(t, size)) for t in part.column(2).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found.view(np.int64), pa.int64())], ["doc_id", "mark", "fp"])

    return rows.mapInArrow(run, schema)


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_groups(distinct: DataFrame, groups: int) -> list[list[int]]:
    """The 64 bit positions in ``groups`` groups of nearly equal size, bits that correlate over all fingerprints
    together: then a group's values repeat what they share once, and the other groups select better."""

    def moments(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(1 + BITS + BITS * BITS)
        for batch in batches:
            b = _bits(batch.column(0).to_numpy().view(np.uint64)).astype(np.float32)
            if len(b):
                total += np.concatenate([[len(b)], b.sum(0, dtype=np.float64), (b.T @ b).astype(np.float64).ravel()])
        return total

    m = sum_over_partitions(distinct.select("fp"), moments)
    corr = np.zeros((BITS, BITS))
    if m is not None and m[0] > 1:
        mean = m[1 : 1 + BITS] / m[0]
        cov = m[1 + BITS :].reshape(BITS, BITS) / m[0] - np.outer(mean, mean)
        dev = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        corr = np.abs(cov / np.outer(dev, dev))
        np.fill_diagonal(corr, 0)
    left, out = set(range(BITS)), []
    for k in range(groups):
        size = (BITS + k) // groups
        group = [max(sorted(left), key=lambda i: corr[i, sorted(left)].sum())]
        left.remove(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda i: corr[i, group].sum())
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def group_values(fps: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of ``group`` of each fingerprint, closed up into one integer."""
    out = np.zeros(len(fps), np.uint64)
    for k, bit in enumerate(group):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out.astype(np.int64)


def _flips(width: int, radius: int) -> list[np.ndarray]:
    """By distance 0 .. ``radius``: the masks of that many bits."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(width), d)], np.int64) for d in range(radius + 1)]


def allocate(costs: np.ndarray, total: int) -> np.ndarray:
    """Thresholds by dynamic programming. ``costs[:, i, t + 1]``: what threshold t (-1: leave out) in group i costs a
    fingerprint. Returns for each fingerprint the thresholds of least cost that add up to ``total``."""
    n, groups, choices = costs.shape
    low, high = -groups, groups * (choices - 2)
    best = np.full((n, high - low + 1), np.inf)
    best[:, -low] = 0
    came = []
    for i in range(groups):
        to, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
        for t in range(-1, choices - 1):
            src = best[:, max(0, -t) : best.shape[1] - max(0, t)]
            dst = slice(max(0, t), best.shape[1] - max(0, -t))
            c = src + costs[:, i, t + 1][:, None]
            better = c < to[:, dst]
            to[:, dst] = np.where(better, c, to[:, dst])
            pick[:, dst] = np.where(better, t, pick[:, dst])
        best = to
        came.append(pick)
    out, at, rows = np.empty((n, groups), np.int64), np.full(n, total - low), np.arange(n)
    for i in reversed(range(groups)):
        out[:, i] = came[i][rows, at]
        at = at - out[:, i]
    return out


def choose_groups(n: int, distance: int = 3) -> tuple[int, float]:
    """How many groups cost ``n`` fingerprints least, and what they cost each. Fewer groups are wider, so a probe meets fewer values, but need more probes.

    With m groups thresholds add up to ``distance`` - m + 1. The cost is that of equal thresholds over evenly spread values: the probes, which are
    shuffled, and the ``n`` / 2**width values that each meets.
    """

    def cost(m: int) -> float:
        each, more = divmod(distance - m + 1, m)
        widths = [(BITS + k) // m for k in range(m)]
        probes = [sum(comb(w, d) for d in range(each + (k < more) + 1)) for k, w in enumerate(widths)]
        return sum(p * (PROBE + n / (1 << w)) for p, w in zip(probes, widths))

    return min(((m, cost(m)) for m in range(2, distance + 2)), key=lambda x: x[1])


def links(distinct: DataFrame, distance: int = 3, groups: int | None = None) -> DataFrame:
    """Every pair (a, b), a < b, of distinct fingerprints that differ in ``distance`` bits or fewer, once.

    If two fingerprints are that close, then for any thresholds that add up to ``distance`` - ``groups`` + 1 some group's values
    differ in no more bits than its threshold. ``groups`` follows the number of fingerprints (see choose_groups), so that a probe meets few of them at any
    size. Each fingerprint gets its own thresholds, by dynamic
    programming on how many fingerprints hold the values it would probe; they are counted over all fingerprints, in at
    most ``groups`` * 2**20 counters (values that share one are counted together). Its probes meet the index by an equality join on (group, value), and the join tests the
    whole distance, so only true links leave it. A value that many fingerprints share is costly, so the allocation turns to other groups; what
    remains is dealt out over salts in proportion to its count.
    """
    spark = distinct.sparkSession
    number = distinct.count()
    groups = groups or choose_groups(number, distance)[0]
    if groups < 2 or distance < groups - 1:
        raise ValueError("groups must be 2 to distance + 1")
    parts = bit_groups(distinct, groups)
    total = distance - groups + 1
    cells = [min(1 << len(g), COUNTERS) for g in parts]

    def cell(i: int, v: np.ndarray) -> np.ndarray:
        if cells[i] == 1 << len(parts[i]):
            return v
        with np.errstate(over="ignore"):
            return ((v.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)  # 20 bits

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for i, g in enumerate(parts):
                v, n = np.unique(cell(i, group_values(fps, g)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), i), pa.int32()), pa.array(v, pa.int64()), pa.array(n, pa.int64())], ["part", "value", "n"])

    counted = distinct.select("fp").mapInArrow(values, "part int, value long, n long").groupBy("part", "value").agg(F.sum("n").alias("n")).toArrow()
    counts = [np.zeros(c, np.int32) for c in cells]
    at, value, n = (counted.column(c).to_numpy() for c in ("part", "value", "n"))
    for i in range(groups):
        counts[i][value[at == i]] = np.minimum(n[at == i], (1 << 31) - 1)
    shared = spark.sparkContext.broadcast(counts)
    radius = distance if groups > 3 else 2  # the largest threshold of a group; wide groups have too many masks of three bits
    fan = 256

    def salts(i: int, v: np.ndarray) -> np.ndarray:
        # what chance puts into a counter beside the value is no reason to deal it out
        return -(-np.maximum(shared.value[i][cell(i, v)].astype(np.int64) - number // cells[i], 1) // fan)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column(0).to_numpy()
            fps = signed.view(np.uint64)
            for i, g in enumerate(parts):
                v = group_values(fps, g)
                with np.errstate(over="ignore"):
                    salt = ((fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % salts(i, v)
                yield pa.RecordBatch.from_arrays([pa.array((i << BITS // 2) | v, pa.int64()), pa.array(salt, pa.int64()), pa.array(signed, pa.int64())], ["bucket", "salt", "b"])

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = [_flips(len(g), radius) for g in parts]
        for whole in batches:
            for begin in range(0, whole.num_rows, 2000):
                signed = whole.column(0).slice(begin, 2000).to_numpy()
                fps = signed.view(np.uint64)
                vals = [group_values(fps, g) for g in parts]
                costs = np.zeros((len(fps), groups, radius + 2))
                for i in range(groups):
                    total_cost = np.zeros(len(fps))
                    for t in range(radius + 1):
                        near = shared.value[i][cell(i, vals[i][:, None] ^ flips[i][t][None, :])]
                        total_cost = total_cost + near.sum(axis=1, dtype=np.int64) + len(flips[i][t])
                        costs[:, i, t + 1] = total_cost
                thresholds = allocate(costs, total)
                for i in range(groups):
                    for t in range(radius + 1):
                        who = np.flatnonzero(thresholds[:, i] >= t)
                        if not len(who):
                            continue
                        v = (vals[i][who][:, None] ^ flips[i][t][None, :]).ravel()
                        a = np.repeat(signed[who], len(flips[i][t]))
                        there = shared.value[i][cell(i, v)] > 0  # nothing holds the other values
                        v, a = v[there], a[there]
                        s = salts(i, v)
                        v, a = np.repeat(v, s), np.repeat(a, s)
                        salt = np.arange(len(v)) - np.repeat(np.cumsum(s) - s, s)
                        for lo in range(0, len(v), 200_000):
                            cut = slice(lo, lo + 200_000)
                            yield pa.RecordBatch.from_arrays([pa.array((i << BITS // 2) | v[cut], pa.int64()), pa.array(salt[cut], pa.int64()), pa.array(a[cut], pa.int64())], ["bucket", "salt", "a"])

    one = distinct.select("fp")
    near = one.mapInArrow(probes, "bucket long, salt long, a long").join(one.mapInArrow(index, "bucket long, salt long, b long"), ["bucket", "salt"])
    near = near.filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
    return near.select("a", "b").distinct()


def _members(documents: DataFrame, doc_id: str, text: str, size: int, distance: int) -> DataFrame:
    """doc_id, mark, fp, and ``first``: the struct (doc_id, mark) of the group's first row, null where no row of the group has an id."""
    rows = checkpoint(fingerprints(documents, doc_id, text, size))
    own = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))
    distinct = checkpoint(rows.groupBy("fp").agg(F.min(own).alias("first"), F.count("*").alias("n")))
    found = checkpoint(connected_components(checkpoint(links(distinct, distance))))
    # a component may hold much of the table: its name comes from one row for each component that has several fingerprints
    linked = checkpoint(distinct.join(found.withColumnRenamed("node", "fp"), "fp"))
    named = checkpoint(linked.groupBy("label").agg(F.min("first").alias("named"), F.count("*").alias("members")))
    of = join_back(linked.select("fp", "label"), named, "label", "members", ["fp"]).select("fp", "named")
    groups = checkpoint(distinct.join(of, "fp", "left").select("fp", "n", F.coalesce("named", "first").alias("first")))
    return join_back(rows, groups, "fp", "n", ["doc_id", "mark"])


def near_groups(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = 3) -> DataFrame:
    """One row per input row: doc_id, fp (fingerprint as a signed long) and component_id, the smallest id reachable over
    fingerprints that differ in ``distance`` bits or fewer.

    A null text counts as empty; texts without words have fingerprint zero and are linked to each other, and to near ones, like any
    others. Null ids are members but never name a component unless it has no other id. Repeated rows stay. An empty table gives an empty result.
    Copies meet as one fingerprint before any pair is formed, and in the joins back a fingerprint or component with more rows than a task's fair
    share is dealt out by a salt; at most as many of them as there are shuffle partitions can be that frequent, so their list is broadcast.
    """
    return _members(documents, doc_id, text, size, distance).select("doc_id", "fp", F.col("first")["doc_id"].alias("component_id"))


def drop_near_copies(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = 3) -> DataFrame:
    """``documents`` with one document of each group, the one with the smallest id (of those the text with the smallest hash). Ids may repeat: a row
    goes for its own text. Rows that share id and text are one document. Rows without an id stay."""
    rows = _members(documents, doc_id, text, size, distance).filter(F.col("doc_id").isNotNull())
    gone = rows.filter(F.struct("doc_id", "mark") != F.col("first")).select(F.col("doc_id").alias("id"), "mark").distinct()
    return without(documents, checkpoint(gone), doc_id, text)


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    groups = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
