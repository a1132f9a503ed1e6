"""Best-fit packing: partitions pack their items, then all bins that are at most half full meet those with the most room.

A lot is packed by best fit, largest first, which leaves at most one of its bins at most half full: only these few can still go into another bin. Whichever bins they went into, the emptiest
would take them as well, and n of them need n such bins at most. So the n small bins and the n emptiest of all others, whatever lot they come from, are packed as items of their used length,
and no two sequences of the result fit into one. A task gets at most two bins a lot there, and nothing depends on how many items there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.llm import word_bpe
from countflow.llm.bloom import plain_names
from countflow.session import checkpoint

#: Items that a task packs at once; a larger partition is packed in several lots.
LOT = 400_000
#: A lot's ``ITEMS / FAN_IN`` emptiest bins have their used length beside them. That is for finding its small bin, the emptiest of all; which bins meet isn't limited by it.
ITEMS, FAN_IN = 4096, 8


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and each bin's used length, by best fit with the largest items first.

    Open bins are kept by free room; one integer has a bit for each room that occurs, so the
    smallest room that is large enough is found by a shift.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used: list[int] = []
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = open_at[room].pop()
            if not open_at[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(used)
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        left = room - n
        if left:
            open_at[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(used, np.int64)


def _pack_partitions(df: DataFrame, length: str, capacity: int, level: int) -> DataFrame:
    """``df`` with ``_bin`` (unique over both levels and all partitions), ``_offset`` and ``_used`` (of the lot's emptiest bins). At level 1 a partition is one lot."""
    most, full = max(1, ITEMS // FAN_IN), capacity - capacity // 256
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.LongType()) for n in ("_bin", "_offset", "_used"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = (level << 56) | (TaskContext.get().partitionId() << 34)
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first
            out = pa.Table.from_batches(held)
            held.clear()
            lengths = out.column(length).fill_null(0).to_numpy()
            good = (lengths >= 1) & (lengths <= capacity)
            bins, offsets, used = best_fit(lengths[good], capacity)
            emptiest = np.argsort(used, kind="stable")[:most]
            handed = np.zeros(len(used), bool)
            handed[emptiest[used[emptiest] < full]] = True
            on = good.copy()
            on[good] = handed[bins]
            for name, x, there in (("_bin", bins + first, good), ("_offset", offsets, good), ("_used", used[bins], on)):
                whole = np.zeros(len(good), np.int64)
                whole[good] = x
                out = out.append_column(name, pa.array(whole, pa.int64(), mask=~there))
            first += len(used)
            yield from out.to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if not level and sum(b.num_rows for b in held) >= LOT:
                    yield from flush()
        if held:
            yield from flush()

    return df.mapInArrow(run, schema)


def pack(items: DataFrame, length: str, capacity: int, sequence: str = "sequence_id", offset: str = "offset") -> DataFrame:
    """``items`` with the sequence each is packed into and its place there. Places are gapless from 0.

    Lengths are 1 .. ``capacity``; a row whose length is null or not in that range gets neither sequence nor place. Ties and repeated rows are
    items of their own. An empty table gives an empty result. Columns named ``sequence`` or ``offset`` are replaced. The items are written once to the shared folder, so a lost
    executor never changes a bin that others have been told of.
    """
    rows, back = plain_names(items.select([c for c in items.columns if c not in (sequence, offset) or c == length]), length=length)
    placed = checkpoint(_pack_partitions(rows, "length", capacity, 0))
    bins = checkpoint(placed.filter(F.col("_bin").isNotNull()).groupBy(F.col("_bin").alias("_item")).agg(F.sum("length").alias("_length")))
    half = F.col("_used") * 2 <= capacity
    small = checkpoint(placed.filter(half).groupBy(F.col("_bin").alias("_item")).agg(F.first("_used").alias("_length")))
    n, least = small.agg(F.count("*"), F.min("_length")).first()
    # n small bins fill at most n - 1 others before the last of them is placed, so one of the n emptiest is untouched till then, and no bin left out here has more room
    hosts = bins.filter((F.col("_length") * 2 > capacity) & (F.col("_length") <= capacity - (least or 0))).orderBy("_length", "_item").limit(n)
    met = checkpoint(_pack_partitions(small.unionByName(hosts).repartition(1).sortWithinPartitions("_item"), "_length", capacity, 1))
    chain = met.select("_item", F.col("_bin").alias("_to"), F.col("_offset").alias("_by"))
    out = placed.join(chain, placed["_bin"] == chain["_item"], "left")
    cols = [F.col(n).alias(c) for n, c in back.items()]
    return out.select(*cols, F.coalesce("_to", "_bin").alias(sequence), (F.col("_offset") + F.coalesce("_by", F.lit(0))).alias(offset))


def cut_pieces(df: DataFrame, ids: str, capacity: int) -> DataFrame:
    """A row for each piece of at most ``capacity`` ids: ``piece`` (from 0), ``start``, ``length`` and the piece's ids in ``ids``
    (packed 32-bit). Only longer id lists are cut; an empty or null one has no piece."""
    n = F.floor(F.octet_length(ids) / 4).cast("bigint")
    cut = df.withColumn("_n", n).filter(F.col("_n") > 0)
    cut = cut.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / capacity).cast("bigint"))))
    start = F.col("piece") * capacity
    cut = cut.withColumn("start", start).withColumn("length", F.least(F.col("_n") - F.col("start"), F.lit(capacity)).cast("bigint"))
    short = F.col("_n") <= capacity
    body = F.when(short, F.col(ids)).otherwise(F.substr(ids, (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")))
    return cut.withColumn("piece", F.col("piece").cast("int")).withColumn(ids, body).drop("_n")


def pack_documents(documents: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents' pieces with sequence and offset: each text's ids by the vocabulary, then ``end_id``, cut
    only where longer than ``capacity``. A null text counts as empty (one id, the end). Other columns aren't read."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    coded = word_bpe.encode(rows, "text", vocabulary, end_id).select("doc_id", "ids")
    pieces = cut_pieces(coded, "ids", capacity).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(checkpoint(pieces), "length", capacity)  # one Python worker a core: encoding and packing are stages of their own


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
