"""Token shards: raw id payloads with a minimal perfect hash index from document keys to offsets.

A shard is two files of one stem. The ``.ids`` file holds the ids of its documents one after another, nothing else, as little-endian
unsigned 16-bit integers where the vocabulary has at most 65,536 ids, else 32-bit. The ``.idx`` file holds, little-endian:

    8 bytes   magic "CFTOKEN1"
    u4        bytes per id
    u4        length of the hash function, then the hash function (mph.MinimalPerfectHash.to_bytes)
    u8        number of distinct keys k, number of documents n
    k x u4    fingerprint of the key in each hash slot
    k x u8    first document with that key, by hash slot
    k x u4    how many documents have it
    n+1 x u8  offset of each document in the payload, in ids; the last is the payload's length

A look-up hashes the key, compares the fingerprint, and reads the document's ids at its offset: no search, no key list.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.llm import word_bpe
from countflow.llm.mph import MinimalPerfectHash
from countflow.llm.text import slices
from countflow.session import checkpoint, shared_dir, shuffle_partitions

MAGIC = b"CFTOKEN1"


def _hash(key: Any) -> int:
    """A key's hash: of its text, with null apart from every text."""
    return xxhash.xxh3_64_intdigest(b"\x00" if key is None else b"=" + str(key).encode())


def _print(key: Any) -> int:
    return xxhash.xxh32_intdigest(b"\x00" if key is None else b"=" + str(key).encode())


def open_dir(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI (file, hdfs, s3, gs)."""
    return pafs.FileSystem.from_uri(uri)


def index_bytes(keys: list, offsets: list[int], width: int) -> bytes:
    """The index of documents with ``keys``, equal ones next to each other, at ``offsets`` (one more than keys)."""
    firsts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
    counts = np.diff([*firsts, len(keys)])
    hashes = np.array([_hash(keys[i]) for i in firsts], np.uint64)
    mph = MinimalPerfectHash.build(hashes)
    slot = mph.lookup(hashes)
    prints, first, count = np.empty(len(firsts), "<u4"), np.empty(len(firsts), "<u8"), np.empty(len(firsts), "<u4")
    prints[slot], first[slot], count[slot] = [_print(keys[i]) for i in firsts], firsts, counts
    body = mph.to_bytes()
    return b"".join((MAGIC, struct.pack("<II", width, len(body)), body, struct.pack("<QQ", len(firsts), len(keys)), prints.tobytes(), first.tobytes(), count.tobytes(), np.array(offsets, "<u8").tobytes()))


class ShardReader:
    """Constant-time keyed access to one shard."""

    def __init__(self, fs: pafs.FileSystem, stem: str):
        with fs.open_input_stream(f"{stem}.idx") as f:
            data = f.read()
        if data[:8] != MAGIC:
            raise ValueError(f"{stem}.idx isn't a token index")
        self.width, size = struct.unpack_from("<II", data, 8)
        self.mph = MinimalPerfectHash.from_bytes(data[16 : 16 + size])
        at = 16 + size
        k, n = struct.unpack_from("<QQ", data, at)
        at += 16
        self.prints = np.frombuffer(data, "<u4", k, at)
        self.first = np.frombuffer(data, "<u8", k, at + 4 * k)
        self.count = np.frombuffer(data, "<u4", k, at + 12 * k)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 16 * k)
        self.payload = fs.open_input_file(f"{stem}.ids")

    def close(self) -> None:
        self.payload.close()

    def find(self, keys: list) -> list[list[int]]:
        """For each key the numbers of its documents in the shard (none where it has none)."""
        slot = self.mph.lookup(np.array([_hash(k) for k in keys], np.uint64)).tolist()
        return [list(range(f := int(self.first[s]), f + int(self.count[s]))) if s >= 0 and int(self.prints[s]) == _print(k) else [] for s, k in zip(slot, keys)]

    def ids(self, document: int) -> np.ndarray:
        begin, end = int(self.offsets[document]), int(self.offsets[document + 1])
        return np.frombuffer(self.payload.read_at((end - begin) * self.width, begin * self.width), f"<u{self.width}").astype("<u4")


def write(df: DataFrame, key: str, text: str, vocabulary: str, end_id: int | None, to: str) -> DataFrame:
    """Writes shards of the texts' ids to the folder ``to`` (a URI that all machines reach) in ascending key order, and
    returns their manifest: shard, stem (the files' name), n_docs, n_ids, first_key, last_key; shards follow one another in key order.

    A null text counts as empty, a null key sorts first, and documents that share a key are ordered by a hash of their text
    and found together under it, also where they fill several shards. Texts are encoded before they are sorted, so their ids shuffle, at their width in the files.
    A task writes files under a name of its own, which the manifest gives, so one that is repeated disturbs nothing; nothing is moved. An empty table writes no shard.
    """
    fs, root = open_dir(to)
    fs.create_dir(root, recursive=True)
    rows = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("order"), F.col(text).alias("text"))
    kind = rows.schema["key"]
    # the shards' ranges are found on keys alone, so that texts are encoded once, on their way to their shard
    parts = shuffle_partitions(df.sparkSession)
    at = F.struct("key", "order")
    dealt = rows.select("key", "order").repartitionByRange(parts, "key", "order").groupBy(F.spark_partition_id().alias("p")).agg(F.min(at).alias("at"))
    begins = dealt.agg(F.sort_array(F.collect_list("at")).alias("_begins"))  # one row, of as many ranges as there are shuffle partitions
    rows = rows.crossJoin(F.broadcast(begins)).withColumn("part", F.greatest(F.lit(0), F.size(F.filter("_begins", lambda b: b <= at)) - 1)).drop("_begins")
    end = b"" if end_id is None else end_id.to_bytes(4, "little")
    coded_schema = T.StructType([kind, T.StructField("order", T.LongType()), T.StructField("width", T.IntegerType()), T.StructField("ids", T.BinaryType()), T.StructField("part", T.IntegerType())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_bpe.tokenizer(vocabulary)
        width = 2 if coder.model.get_vocab_size(with_added_tokens=True) <= 1 << 16 and (end_id or 0) < 1 << 16 else 4
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                ids = [word_bpe.ids_of(packed + end).astype(f"<u{width}").tobytes() for packed in coder.encode_batch(part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([width] * len(ids), pa.int32()), pa.array(ids, pa.binary()), part.column(3)], coded_schema.names)

    coded = rows.mapInArrow(code, coded_schema).repartitionById(parts, "part").sortWithinPartitions("key", "order")
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("stem", T.StringType()), T.StructField("n_docs", T.LongType()), T.StructField("n_ids", T.LongType()), T.StructField("first_key", kind.dataType), T.StructField("last_key", kind.dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_dir(to)
        shard = TaskContext.get().partitionId()
        stem = f"{shard:05d}-{uuid.uuid4().hex}"
        keys: list = []
        offsets, out, width = [0], None, 2
        for batch in batches:
            keys += batch.column(0).to_pylist()
            for w, ids in zip(batch.column(2).to_pylist(), batch.column(3)):
                out, width = out or fs.open_output_stream(f"{root}/{stem}.ids", compression=None), w
                body = ids.as_buffer()
                out.write(body)
                offsets.append(offsets[-1] + body.size // width)
        if not keys:
            return
        out.close()
        with fs.open_output_stream(f"{root}/{stem}.idx", compression=None) as f:
            f.write(index_bytes(keys, offsets, width))
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([stem]), pa.array([len(keys)], pa.int64()), pa.array([offsets[-1]], pa.int64()), pa.array(keys[:1], batch.schema.field(0).type), pa.array(keys[-1:], batch.schema.field(0).type)], schema.names)

    return checkpoint(coded.mapInArrow(run, schema))


def read(keys: DataFrame, key: str, manifest: DataFrame, at: str) -> DataFrame:
    """The documents of ``keys`` (rows of the column ``key``; repeats count once): key, ``start`` (ids of all documents before it)
    and ``ids`` (packed 32-bit). A key without a document gives no row.

    The manifest, a row for each shard, goes to the driver and back to the tasks. Keys are dealt to shards by its key
    ranges; only they shuffle, and each task reads the payloads in place.
    """
    spark = keys.sparkSession
    shards = sorted((r.asDict() for r in manifest.collect()), key=lambda r: r["shard"])
    before, total = {}, 0
    for r in shards:
        before[r["shard"]] = total
        total += r["n_ids"]
    shared = spark.sparkContext.broadcast((shards, before, {r["shard"]: r["stem"] for r in shards}))
    kind = keys.schema[key].dataType
    dealt_schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("key", kind)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_shards = shared.value[0]
        nulls = [r["shard"] for r in all_shards if r["first_key"] is None]
        ranged = [r for r in all_shards if r["last_key"] is not None]
        # a shard may begin with null keys; no other key sorts before its first one
        lasts = np.array([r["last_key"] for r in ranged], dtype=None if ranged and isinstance(ranged[0]["last_key"], int) else object)
        for batch in batches:
            shard, out = [], []
            values = batch.column(0).to_pylist()
            known = [v for v in values if v is not None]
            begin = np.searchsorted(lasts, np.array(known, dtype=lasts.dtype), "left").tolist() if ranged and known else [len(ranged)] * len(known)
            for v, i in zip(known, begin):
                while i < len(ranged) and (ranged[i]["first_key"] is None or ranged[i]["first_key"] <= v):
                    shard.append(ranged[i]["shard"])
                    out.append(v)
                    i += 1
            for _ in range(len(values) - len(known)):
                shard += nulls
                out += [None] * len(nulls)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(out, batch.column(0).type)], ["shard", "key"])

    found_schema = T.StructType([T.StructField(key, kind), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_dir(at)
        _, first, stems = shared.value
        reader = held = None
        for batch in batches:
            shard, wanted = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            i = 0
            while i < len(shard):
                j = i
                while j < len(shard) and shard[j] == shard[i] and j - i < 4096:
                    j += 1
                if held != shard[i]:
                    if reader:
                        reader.close()
                    held, reader = shard[i], ShardReader(fs, f"{root}/{stems[shard[i]]}")
                out: tuple[list, list, list] = ([], [], [])
                size = 0
                for k, documents in zip(wanted[i:j], reader.find(wanted[i:j])):
                    for d in documents:
                        ids = reader.ids(d).tobytes()
                        out[0].append(k)
                        out[1].append(first[held] + int(reader.offsets[d]))
                        out[2].append(ids)
                        size += len(ids)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(1).type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], found_schema.names)
                            out, size = ([], [], []), 0
                yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(1).type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], found_schema.names)
                i = j
        if reader:
            reader.close()

    dealt = keys.select(key).distinct().mapInArrow(deal, dealt_schema)
    spread = F.pmod(F.xxhash64("key"), F.lit(4))  # several tasks may read a shard
    return dealt.repartition("shard", spread).sortWithinPartitions("shard", "key").mapInArrow(fetch, found_schema)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    at = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    manifest = write(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), 2, at)
    back = read(docs, "doc_id", manifest, at)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
