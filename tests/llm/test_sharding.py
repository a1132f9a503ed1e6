import zlib
from collections import Counter

import pytest
import xxhash

from countflow.llm.sharding import assign_shards, jump_hash, shard_manifest


def brute(doc_id: int, shards: int) -> int:
    """The jump chain of one key by plain integers, with XXH64 (seed 42) of long values as Spark has it."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    pack = lambda x: (x & ((1 << 64) - 1)).to_bytes(8, "little")
    seed = xxhash.xxh64_intdigest(pack(doc_id), seed=42)
    at = 0
    while True:
        h = xxhash.xxh64_intdigest(pack(at), seed=xxhash.xxh64_intdigest(pack(signed(seed)), seed=42))
        to = int((at + 1) * float(1 << 31) / float((h >> 33) + 1))
        if to >= shards:
            return at
        at = to


def test_matches_brute_force(spark, docs):
    rows = shard_manifest(docs, 16).collect()
    assert len(rows) == docs.count()
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    for r in rows:
        assert r["shard"] == brute(r["doc_id"], 16) and r["grown_shard"] == brute(r["doc_id"], 17)
        assert r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]])
        assert r["law"] == "key"
    for shard, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


@pytest.mark.parametrize("n", [1, 2, 15, 16, 100])
def test_growth_moves_rows_only_into_the_new_shard(spark, n):
    keys = spark.range(20000).withColumnRenamed("id", "k")
    rows = assign_shards(keys, "k", n).withColumn("next", jump_hash(keys["k"], n + 1)).collect()
    moved = [r for r in rows if r["next"] != r["shard"]]
    assert all(r["next"] == n and r["grown_shard"] == n for r in moved)
    assert all(r["grown_shard"] == r["next"] for r in rows)
    assert abs(len(moved) / len(rows) - 1 / (n + 1)) < 0.02
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(n)) and max(sizes.values()) < 1.3 * len(rows) / n + 30


def test_odd_rows(odd, clashing, none):
    rows = shard_manifest(clashing, 3).collect()
    assert len(rows) == odd.count()
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (3, 4)} == {(1, 0)}
    for shard, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    assert shard_manifest(none, 16).count() == 0
    with pytest.raises(ValueError):
        jump_hash(odd["doc_id"], 0)


def test_a_hot_key_is_spread(spark):
    rows = spark.createDataFrame([(1, f"t{i % 3}") for i in range(900)] + [(i, "x") for i in range(2, 300)], "doc_id long, text string")
    out = shard_manifest(rows, 4).collect()
    for shard, n in Counter(r["shard"] for r in out).items():
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(n))
