"""Byte-level BPE: a minimal perfect hash answers whole pre-tokens, a heap over linked bytes the rest."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.llm.mph import MinimalPerfectHash
from countflow.llm.text import kept, slices, trim

#: Chunks between spaces, and pre-tokens inside them, that a Python worker remembers; see text.trim.
MEMO, INNER = 600_000, 100_000
#: Bits of an id in a pair of ids.
PART = 24
#: Letters up to here are letters in every version of Unicode that a pattern may follow.
LATIN = "\u024f"


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a ``.tiktoken`` rank file (base64 token, rank), in rank order without gaps."""
    with open(path, "rb") as f:
        ranks = {int(r): base64.b64decode(t) for t, r in (line.split() for line in f if line.strip())}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


def _pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if len(ids) > 1 else ids[0].to_bytes(4, "little") if ids else b""


class ByteBpe:
    """Encodes text into token ids. ``tokens`` lists the tokens' bytes by rank; ``pattern`` cuts text into pre-tokens."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, regex.compile(pattern)
        hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], dtype=np.uint64)
        self.mph = MinimalPerfectHash.build(hashes)
        self.id_at = np.empty(len(tokens), dtype=np.int64)
        self.id_at[self.mph.lookup(hashes)] = np.arange(len(tokens))
        rank = {t: i for i, t in enumerate(tokens)}
        self.byte_id = [rank.get(bytes([b])) for b in range(256)]
        # the token that two adjacent ones make up, for every cut of every token into two
        self.pair = {a << PART | b: i for t, i in rank.items() for k in range(1, len(t)) if (a := rank.get(t[:k])) is not None and (b := rank.get(t[k:])) is not None}
        if None in self.byte_id:
            raise ValueError("the vocabulary lacks single bytes")
        self.loose = regex.compile(r" (?=\s|\Z)").search  # a space that may belong to a run of white space
        self.one_piece = self.pattern.findall(" Abc") == [" Abc"] and self.pattern.findall(" abc,") == [" abc", ","]
        self.chunks: dict[str, bytes] = {}  # each with the space before it
        self.inner: dict[str, bytes] = {}  # pre-tokens without one
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def whole(self, pieces: list[bytes]) -> list[int]:
        """The id of each pre-token that is a token, else -1: one vectorised look-up, then a comparison of bytes."""
        at = self.mph.lookup(np.array([xxhash.xxh3_64_intdigest(p) for p in pieces], dtype=np.uint64))
        ids = np.where(at >= 0, self.id_at[at], -1).tolist()
        tokens = self.tokens
        return [i if i >= 0 and tokens[i] == p else -1 for i, p in zip(ids, pieces)]

    def merge(self, piece: bytes) -> list[int]:
        """Merges adjacent parts, lowest rank first and leftmost first among equals. Parts are linked by their starts; a heap holds a pair's rank and
        the start of its left part (packed into one integer), so a merge costs O(log n). ``ranks`` has each start's present pair: an entry
        of another rank is out of date."""
        n, pair = len(piece), self.pair.get
        ids = list(map(self.byte_id.__getitem__, piece))
        after, before = list(range(1, n + 1)), list(range(-1, n))
        ranks = [pair(a << PART | b) for a, b in zip(ids, ids[1:])]
        ranks.append(None)
        shift, mask = n.bit_length(), (1 << n.bit_length()) - 1
        heap = [r << shift | i for i, r in enumerate(ranks) if r is not None]
        heapq.heapify(heap)
        push, pop = heapq.heappush, heapq.heappop
        while heap:
            top = pop(heap)
            i, r = top & mask, top >> shift
            if ranks[i] != r:
                continue
            mid = after[i]
            stop = after[i] = after[mid]
            before[stop] = i
            ids[i], ids[mid], ranks[mid] = r, -1, None
            new = ranks[i] = pair(r << PART | ids[stop]) if stop < n else None
            if new is not None:
                push(heap, new << shift | i)
            left = before[i]
            if left >= 0:
                new = ranks[left] = pair(ids[left] << PART | r)
                if new is not None:
                    push(heap, new << shift | left)
        return [i for i in ids if i >= 0]

    def learn(self, pieces: set[str]) -> None:
        """Remembers the packed ids of new pre-tokens."""
        new = [p for p in pieces if (p[1:] not in self.chunks if p[:1] == " " else p not in self.inner)]
        raw = [p.encode("utf-8") for p in new]
        for p, b, i in zip(new, raw, self.whole(raw) if raw else []):
            packed = i.to_bytes(4, "little") if i >= 0 else _pack(self.merge(b))
            if p[:1] == " ":
                self.chunks[p[1:]] = packed
            else:
                self.inner[p] = packed

    def cut(self, chunk: str) -> list[str]:
        """The pre-tokens of a chunk with the space before it. Of letters alone, or letters and one mark, they are known without the pattern."""
        if self.one_piece and chunk and max(chunk) <= LATIN:
            if chunk.isalpha():
                return [" " + chunk]
            if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
                return [" " + chunk[:-1], chunk[-1]]
        return self.pattern.findall(" " + chunk)

    def ids(self, piece: str) -> bytes:
        return self.chunks[piece[1:]] if piece[:1] == " " else self.inner[piece]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as packed little-endian unsigned 32-bit integers; null gives none.

        A space before a character that isn't white space always begins a pre-token, so a text without other
        spaces falls into chunks there; a chunk's pre-tokens don't depend on its neighbours and are remembered.
        """
        trim(self.chunks, MEMO)
        trim(self.inner, INNER)
        first: list[list[str]] = []
        rest: list[list[str]] = []
        for t in texts:
            head, *tail = t.split(" ") if t and not self.loose(t) else [t or ""]
            first.append(self.pattern.findall(head))
            rest.append(tail)
        cut = {c: self.cut(c) for c in set(chain.from_iterable(rest)).difference(self.chunks)}
        self.learn({p for x in (first, cut.values()) for pieces in x for p in pieces})
        ids, chunks = self.ids, self.chunks
        for c, pieces in cut.items():
            if len(pieces) > 1:
                chunks[c] = b"".join(map(ids, pieces))
        get = chunks.__getitem__
        return [b"".join(map(ids, f)) + b"".join(map(get, tail)) for f, tail in zip(first, rest)]

    def decode_batch(self, packed: list[bytes]) -> list[bytes]:
        """The bytes of each list of packed ids, by one gather from the vocabulary's bytes."""
        ids = np.frombuffer(b"".join(packed), "<u4")
        n = self.lengths[ids]
        ends = np.cumsum(n)
        whole = self.bytes[np.repeat(self.begins[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        at = np.concatenate([[0], ends])[np.cumsum([0, *(len(p) // 4 for p in packed)])].tolist()
        return [whole[a:b] for a, b in zip(at, at[1:])]


def _coder(tokens: list[bytes], pattern: str) -> ByteBpe:
    return kept(("byte_bpe", len(tokens), hash(tuple(tokens[-64:])), pattern), lambda: ByteBpe(tokens, pattern))


def encode(df: DataFrame, text: str, tokens: list[bytes], pattern: str, ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with ``ids``: the packed little-endian 32-bit token ids of the whole text. A null or empty text
    gives no ids (an empty value, never null). Columns of the new names are replaced. ``decoded`` names a column for the bytes
    that those ids decode to, so that a round trip passes through one Python worker.

    Map-only. The vocabulary is broadcast (its file's size, whatever the data); Arrow batches are cut
    into slices of a few MB, so that very long texts meet in small numbers.
    """
    spark = df.sparkSession
    new = [ids] if decoded is None else [ids, decoded]
    df = df.drop(*(n for n in new if n != text))
    shared = spark.sparkContext.broadcast((tokens, pattern))
    schema = T.StructType([*(f for f in df.schema.fields if f.name not in new), *(T.StructField(n, T.BinaryType()) for n in new)])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*shared.value)
        for batch in batches:
            for part in slices(batch, at, 1 << 20):
                packed = coder.encode_batch(part.column(at).to_pylist())
                made = [packed] if decoded is None else [packed, coder.decode_batch(packed)]
                keep = [(n, c) for n, c in zip(part.schema.names, part.columns) if n not in new]
                yield pa.RecordBatch.from_arrays([*(c for _, c in keep), *(pa.array(m, pa.binary()) for m in made)], [*(n for n, _ in keep), *new])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str, tokens: list[bytes], out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the bytes of packed ids, as binary, for they need not be valid UTF-8. Null ids give null;
    an id outside the vocabulary is an error."""
    shared = df.sparkSession.sparkContext.broadcast(tokens)

    @F.arrow_udf(T.BinaryType())
    def spell(packed: pa.Array) -> pa.Array:
        get = shared.value.__getitem__
        return pa.array([None if p is None else b"".join(map(get, np.frombuffer(p, "<u4").tolist())) for p in packed.to_pylist()], pa.binary())

    return df.withColumn(out, spell(ids))


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokens = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = encode(docs, "text", tokens, public_tokenizers.PATTERN, decoded="decoded")
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
