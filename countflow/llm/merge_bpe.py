"""BPE from a merge list (the ``tokenizers`` library's JSON format, byte-level kind): encoding and decoding.

A pre-token's symbols form a doubly linked list. A priority queue holds the merge ranks of adjacent symbols; an entry whose
pair has changed since is skipped when it comes out. Decoding concatenates the vocabulary's strings.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.llm.text import kept, slices, trim

#: Chunks between spaces that a Python worker remembers; see text.trim.
MEMO = 600_000
#: Bits of an id in a pair of ids.
PART = 24
#: Characters up to here have the same class in every version of Unicode; later ones are cut by the library's own pre-tokenizer.
LATIN = "ɏ"
#: Marks that are a pre-token of their own after a letter and before a space.
MARKS = ".,;:!?"
#: Bytes of a pre-token from which on its list is held in arrays.
LONG = 1 << 16
#: Fixed value: the pattern of the format's byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The character that stands for each byte: the byte's own where that is printable in Latin-1, else the next free one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256))
    return [chr(b) if b in printable else chr(256 + next(rest)) for b in range(256)]


def read_spec(path: str) -> dict[str, Any]:
    """The parts of a tokenizer file that matter here: vocabulary, merges, added tokens. A file that asks for anything
    else (a normalizer, a prefix space, dropout, unknown tokens) is refused; its truncation and padding aren't used."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    if model.get("type") != "BPE" or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or odd:
        raise ValueError(f"{path} isn't a plain byte-level BPE tokenizer")
    if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens", [])):
        raise ValueError("added tokens with conditions on their surroundings aren't supported")
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    return {"vocab": model["vocab"], "merges": merges, "added": {t["content"]: t["id"] for t in spec.get("added_tokens", [])}}


def _small_integers(values: Iterable[int]) -> array:
    return array("i", values)


class MergeBpe:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], added: dict[str, int]):
        letters = byte_letters()
        self.byte_id = [vocab.get(c) for c in letters]
        if None in self.byte_id:
            raise ValueError("the vocabulary lacks single bytes")
        # a pair of ids -> the rank of its merge; the rank -> the id that it makes
        self.rank = {vocab[a] << PART | vocab[b]: r for r, (a, b) in enumerate(merges)}
        self.made = [vocab[a + b] for a, b in merges]
        byte_of = {c: b for b, c in enumerate(letters)}
        spelled = {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t, i in (*vocab.items(), *added.items())}
        tokens = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.added = added
        longest_first = sorted(added, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        self.pattern = regex.compile(PATTERN)
        self.loose = regex.compile(r" (?=\s|\Z)").search  # a space that may belong to a run of white space
        self.single = regex.compile(r"(?<=\S) (?=\S)")
        self.other = None
        self.chunks: dict[str, bytes] = {}
        self.mark = {m: self.byte_id[ord(m)].to_bytes(4, "little") for m in MARKS}

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of ``text``."""
        if not text or max(text) <= LATIN:
            return self.pattern.findall(text)
        if self.other is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self.other = ByteLevel(add_prefix_space=False)
        return [text[a:b] for _, (a, b) in self.other.pre_tokenize_str(text)]

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: of all adjacent symbols with a merge, that of the lowest rank, leftmost among equals, is made until none is left."""
        n, rank, made = len(piece), self.rank.get, self.made
        box = list if n <= LONG else _small_integers
        ids = box(map(self.byte_id.__getitem__, piece))
        after, before = box(range(1, n + 1)), box(range(-1, n))
        now = box([rank(a << PART | b, -1) for a, b in zip(ids, ids[1:])])  # the rank of each symbol with the next
        now.append(-1)
        shift = n.bit_length()
        mask = (1 << shift) - 1
        queue = [r << shift | i for i, r in enumerate(now) if r >= 0]
        heapq.heapify(queue)
        push, pop = heapq.heappush, heapq.heappop
        while queue:
            top = pop(queue)
            i, r = top & mask, top >> shift
            if now[i] != r:  # stale: its pair has changed
                continue
            gone = after[i]
            stop = after[i] = after[gone]
            before[stop] = i
            new = ids[i] = made[r]
            ids[gone] = now[gone] = -1
            if stop < n:
                r = now[i] = rank(new << PART | ids[stop], -1)
                if r >= 0:
                    push(queue, r << shift | i)
            else:
                now[i] = -1
            left = before[i]
            if left >= 0:
                r = now[left] = rank(ids[left] << PART | new, -1)
                if r >= 0:
                    push(queue, r << shift | left)
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> bytes:
        """The packed ids of a pre-token that is a word of letters with the space before it, remembered."""
        packed = self.chunks.get(word)
        if packed is None:
            packed = self.chunks[word] = array("i", self.merge(b" " + word.encode("utf-8"))).tobytes()
        return packed

    def chunk(self, chunk: str) -> bytes:
        """The packed ids of a chunk with the space before it. Where it is letters alone, or letters and one mark, its pre-tokens are known without the pattern."""
        if chunk and max(chunk) <= LATIN:
            if chunk.isalpha():
                return self.word(chunk)
            if chunk[-1] in MARKS and chunk[:-1].isalpha():
                return self.word(chunk[:-1]) + self.mark[chunk[-1]]
        return self.pack(" " + chunk)

    def pack(self, text: str) -> bytes:
        """The ids of ``text``, which holds no added token, as little-endian 32-bit integers."""
        return array("i", chain.from_iterable(self.merge(p.encode("utf-8")) for p in self.cut(text))).tobytes()

    def plain(self, text: str) -> bytes:
        """As ``pack``. A single space between two other characters always begins a pre-token, so the text
        falls into chunks there, which don't depend on their neighbours and are remembered."""
        if not text:
            return b""
        head, *tail = text.split(" ") if not self.loose(text) else self.single.split(text)
        chunks = self.chunks
        for c in set(tail).difference(chunks):
            chunks[c] = self.chunk(c)
        return self.pack(head) + b"".join(map(chunks.__getitem__, tail))

    def encode(self, text: str | None) -> bytes:
        """The packed ids of a whole text; null gives none. Added tokens are found first, as the library does."""
        trim(self.chunks, MEMO)
        if not text:
            return b""
        if self.marks is None or not self.marks.search(text):
            return self.plain(text)
        parts = self.marks.split(text)
        return b"".join(self.added[p].to_bytes(4, "little") if k % 2 else self.plain(p) for k, p in enumerate(parts))

    def decode_batch(self, packed: list[bytes]) -> list[str]:
        """The text of each list of packed ids. Ids that no token has give nothing, bytes that aren't UTF-8 the replacement character."""
        ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
        counts = np.cumsum([0, *(len(p) // 4 for p in packed)])
        known = ids < len(self.lengths)
        ids = np.where(known, ids, 0)
        n = np.where(known, self.lengths[ids], 0)
        ends = np.cumsum(n)
        whole = self.bytes[np.repeat(self.begins[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        at = np.concatenate([[0], ends])[counts].tolist()
        return [whole[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]


def _coder(path: str) -> MergeBpe:
    return kept(("merge_bpe", path), lambda: MergeBpe(**read_spec(path)))


def encode(df: DataFrame, text: str, vocabulary: str, ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with ``ids``, the token ids of the whole text as an array, by the tokenizer file ``vocabulary`` (a path that every machine has).

    A null or empty text gives an empty array, never null; repeated rows are encoded alike, an empty table stays empty. Other columns
    pass through, and columns of the new names are replaced. ``decoded`` names a column for the text that those ids decode to, so that a
    round trip passes through one Python worker. Map-only. A batch is cut into slices of about 1 MB of text, so texts of any length meet
    in small numbers; a single pre-token takes about 60 bytes of memory for each of its bytes while it is merged.
    """
    new = [ids] if decoded is None else [ids, decoded]
    at = df.columns.index(text)
    keep = [c for c in df.columns if c not in new]
    made = {ids: T.StructField(ids, T.ArrayType(T.IntegerType())), decoded: T.StructField(decoded or "", T.StringType())}
    schema = T.StructType([*(df.schema[c] for c in keep), *(made[n] for n in new)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary)
        for batch in batches:
            for part in slices(batch, at, 1 << 20):
                packed = [coder.encode(t) for t in part.column(at).to_pylist()]
                offsets = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
                out: list[pa.Array] = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))]
                if decoded is not None:
                    out.append(pa.array(coder.decode_batch(packed), pa.string()))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), *out], [*keep, *new])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str, vocabulary: str, out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of the ids. Null ids give null; ids that no token has give nothing."""

    @F.arrow_udf(T.StringType())
    def spell(lists: pa.Array) -> pa.Array:
        coder = _coder(vocabulary)
        rows = lists.to_pylist()
        texts = iter(coder.decode_batch([np.array(r, "<u4").tobytes() for r in rows if r is not None]))
        return pa.array([None if r is None else next(texts) for r in rows], pa.string())

    return df.withColumn(out, spell(ids))


def op13_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = encode(docs, "text", public_tokenizers.path("byte_bpe_50k.json"), decoded="decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
