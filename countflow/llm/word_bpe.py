"""Token ids of whole texts by a ``tokenizers`` vocabulary that cuts at white space."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from countflow.llm.text import ASCII_LOWER, kept, slices, trim

#: Words that a Python worker remembers; see text.trim.
MEMO = 800_000
#: The first byte, in UTF-8, of the combining marks that may form one character with a letter from A to Z.
MARKS = b"\xcc"


class WordTokenizer:
    """Encodes texts word by word. Right for vocabularies whose pre-tokenizer never joins text across ASCII white
    space and drops it (so each word's ids stand alone); ids are remembered by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        letters = "".join(map(chr, range(65, 91)))
        self.lowers = self.model.normalizer is not None and self.model.normalizer.normalize_str(letters) == letters.lower()
        suffix = getattr(self.model.model, "end_of_word_suffix", None)
        self.ends = None  # by id: whether the token ends a pre-token
        if suffix:
            vocab = self.model.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def _learn_joined(self, words: list[bytes], texts: dict[bytes, str]) -> bool:
        """Encodes words of letters in one call, which is faster. Each is one pre-token, so its ids run up to a token that ends one; if the numbers
        differ (a letter that lower-cases into more than letters), nothing is learned."""
        if not words:
            return True
        ids = np.array(self.model.encode_batch_fast([" ".join([texts[w] for w in words])], add_special_tokens=False)[0].ids, "<u4")
        stop = np.flatnonzero(self.ends[ids]) + 1
        if len(stop) != len(words) or stop[-1] != len(ids):
            return False
        packed, at = ids.tobytes(), 0
        for w, end in zip(words, (stop * 4).tolist()):
            self.memo[w] = packed[at:end]
            at = end
        return True

    def _words(self, text: str | None) -> list[bytes]:
        """The text's words; in lower case if the vocabulary lower-cases A-Z anyway, but not where a mark may be joined to a letter first."""
        raw = text.encode("utf-8") if text else b""
        return (raw.translate(ASCII_LOWER) if self.lowers and MARKS not in raw else raw).split()

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as packed little-endian unsigned 32-bit integers; null gives none."""
        trim(self.memo, MEMO)
        memo = self.memo
        cut = [self._words(t) for t in texts]
        new = set(chain.from_iterable(cut)).difference(memo)
        # a mark after a letter is a pre-token of its own
        marked = [w for w in new if len(w) > 1 and w[-1] in b".,;:!?" and w[-2:-1].isalpha()]
        new.difference_update(marked)
        new.update(x for w in marked for x in (w[:-1], w[-1:]) if x not in memo)
        texts_of = {w: w.decode("utf-8") for w in new}
        letters = [w for w, t in texts_of.items() if t.isalpha()]
        if self.ends is None or not self._learn_joined(letters, texts_of):
            letters = []
        plain = list(new.difference(letters))
        coded = self.model.encode_batch_fast([texts_of[w] for w in plain], add_special_tokens=False)
        for w, e in zip(plain, coded):
            memo[w] = b"".join([i.to_bytes(4, "little") for i in e.ids])
        for w in marked:
            memo[w] = memo[w[:-1]] + memo[w[-1:]]
        return [b"".join(map(memo.__getitem__, words)) for words in cut]


def tokenizer(path: str) -> WordTokenizer:
    return kept(("word_bpe", path), lambda: WordTokenizer(path))


def encode(df: DataFrame, text: str, path: str, end_id: int | None = None, ids: str = "ids") -> DataFrame:
    """``df`` with ``ids``: the packed little-endian 32-bit ids of the whole text, then ``end_id`` if given.

    A null or empty text has no ids but the end. ``path`` is the vocabulary file, which every machine has. Map-only.
    """
    end = b"" if end_id is None else end_id.to_bytes(4, "little")
    df = df.drop(ids) if ids != text else df
    schema = T.StructType([*(f for f in df.schema.fields if f.name != ids), T.StructField(ids, T.BinaryType())])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in batches:
            for part in slices(batch, at, 1 << 20):
                packed = pa.array([p + end for p in coder.encode_batch(part.column(at).to_pylist())], pa.binary())
                keep = [(n, c) for n, c in zip(part.schema.names, part.columns) if n != ids]
                yield pa.RecordBatch.from_arrays([*(c for _, c in keep), packed], [*(n for n, _ in keep), ids])

    return df.mapInArrow(run, schema)


def ids_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4")
