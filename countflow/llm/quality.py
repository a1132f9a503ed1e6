"""Quality of documents: counts per text, and a calibrated logistic regression on hashed word and character n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.llm.labelled import fit_in_one_task, labelled_sample
from countflow.llm.logistic import fit_dense, fit_sparse, sigmoid
from countflow.llm.text import forget, slices

#: Labelled documents of each class that the model is fitted on at most.
PER_CLASS = 1500
BUCKETS = 1 << 17
CHAR_SIZES = (2, 3, 4)
WORD_SIZES = (1, 2)
#: A mean over n-grams is small; this scales it so that the ridge and the steps suit it.
SCALE = 20.0
#: A document goes where the calibrated probability of good quality, for classes of equal size, is below this.
KEEP = 0.5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\x0b\x0c\r")] = True
#: Characters or bytes that are hashed at once.
BLOCK = 1 << 20
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, at least ``n`` of each; those of a block are kept."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    made = []
    with np.errstate(over="ignore"):
        for base in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)):
            x = np.full(max(n, 1 << 16), np.uint64(base))
            x[0] = 1
            made.append(np.cumprod(x, dtype=np.uint64))
    if n <= BLOCK + 1:
        _POWERS[:] = made
    return made[0], made[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def word_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of the UTF-8 bytes ``b``, taken in blocks that end at white space (or with a longer word)."""
    out, at = [], 0
    while at < len(b):
        end = min(at + BLOCK, len(b))
        if end < len(b):
            gaps = np.flatnonzero(SPACE[b[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                while end < len(b) and not SPACE[b[end]]:
                    end += 1
        out.append(_block_hashes(b[at:end]))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _block_hashes(b: np.ndarray) -> np.ndarray:
    """The words' hashes from one running sum."""
    inside = np.concatenate([[False], ~SPACE[b], [False]]).view(np.int8)
    edge = np.diff(inside)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(b) + 1)
    with np.errstate(over="ignore"):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], dtype=np.uint64)])
        return _mixed((run[end] - run[begin]) * down[begin] + (end - begin).astype(np.uint64))


def feature_blocks(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """The buckets of the text's n-grams, block by block, each with its kind: characters (code points), then words. A very long text never has all of them in memory."""
    most = max(CHAR_SIZES) - 1
    with np.errstate(over="ignore"):
        for at in range(0, max(1, len(text)), BLOCK):
            # a block has the characters of the n-grams that begin in it
            c = np.frombuffer(text[at : at + BLOCK + most].encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
            for kind, n in enumerate(CHAR_SIZES):
                own = max(0, min(BLOCK, len(c) - n + 1))
                h = np.zeros(own, np.uint64)
                for k in range(n):
                    h = h * np.uint64(0x100000001B3) + c[k : own + k]
                yield kind, (_mixed(h + np.uint64(n << 56)) % np.uint64(BUCKETS)).astype(np.int32)
        w = word_hashes(np.frombuffer(text.encode("utf-8", "replace"), np.uint8))
        for kind, n in enumerate(WORD_SIZES, len(CHAR_SIZES)):
            h = np.zeros(max(0, len(w) - n + 1), np.uint64)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + w[k : len(w) - n + 1 + k]
            yield kind, (_mixed(h + np.uint64(n << 60)) % np.uint64(BUCKETS)).astype(np.int32)


def features(text: str) -> list[np.ndarray]:
    """The buckets of the text's n-grams, a list for each kind."""
    parts: list[list[np.ndarray]] = [[] for _ in range(len(CHAR_SIZES) + len(WORD_SIZES))]
    for kind, p in feature_blocks(text):
        parts[kind].append(p)
    return [np.concatenate(p) for p in parts]


def repeated_words(words: list[bytes], hashes: np.ndarray) -> int:
    """Words in windows of three that occur twice or more, each word once. Hashes tell where none can; bytes decide."""
    if len(words) < 4:
        return 0
    with np.errstate(over="ignore"):
        h = (hashes[:-2] * np.uint64(0x100000001B3) + hashes[1:-1]) * np.uint64(0x100000001B3) + hashes[2:]
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    marked = np.zeros(len(words), bool)
    at = np.fromiter((often[w] > 1 for w in windows), bool, len(windows))
    for k in range(3):
        marked[k : len(at) + k] |= at
    return int(marked.sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of the whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "replace")
    b = np.frombuffer(raw, np.uint8)
    words = raw.split()
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line and line.split(None, 1):
            if line in seen:
                dup += 1
            seen.add(line)
    return len(words), len(text) - int(SPACE[b].sum()), int(SYMBOLS[b].sum()), dup, repeated_words(words, word_hashes(b))


def fit(rows: list[tuple[Any, str, int]]) -> dict:
    """Weights from three quarters of the (id, text, label) rows, Platt's curve from the rest, both as if the classes were equal in size."""
    y = np.array([r[2] for r in rows], float)
    if y.min() == y.max():
        return {"constant": float(y[0])}
    prove = np.arange(len(rows)) % 4 == 0
    if len(set(y[prove])) < 2 or len(set(y[~prove])) < 2:
        prove = np.ones(len(rows), bool)
    index, value, begin = [], [], [0]
    for r in rows:
        parts = features(r[1])
        ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
        each = np.concatenate([np.full(len(p), SCALE / max(1, len(p))) for p in parts])
        u, back = np.unique(ids, return_inverse=True)
        index.append(u.astype(np.int32))
        value.append(np.bincount(back, each, len(u)).astype(np.float32))
        begin.append(begin[-1] + len(u))
    learn = np.flatnonzero(~prove) if not prove.all() else np.arange(len(rows))
    # equal weight for the classes: the rarer one's rows are repeated
    rare = learn[y[learn] == float(y[learn].mean() < 0.5)]
    learn = np.concatenate([learn, np.tile(rare, max(0, round(len(learn) / max(1, len(rare))) - 2))])
    where = np.concatenate([[0], np.cumsum([len(index[i]) for i in learn])])
    w, b = fit_sparse(np.concatenate([index[i] for i in learn]), np.concatenate([value[i] for i in learn]).astype(float), where, y[learn], BUCKETS, 1e-5, 60, 0.05)
    w = w.astype(np.float32)
    margin = np.array([value[i] @ w[index[i]] + b for i in np.flatnonzero(prove)])
    yp = y[prove]
    weight = np.where(yp == 1, 0.5 / yp.sum(), 0.5 / (1 - yp).sum())
    return {"w": w, "b": b, "platt": fit_dense(margin[:, None], yp, weight, ridge=1e-3)}


def probability(model: dict | None, texts: list[str | None]) -> np.ndarray:
    """The calibrated probability of good quality; without labels 1."""
    if model is None or "constant" in model:
        return np.full(len(texts), model["constant"] if model else 1.0)
    w, out = model["w"], np.empty(len(texts))
    for i, t in enumerate(texts):
        total, n = np.zeros(len(CHAR_SIZES) + len(WORD_SIZES)), np.zeros(len(CHAR_SIZES) + len(WORD_SIZES))
        for kind, p in feature_blocks(t or ""):
            total[kind] += w[p].sum(dtype=np.float64)
            n[kind] += len(p)
        out[i] = model["b"] + SCALE * float((total / np.maximum(n, 1)).sum())
    return sigmoid(out * model["platt"][0] + model["platt"][1])


def train(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = PER_CLASS) -> dict | None:
    """The model from a bounded sample of labelled documents. A null text counts as empty, a document that stands in several rows trains once for each. Without labels (or
    documents) there is no model: None."""
    return fit_in_one_task(labelled_sample(documents, labels, label, per_class, doc_id, text), fit)


COLUMNS = {"n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "quality_score": "double"}


def score(df: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``df`` with the counts of ``counts()`` and ``quality_score``, over whole texts in Arrow batches. Map-only.

    A null or empty text has no words and no n-grams: counts of 0 and the score of the intercept. Columns with these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    df = df.drop(*(c for c in COLUMNS if c != text))
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.LongType() if k == "bigint" else T.DoubleType()) for n, k in COLUMNS.items())])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in slices(batch, at, 2 << 20):
                texts = part.column(at).to_pylist()
                found = list(zip(*[counts(t) for t in texts])) or [()] * 5
                new = [*(pa.array(c, pa.int64()) for c in found), pa.array(probability(shared.value, texts), pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *COLUMNS])

    return df.mapInArrow(run, schema)


def judge(df: DataFrame, model: dict | None, text: str = "text", least: float = KEEP) -> DataFrame:
    """``score()`` with ``base_failed`` (under 50 words, or more than half of them in repeated windows) and ``kept``. Null and empty texts fail; repeated rows share their fate; an
    empty table stays empty."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return score(df, model, text).withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality_score") >= least))


def drop_bad(documents: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """The rows of ``documents`` that ``judge()`` keeps, with their columns whatever their names."""
    names = {c: "_text" if c == text else f"_c{k}" for k, c in enumerate(documents.columns)}
    rows = documents.select(*[F.col(c).alias(n) for c, n in names.items()])
    return judge(rows, model, "_text").filter("kept").select(*[F.col(n).alias(c) for c, n in names.items()])


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, model).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_score")
