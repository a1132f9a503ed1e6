"""Toxicity by compression distance: how much better a window compresses with a dictionary of toxic text.

Two zstandard dictionaries are trained, on toxic and on ordinary text. Both compressors hold the ordinary dictionary at the same place; before it
the toxic one has the toxic dictionary, the other as many zero bytes. So ordinary words cost the same in either, byte for byte, and the
difference in length is what toxic text alone explains. Toxic documents are mostly ordinary prose, so the toxic dictionary is trained on those stretches
of their words whose letter sequences are far more frequent in toxic documents than in ordinary ones, whatever the language. Each word's first
byte is written several times before compression, so that a match from a word's beginning weighs more than one inside a word. A document is cut
into windows, all of it; its windows' differences are summed up in a few figures, and a logistic curve fitted on documents that trained no
dictionary turns these into a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.llm.labelled import class_counts, fit_in_one_task, labelled_sample
from countflow.llm.logistic import fit_dense, sigmoid
from countflow.llm.text import forget, id_remainder, slices

#: Labelled documents of each class that the model is fitted on at most: two thirds train the dictionaries, a third the curve.
PER_CLASS = 1800
WINDOW = 64
#: The ordinary dictionary is small, so that it has common words only: rare ordinary words may be like toxic ones.
TOXIC_BYTES, ORDINARY_BYTES = 4096, 16384
#: Times that a word's first byte is written, and the least length of a match, which is longer than these and the space before the word.
FIRST_BYTE, MIN_MATCH = 3, 7
#: Letter sequences of this many bytes mark toxic stretches: at least so many times as frequent among the different words of toxic documents as
#: among those of ordinary ones, and in at least so many documents (fewer where fewer are labelled) and twice as many words.
GRAM, GRAM_RATIO, GRAM_TEXTS = 6, 8.0, 4
THRESHOLD = 0.3


def windows(text: str) -> list[bytes]:
    """The text in lower case with single spaces, cut at spaces into windows of about ``WINDOW`` bytes; all of it is in some window."""
    b = b" " + b" ".join(text.lower().encode("utf-8", "replace").split())
    out, i, n = [], 0, len(b)
    while i < n and n > 1:
        j = i + WINDOW
        if j < n:
            cut = b.rfind(b" ", i + 1, j + 1)
            j = cut if cut > i else j
        out.append(b[i:j])
        i = j
    return out


_BEGIN = re.compile(rb" ([^ ])")
_BEGUN = b" " + rb"\1" * FIRST_BYTE


def stressed(words: bytes) -> bytes:
    """Each word's first byte, after a space, written ``FIRST_BYTE`` times."""
    return _BEGIN.sub(_BEGUN, words)


def different_words(text: str) -> list[bytes]:
    return [b" " + w for w in sorted(set(text.lower().encode("utf-8", "replace").split()))]


def _grams(words: list[bytes]) -> list[bytes]:
    return [w[i : i + GRAM] for w in words for i in range(len(w) - GRAM + 1)]


def toxic_marks(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> set[bytes]:
    """The letter sequences that mark toxic text, from the different words of each document."""
    often, texts, other = Counter(), Counter(), Counter()
    for words in toxic:
        found = _grams(words)
        often.update(found)
        texts.update(set(found))
    for words in ordinary:
        other.update(_grams(words))
    least = min(GRAM_TEXTS, 2 + len(toxic) // 50)
    share = GRAM_RATIO * often.total() / max(1, other.total())
    return {g for g, n in often.items() if texts[g] >= least and n >= 2 * least and n > share * (other[g] + 2)}


def stretches(words: list[bytes], marks: set[bytes]) -> list[bytes]:
    """The longest runs of marked letter sequences in ``words``."""
    out = []
    for w in words:
        hits = [i for i in range(len(w) - GRAM + 1) if w[i : i + GRAM] in marks]
        for k, i in enumerate(hits):
            if not k or hits[k - 1] != i - 1:
                first = i
            if k + 1 == len(hits) or hits[k + 1] != i + 1:
                out.append(w[first : i + GRAM])
    return out


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of the samples; few or tiny samples, which the trainer refuses, are used as they are, each once and the most frequent last."""
    try:
        return zstandard.train_dictionary(size, samples, k=24, d=8, level=3).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(x for x, _ in reversed(Counter(samples).most_common()))[-size:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Compresses small windows with the dictionary ``content``: matches of ``MIN_MATCH`` bytes or more, and literals as they are."""
    d = zstandard.ZstdCompressionDict(content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    p = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=18, chain_log=16, search_log=4, min_match=MIN_MATCH, target_length=1, strategy=zstandard.STRATEGY_FAST, write_content_size=False, write_dict_id=False, write_checksum=False
    )
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p)


class Compressors:
    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = compressor(toxic + ordinary), compressor(b"\0" * len(toxic) + ordinary)

    def figures(self, text: str) -> list[float]:
        """Of the windows' differences: mean, largest, mean of the largest three, shares of at least 2, 4 and 6, and how many are 4 or more."""
        t, o = self.toxic.compress, self.ordinary.compress
        d = np.array([len(o(w)) - len(t(w)) for w in map(stressed, windows(text))], float)
        if not len(d):
            return [0.0] * 7
        return [d.mean(), d.max(), np.sort(d)[-3:].mean(), (d >= 2).mean(), (d >= 4).mean(), (d >= 6).mean(), float(np.log1p((d >= 4).sum()))]


def fit(rows: list[tuple[Any, str, int]], prior: float) -> dict:
    """Dictionaries and curve from (id, text, label) rows; ``prior``: the share of toxic documents among all labelled ones."""
    toxic, ordinary = ([t for _, t, y in rows if y == k] for k in (1, 0))
    if not toxic or not ordinary:
        return {"constant": float(bool(toxic))}
    learn = lambda x: [t for i, t in enumerate(x) if i % 3 or len(x) < 6]
    prove = lambda x: [t for i, t in enumerate(x) if i % 3 == 0 or len(x) < 6]
    words = [different_words(t) for t in dict.fromkeys(learn(toxic))]
    marks = toxic_marks(words, [different_words(t) for t in dict.fromkeys(learn(ordinary))])
    bad = train_dictionary([stressed(x) for w in words for x in stretches(w, marks)], TOXIC_BYTES)
    good = train_dictionary([stressed(w) for t in learn(ordinary) for w in windows(t)], ORDINARY_BYTES)
    c = Compressors(bad, good)
    x = np.array([c.figures(t) for t in [*prove(toxic), *prove(ordinary)]])
    y = np.array([1.0] * len(prove(toxic)) + [0.0] * len(prove(ordinary)))
    weight = np.where(y == 1, prior / max(1, y.sum()), (1 - prior) / max(1, (1 - y).sum()))
    mean, dev = x.mean(0), x.std(0) + 1e-6
    return {"toxic": bad, "ordinary": good, "mean": mean, "dev": dev, "beta": fit_dense((x - mean) / dev, y, weight, ridge=1e-4)}


class Scorer:
    def __init__(self, model: dict | None):
        self.model = model
        self.compressors = Compressors(model["toxic"], model["ordinary"]) if model and "toxic" in model else None

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.compressors is None:
            return np.full(len(texts), self.model["constant"] if self.model else 0.0)
        x = np.array([self.compressors.figures(t or "") for t in texts]).reshape(-1, 7)
        x = (x - self.model["mean"]) / self.model["dev"]
        return sigmoid(x @ self.model["beta"][:-1] + self.model["beta"][-1])


def train(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", where=None, per_class: int = PER_CLASS) -> dict | None:
    """The model from a bounded sample of labelled documents (``where``: a condition on the label rows).

    A null text counts as empty. A document that stands in several rows trains once for each; equal texts count once for the marks. Without labels
    (or documents) there is no model: None.
    """
    known = labels if where is None else labels.filter(where)
    counts = class_counts(known, label)
    prior = min(0.99, max(0.01, counts.get(1, 0) / max(1, counts.get(0, 0) + counts.get(1, 0))))
    return fit_in_one_task(labelled_sample(documents, known, label, per_class, doc_id, text), lambda rows: fit(rows, prior))


def score(df: DataFrame, model: dict | None, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with ``out``, the probability that the whole text is toxic. Map-only; a null or empty text has no windows and
    gets the curve's value for none. Without toxic labels every score is 0, without others 1. A column named ``out`` is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    df = df.drop(out) if out != text else df
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in slices(batch, at, 2 << 20):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scorer.score(part.column(at).to_pylist()), pa.float64())], [*part.schema.names, out])

    return df.mapInArrow(run, schema)


def drop_toxic(documents: DataFrame, model: dict | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` whose score is below ``threshold``, with their columns whatever their names. Repeated rows share their fate, null
    and empty texts are scored like any others, and an empty table stays empty."""
    names = {c: "_text" if c == text else f"_c{k}" for k, c in enumerate(documents.columns)}
    rows = documents.select(*[F.col(c).alias(n) for c, n in names.items()])
    return score(rows, model, "_text").filter(F.col("score") < threshold).select(*[F.col(n).alias(c) for c, n in names.items()])


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = train(docs, labels, where=id_remainder("doc_id", 4) != 2)
    scored = score(docs, model)
    return scored.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
