"""Scores whole documents with a gated recurrent language model, and with the unigram model it starts from.

1. Words are counted over all training texts: in each task, then by a shuffle of (hash, count).
2. The most frequent words are known to every task (a fixed number of them); of the others only hashes travel.
3. The network is trained on every training text once, in ``ROUNDS`` rounds over disjoint parts: each partition trains from the
   same weights, and the partitions' weights are averaged by the number of words.
4. Every text is read into symbols once, which are written; training and scoring read those. What a document's rarer words add depends on their counts, which an equality join brings.

Words are known by 64-bit hashes; among 10**9 different words two share one with a chance of 3 %.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.llm.gru import CLASS_SIZE, Gru
from countflow.llm.text import id_remainder, slices, text_or_empty, words_of
from countflow.llm.vectors import sum_over_partitions
from countflow.session import checkpoint

#: Words with their own softmax row, and words whose counts every task holds. Neither depends on the input's size.
HEADS, KNOWN = 32 * CLASS_SIZE, 1 << 16
#: Open classes of rarer words, told apart by their last letters.
OPEN = 64
ROUNDS = 3
SMOOTH = 0.1
#: Tokens that a task trains on or scores at once.
LOT = 4_000_000
#: Different rarer words that a task remembers before it starts anew.
MEMO = 500_000


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


#: The end of a document is a token of its own; a seed keeps its hash apart from that of any word.
END = xxhash.xxh3_64_intdigest(b"end", seed=1) - (1 << 63)


def open_class(word: bytes) -> int:
    return zlib.crc32(word.rstrip(b".,;:!?")[-2:]) % OPEN


def count_words(texts: DataFrame) -> DataFrame:
    """(hash, open, n) over the column ``text``: each different word and the end token, how often it occurs, and its open class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        ends = 0

        def flush() -> pa.RecordBatch:
            nonlocal ends
            words = list(seen)
            hashes = [word_hash(w) for w in words] + [END]
            kinds = [open_class(w) for w in words] + [0]
            n = [*seen.values(), ends]
            seen.clear()
            ends = 0
            return pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(kinds, pa.int32()), pa.array(n, pa.int64())], ["hash", "open", "n"])

        for batch in batches:
            for part in slices(batch, 0, 1 << 20):
                for t in part.column(0).to_pylist():
                    ends += 1
                    seen.update(words_of(t))
                if len(seen) > MEMO:
                    yield flush()
        if ends or seen:
            yield flush()

    return texts.select("text").mapInArrow(run, "hash long, open int, n long").filter("n > 0").groupBy("hash").agg(F.min("open").alias("open"), F.sum("n").alias("n"))


class Lexicon:
    """The frequent words by hash, as every task holds them. ``hashes`` are in order of frequency, the end token first."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, kinds: np.ndarray, open_mass: np.ndarray):
        self.hashes, self.counts, self.kinds, self.open_mass = hashes, counts, kinds, open_mass
        self.heads = min(HEADS, len(hashes))
        self.log_count = np.log10(counts + SMOOTH)


class Reader:
    """Turns texts into numbers: 0 .. known - 1 for the lexicon's words, and from there on for the others met so far."""

    def __init__(self, lexicon: Lexicon):
        self.lex = lexicon
        self.number = {h: i for i, h in enumerate(lexicon.hashes.tolist())}
        self.reset()

    def reset(self) -> None:
        reader, known = self, len(self.lex.hashes)

        class Memo(dict):
            def __missing__(self, word: bytes) -> int:
                h = word_hash(word)
                n = reader.number.get(h)
                if n is None:
                    n = known + len(reader.other_hash)
                    reader.other_hash.append(h)
                    reader.other_kind.append(open_class(word))
                self[word] = n
                return n

        self.other_hash, self.other_kind = array("q"), array("q")
        self.memo = Memo()

    def numbers(self, text: str | None) -> np.ndarray:
        """The text's words and the end token."""
        words = words_of(text)
        out = np.zeros(len(words) + 1, np.int64)
        out[:-1] = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        return out

    def symbols(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The network's symbols, and the hashes of the words outside the lexicon (repeats included)."""
        heads, known = self.lex.heads, len(self.lex.hashes)
        out = numbers.copy()
        middle = (numbers >= heads) & (numbers < known)
        out[middle] = heads + self.lex.kinds[numbers[middle]]
        rare = numbers >= known
        at = numbers[rare] - known
        if not len(at):
            return out, np.empty(0, np.int64)
        out[rare] = heads + np.frombuffer(self.other_kind, np.int64)[at]
        return out, np.frombuffer(self.other_hash, np.int64)[at]


class LanguageModel:
    """What training yields: token totals, the lexicon, the network's weights, and the table of all counts."""

    def __init__(self, tokens: int, distinct: int, lexicon: Lexicon, weights: np.ndarray, counts: DataFrame):
        self.tokens, self.distinct, self.lexicon, self.weights, self.counts = tokens, distinct, lexicon, weights, counts


def _network(lex: Lexicon, weights: np.ndarray | None) -> Gru:
    net = Gru(lex.counts[: lex.heads] + SMOOTH, lex.open_mass)
    return net if weights is None else net.load(weights)


def lexicon_of(texts: DataFrame) -> tuple[int, int, Lexicon, DataFrame]:
    """Number of tokens and of distinct ones over the column ``text``, the lexicon, and the table of all counts."""
    counts = checkpoint(count_words(texts))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # only counts from the class at which the lexicon is full are sorted, not the whole vocabulary
    level = F.floor(F.log2("n") * 64)
    least, found = None, 0
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("v")).collect(), key=lambda r: -r["level"]):
        if found < KNOWN:
            least, found = r["level"], found + r["v"]
    frequent = counts if least is None else counts.filter((level >= least) | (F.col("hash") == END))
    top = frequent.orderBy(F.when(F.col("hash") == END, 0).otherwise(1), F.desc("n"), "hash").limit(KNOWN).toArrow()
    hashes, n, kinds = top.column("hash").to_numpy(), top.column("n").to_numpy().astype(float), top.column("open").to_numpy().astype(np.int64)
    if not len(hashes):
        hashes, n, kinds = np.array([END]), np.zeros(1), np.zeros(1, np.int64)
    heads = min(HEADS, len(hashes))
    mass = np.full(OPEN, SMOOTH)  # a word never seen has the weight of its class's smoothing
    for r in counts.groupBy("open").agg(F.sum(F.col("n") + F.lit(SMOOTH)).alias("m")).collect():
        mass[r["open"]] += r["m"]
    np.subtract.at(mass, kinds[:heads], np.where(n[:heads] > 0, n[:heads] + SMOOTH, 0))
    return int(total["n"]), int(total["v"]), Lexicon(hashes, n, kinds, np.maximum(mass, SMOOTH)), counts


def encode(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``rows`` with the column ``text`` read into what training and scoring need of it, written once: the other columns, ``_row`` (unique), ``n_tokens``, ``_symbols`` (packed 16-bit network symbols, the last one the end), ``_known`` and
    ``_base`` (number and summed log counts of the lexicon's words), ``_more`` (log shares within open classes), and the hashes of the rarer words with how often each occurs. Null texts count as empty."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    keep = [c for c in rows.columns if c != "text"]
    at = rows.columns.index("text")
    longs = T.ArrayType(T.LongType())
    made = {"_row": T.LongType(), "n_tokens": T.LongType(), "_symbols": T.BinaryType(), "_known": T.LongType(), "_base": T.DoubleType(), "_more": T.DoubleType(), "_rare": longs, "_times": longs}
    schema = T.StructType([*(rows.schema[c] for c in keep), *(T.StructField(n, t) for n, t in made.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        reader, known, open_log = Reader(lex), len(lex.hashes), np.log10(lex.open_mass)
        row = TaskContext.get().partitionId() << 34
        for batch in batches:
            for piece in slices(batch, at, 1 << 20):
                out: dict[str, list] = {n: [] for n in made if n != "_row"}
                for t in piece.column(at).to_pylist():
                    numbers = reader.numbers(t)
                    s, others = reader.symbols(numbers)
                    seen = numbers[numbers < known]
                    middle = seen[seen >= lex.heads]
                    others, often = np.unique(others, return_counts=True)
                    # of an open class the network gives the class; the word's share of it is its smoothed count
                    more = float(lex.log_count[middle].sum() - open_log[s[s >= lex.heads] - lex.heads].sum())
                    for n, v in zip(out, (len(s), s.astype("<u2").tobytes(), int((lex.counts[seen] > 0).sum()), float(lex.log_count[seen].sum()), more, others, often)):
                        out[n].append(v)
                    if len(reader.memo) > MEMO:
                        reader.reset()
                n = piece.num_rows
                columns = [pa.array(np.arange(row, row + n), pa.int64()), pa.array(out["n_tokens"], pa.int64()), pa.array(out["_symbols"], pa.binary()), pa.array(out["_known"], pa.int64()), pa.array(out["_base"], pa.float64()), pa.array(out["_more"], pa.float64()), *(pa.array(out[c], pa.list_(pa.int64())) for c in ("_rare", "_times"))]
                row += n
                yield pa.RecordBatch.from_arrays([*(piece.column(piece.schema.get_field_index(c)) for c in keep), *columns], schema.names)

    return checkpoint(rows.mapInArrow(run, schema))


def learn(coded: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """The network's weights after ``ROUNDS`` rounds over the rows of ``coded``, which ``_round`` deals to them."""
    weights = _network(lexicon, None).flat()
    for k in range(ROUNDS):
        shared = coded.sparkSession.sparkContext.broadcast((lexicon, weights))

        def part(batches: Iterator[pa.RecordBatch], shared=shared) -> np.ndarray | None:
            lex, start = shared.value
            net, held, size, seen = _network(lex, start), [], 0, 0
            for batch in batches:
                for packed in batch.column(0):
                    held.append(np.frombuffer(packed.as_buffer(), "<u2").astype(np.int32))
                    size += len(held[-1])
                    if size >= LOT:
                        net.train(held)
                        seen, size = seen + size, 0
                        held.clear()
            if held:
                net.train(held)
                seen += size
            return np.concatenate([net.flat() * seen, [seen]]) if seen else None

        summed = sum_over_partitions(coded.filter(F.col("_round") == k).select("_symbols"), part)
        shared.unpersist()
        if summed is not None:
            weights = summed[:-1] / summed[-1]
    return weights


def _round(part: Column | None, text: str) -> Column:
    return F.pmod(part if part is not None else F.xxhash64(text), F.lit(ROUNDS)).cast("int")


def train(documents: DataFrame, text: str = "text", part: Column | None = None) -> LanguageModel:
    """A model of all texts of ``documents``. ``part``: an integer column, 0 or more, that deals them to rounds (a hash of the text by default).

    Null texts count as empty: the end token alone. Without documents the model knows no word and gives every token the same probability.
    """
    texts = documents.select(text_or_empty(text).alias("text"), _round(part, text).alias("_round"))
    tokens, distinct, lex, counts = lexicon_of(texts)
    return LanguageModel(tokens, distinct, lex, learn(encode(texts, lex), lex), counts)


def score(documents: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens (with the end), n_known, base_score and score, both log10 of the whole text's probability.

    A null text counts as empty and has the end token alone. Null ids and repeated rows are scored like any others. An empty table
    gives an empty result. Documents are scored in lots that a task's memory holds; the join brings counts of the rarer words only, once for each document that has the
    word. A word that no training text has may be in any number of documents: its rows are the large side of a join whose other side has each word once, so Spark's adaptive skew join (on by default) splits them.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return score_encoded(encode(rows, model.lexicon), model)


def score_encoded(coded: DataFrame, model: LanguageModel) -> DataFrame:
    """As ``score``, of rows that ``encode`` has made with the model's lexicon and the column ``doc_id``."""
    shared = coded.sparkSession.sparkContext.broadcast((model.lexicon, model.weights.astype(np.float32)))
    plain = ["doc_id", "_row", "n_tokens", "_known", "_base", "_more"]
    schema = T.StructType([*(coded.schema[c] for c in plain), T.StructField("_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, weights = shared.value
        net = _network(lex, weights)
        held: list[pa.RecordBatch] = []
        symbols: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal size
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            logp = net.score(symbols) / np.log(10) + table.column(5).to_numpy()
            held.clear()
            symbols.clear()
            size = 0
            return pa.RecordBatch.from_arrays([*table.columns, pa.array(logp, pa.float64())], schema.names)

        for batch in batches:
            begin = 0
            for i, packed in enumerate(batch.column(6)):
                symbols.append(np.frombuffer(packed.as_buffer(), "<u2").astype(np.int32))
                size += len(symbols[-1])
                if size >= LOT or i + 1 == batch.num_rows:
                    held.append(batch.select(range(6)).slice(begin, i + 1 - begin))
                    begin = i + 1
                if size >= LOT:
                    yield flush()
        if symbols:
            yield flush()

    scored = coded.select(*plain, "_symbols").mapInArrow(run, schema)
    others = coded.select("_row", F.explode(F.arrays_zip("_rare", "_times")).alias("w")).select("_row", F.col("w._rare").alias("hash"), F.col("w._times").alias("times"))
    found = others.join(model.counts.select("hash", "n"), "hash", "left")
    added = found.groupBy("_row").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("_more_known"), F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("_rarer"))
    norm = float(np.log10(model.tokens + SMOOTH * (model.distinct + 1)))
    rarer = F.coalesce("_rarer", F.lit(0.0))
    return scored.join(added, "_row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("_known") + F.coalesce("_more_known", F.lit(0))).alias("n_known"),
        (F.col("_base") + rarer - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("_score") + rarer).alias("score"),
    )


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = id_remainder("doc_id", 10) == 0
    tokens, distinct, lex, counts = lexicon_of(docs.filter(~held_out).select(text_or_empty("text").alias("text")))
    # every text is read into symbols once, for training and scoring
    coded = encode(docs.withColumn("_round", F.when(~held_out, _round(F.xxhash64("doc_id"), "text"))), lex)
    model = LanguageModel(tokens, distinct, lex, learn(coded, lex), counts)
    return score_encoded(coded, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
