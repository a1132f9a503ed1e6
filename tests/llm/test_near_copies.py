from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest

from countflow.llm import near_copies
from countflow.llm.near_copies import drop_similar


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(x, y):
    return x == y or 5 * len(x & y) >= 4 * len(x | y)


def corpus(docs):
    """Given texts, copies with a few words replaced, one line that many share, and texts of that line only."""
    rng = np.random.default_rng(5)
    texts = [r["text"] for r in docs.filter("text IS NOT NULL AND length(text) > 200").orderBy("doc_id").limit(80).collect()]
    out = []
    for t in texts:
        for copy in range(3):
            words = t.split()
            for at in rng.choice(len(words), int(len(words) * copy * 0.015), replace=False):
                words[at] = f"new{rng.integers(1 << 30)}"
            out.append(" ".join(words) + " one line of words that very many of the texts have at their end")
    return [*out, *["", "", "a b", "A b", "one line of words that very many of the texts have"]]


def greedy(texts):
    """The numbers of the texts that stay: in order, each that is similar to none that stays."""
    sets, left = [shingles(t) for t in texts], []
    for j, own in enumerate(sets):
        if not any(alike(sets[i], own) for i in left):
            left.append(j)
    return set(left)


@pytest.mark.parametrize("rounds, block", [(6, 64), (1, 3)])
def test_the_same_rows_stay_as_in_a_loop(spark, docs, monkeypatch, rounds, block):
    monkeypatch.setattr(near_copies, "ONE_IN", 2)
    monkeypatch.setattr(near_copies, "ROUNDS", rounds)
    monkeypatch.setattr(near_copies, "BLOCK", block)
    texts = corpus(docs)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    left = greedy(texts)
    assert {r["doc_id"] for r in drop_similar(frame).collect()} == left and len(left) >= 80


def chains():
    """Triples of texts: the second is similar to both others, which aren't similar to each other; and longer chains of texts that each differ a little from the one before."""
    rng = np.random.default_rng(8)
    word = lambda: f"w{rng.integers(1 << 40)}"
    texts = []
    for _ in range(20):
        middle = [word() for _ in range(60)]
        texts += [middle[:55] + [word() for _ in range(5)], middle, [word() for _ in range(5)] + middle[5:]]
    own = [word() for _ in range(80)]
    for _ in range(9):
        texts.append(own)
        at = int(rng.integers(0, 75))
        own = own[:at] + [word(), word()] + own[at + 2 :]
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("order, rounds", [(None, 6), ("reversed", 6), ("by remainder", 0)])
def test_the_order_of_shingles_doesn_t_matter(spark, monkeypatch, order, rounds):
    monkeypatch.setattr(near_copies, "ROUNDS", rounds)
    if order == "reversed":
        monkeypatch.setattr(near_copies, "in_order", lambda own, common: own[::-1])
    elif order:
        monkeypatch.setattr(near_copies, "in_order", lambda own, common: own[np.argsort(own % 1009, kind="stable")])
    texts = chains()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = greedy(texts)
    assert {0, 2} <= left and 1 not in left
    assert {r["doc_id"] for r in drop_similar(frame).collect()} == left


def test_a_row_goes_for_its_own_text(spark):
    base = " ".join(f"word{i}" for i in range(100))
    near, other = base.replace("word99", "new"), " ".join(f"other{i}" for i in range(100))
    rows = [(0, base), (1, other), (1, near), (1, near), (None, near), (2, base)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, drop_similar(frame).collect()), key=str) == sorted([(0, base), (1, other), (None, near)], key=str)


def test_the_stage_leaves_no_similar_pair(spark, sf, docs):
    texts = corpus(docs)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = [shingles(r["text"]) for r in corpus_pipeline.near_dedup(spark, frame, sf).collect()]
    assert not any(alike(x, y) for x, y in combinations(left, 2)) and len(left) >= 80


def test_rounds_end_where_pairs_are_few(spark, monkeypatch):
    """The driver plans one round, not six, where what is left makes few pairs."""
    texts, rounds, settle = chains(), [], near_copies._settle_first
    monkeypatch.setattr(near_copies, "_settle_first", lambda met, similar: rounds.append(1) or settle(met, similar))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in drop_similar(frame).collect()} == greedy(texts) and len(rounds) == 1
