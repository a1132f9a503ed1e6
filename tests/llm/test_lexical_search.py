import math
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest

from countflow.llm import lexical_search
from countflow.llm.lexical_search import OP11_SQL, Best, Block, Item, op11_lexical_search, search, stretches

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """Every document against every item: sorted (item, rank, key, score)."""
    counted = [(key, Counter(terms(t))) for key, t in docs if terms(t)]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for key, c in counted:
            m, s = 100 - 75 + (75 * sum(c.values()) * n) // total, 0
            for t in terms(text):
                if t in c:
                    s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                scores.append((-s, key is None, key, s))
        out += [(item, r + 1, key, s) for r, (_, _, key, s) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k])]
    return sorted(out, key=str)


def rows_of(df, item="item_id", key="doc_id"):
    return sorted(((r[item], r["rank"], r[key], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("text", ["", "a-B_c  D3é x\x7f`y`", "É Ünï {z}[Q]@A/0:9", "\x00a\x00", "x" * 50, "漢字 kana.ok"])
def test_terms(text, monkeypatch):
    monkeypatch.setattr(lexical_search, "STRETCH", 3)
    assert [w.decode() for words in stretches(text) for w in words] == terms(text)


@pytest.mark.parametrize("places, postings", [(8192, 1 << 20), (7, 1 << 20), (100, 30), (1, 1)])
def test_against_loops(spark, monkeypatch, places, postings):
    monkeypatch.setattr(lexical_search, "PLACES", places)
    monkeypatch.setattr(lexical_search, "POSTINGS", postings)
    rng = np.random.default_rng(places)
    words = [f"w{i}" for i in range(40)]
    p = np.array([1 / (i + 1) for i in range(40)])
    docs = [(int(i), " ".join(rng.choice(words, int(rng.integers(1, 60)), p=p / p.sum()))) for i in rng.permutation(250)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)] + [docs[5], docs[5]]  # copies, repeated rows
    items = [(i, " ".join(rng.choice(words, int(rng.integers(1, 12))))) for i in range(25)]
    found = search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), "doc_id", "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
    assert rows_of(found) == brute(docs, items)


def test_groups_of_items_give_the_same(spark, monkeypatch, docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(12)
    once = rows_of(search(docs, "doc_id", "text", items, "item_id", "text", k=3))
    monkeypatch.setattr(lexical_search, "ITEMS", 4)
    assert rows_of(search(docs, "doc_id", "text", items, "item_id", "text", k=3)) == once


def test_odd_rows(spark, odd, clashing, none):
    items = [(1, "cat mat"), (1, "cat mat"), (2, None), (3, ""), (4, "nowhere else"), (5, "a b c word"), (None, "no id")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect()], [x for x in items])
    assert rows_of(search(odd, "doc_id", "text", asked, "item_id", "text")) == want
    assert rows_of(search(clashing.withColumn("rank", clashing["score"]).withColumn("item_id", clashing["score"]), "doc_id", "text", asked, "item_id", "text")) == want
    assert search(none, "doc_id", "text", asked, "item_id", "text").count() == 0
    assert search(odd, "doc_id", "text", asked.limit(0), "item_id", "text").count() == 0


def test_all_documents_alike(spark):
    docs = [(i, "same words here") for i in range(500, 0, -1)]
    found = search(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", spark.createDataFrame([(7, "same same")], "item_id long, text string"), "item_id", "text")
    assert rows_of(found) == brute(docs, [(7, "same same")])


def test_very_long_texts():
    begin = time.monotonic()
    n = sum(len(words) for words in stretches("lorem ipsum, dolor\n" * 1_100_000))  # 20 MB
    assert n == 3_300_000 and time.monotonic() - begin < 20


def test_most_documents_are_never_scored(monkeypatch):
    """Rare terms decide, so few intervals are split."""
    rng = np.random.default_rng(2)
    docs = {}
    for i in range(4000):
        numbers = np.unique(np.concatenate([np.arange(3), rng.integers(3, 2000, 8)])).astype("<u4")
        docs[int(rng.integers(50, 60)), numbers.tobytes(), np.ones(len(numbers), "<u4").tobytes()] = [i]
    block = Block(docs, np.array([100] * 3 + [6000] * 1997, np.int64), 4000, 4000 * 55)
    scored, best = [], Best(10)
    monkeypatch.setattr(best, "add", lambda s, keys, add=best.add: (scored.append(s), add(s, keys)))
    block.search(Item("x", np.array([0, 1, 2, 50, 60, 70]), np.ones(6, np.int64)), best)
    assert len(best.rows) == 10 and len(scored) < 400


def test_op11_against_sql(spark, sf):
    for t in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = duckdb.sql(OP11_SQL)
    assert sorted(map(tuple, op11_lexical_search(spark, sf).select(*want.columns).collect())) == sorted(want.fetchall())
