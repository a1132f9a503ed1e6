import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from countflow.llm import quality
from countflow.llm.quality import counts, features, fit, judge, op6_quality, probability, train, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é★", "#x|", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "c d e "]), max_size=60).map("".join))
def test_counts_match_brute_force(text):
    assert counts(text) == brute(text)


def test_word_hashes_tell_words_apart():
    b = np.frombuffer("a b ab ba a é x" .encode(), np.uint8)
    h = word_hashes(b)
    assert len(h) == 7 and h[0] == h[4] and len(set(h.tolist())) == 6
    assert not len(word_hashes(np.frombuffer(b"  ", np.uint8)))
    assert all(len(p) == 0 or p.max() < 1 << 17 for p in features("a"))


def test_query(spark, sf, docs):
    rows = {r["doc_id"]: r for r in op6_quality(spark, sf).collect()}
    for d in docs.collect():
        r = rows.pop(d["doc_id"])
        want = brute(d["text"])
        assert tuple(r[1:6]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    assert not rows


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = train(docs.filter("doc_id % 2 = 0"), labels)
    rows = judge(docs.filter("doc_id % 2 = 1").join(labels, "doc_id"), model).select("quality", "kept", "base_failed", "quality_score").collect()
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r for r in rows if r["quality"] == 0]
    assert np.mean([r["kept"] for r in good]) > 0.98 and np.mean([r["kept"] for r in bad]) < 0.05


def test_odd_rows(clashing, none):
    out = judge(clashing, None).collect()
    assert len(out) == clashing.count() and all(r["size"] == "clash" for r in out)
    for r in out:
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute(r["text"])
    assert judge(none, None).count() == 0
    assert probability(fit([(1, "a b", 1)]), ["x", None]).tolist() == [1.0, 1.0]
    assert len(probability(fit([(1, "a b", 1), (2, "", 0)]), ["x", None])) == 2


def test_blocks_give_the_same_n_grams(monkeypatch):
    text = "Some words, ünïcode ★ and\tmore  words " * 40 + "x" * 500 + " end"
    raw = np.frombuffer(text.encode(), np.uint8)
    whole, hashes = quality.features(text), quality.word_hashes(raw)
    for size in (7, 64, 333):
        monkeypatch.setattr(quality, "BLOCK", size)
        assert np.array_equal(quality.word_hashes(raw), hashes)
        assert all(np.array_equal(np.sort(a), np.sort(b)) for a, b in zip(quality.features(text), whole))
    assert len(hashes) == len(text.encode().split()) and all(len(p) == 0 for p in quality.features(""))
