import math
import zlib
from collections import Counter

import numpy as np

from countflow.llm import language_model
from countflow.llm.gru import HIDDEN, Gru
from countflow.llm.language_model import op1_lm_scoring, score, train
from countflow.llm.text import words_of


def small(seed=0):
    rng = np.random.default_rng(seed)
    g = Gru(rng.random(150) + 0.1, rng.random(5) + 0.1, seed)
    g.p = {k: v + rng.normal(0, 0.2, v.shape).astype(np.float32) for k, v in g.p.items()}
    g.p["word_b"].reshape(-1)[150:] = -30
    return g


def test_probabilities_add_up():
    g = small()
    h = np.random.default_rng(1).normal(0, 0.5, (1, HIDDEN)).astype(np.float32)
    every = np.arange(155)
    logp, _ = g.output(np.repeat(h, 155, axis=0), every)
    assert abs(np.exp(logp).sum() - 1) < 1e-5


def test_score_carries_the_state_through_whole_documents():
    g, rng = small(), np.random.default_rng(2)
    docs = [np.concatenate([rng.integers(1, 155, n), [0]]) for n in (0, 1, 700, 31, 32, 33, 5, 200, 64)]
    want = []
    for d in docs:
        h, total, prev = np.zeros((1, HIDDEN), np.float32), 0.0, 0
        for y in d:
            h = g.step(g.p["table"][[prev]], h)[0]
            total += g.output(h, np.array([y]))[0][0]
            prev = y
        want.append(total)
    assert np.allclose(g.score(docs), want, rtol=1e-4)
    assert len(g.score([])) == 0


def test_gradients():
    """Backpropagation against differences, with a document that begins inside the window."""
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 155, (6, 3)), rng.integers(0, 155, (6, 3))
    fresh = np.zeros((6, 3), bool)
    fresh[0], fresh[3, 1] = True, True
    h0 = np.zeros((3, HIDDEN), np.float32)

    def loss(g):
        h, out = h0, 0.0
        for t in range(6):
            h = np.where(fresh[t][:, None], np.float32(0), h)
            h = g.step(g.p["table"][x[t]], h)[0]
            out -= g.output(h, y[t])[0].sum()
        return out / 18

    g = small()
    g.p = {k: v.astype(np.float64) for k, v in g.p.items()}
    found = {}
    g._update = lambda name, grad, rate, rows=None: found.__setitem__(name, (grad, rows))
    g.train_window(x, y, fresh, h0, 0.1)
    for name, (grad, rows) in found.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in grad.shape)
            real = at if rows is None else (rows[at[0]], at[1])
            keep, eps = g.p[name][real], 1e-5
            g.p[name][real] = keep + eps
            up = loss(g)
            g.p[name][real] = keep - eps
            down = loss(g)
            g.p[name][real] = keep
            assert abs((up - down) / (2 * eps) - grad[at]) < 1e-4 + 0.02 * abs(grad[at]), name


def brute_base(docs):
    train_rows = [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 10 != 0]
    c = Counter()
    for r in train_rows:
        c.update([*words_of(r["text"]), None])
    n, v = sum(c.values()), len(c)
    out = {}
    for r in docs:
        tokens = [*words_of(r["text"]), None]
        out[r["doc_id"]] = (len(tokens), sum(c[t] > 0 for t in tokens), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens))
    return out


def test_query(spark, sf, docs, monkeypatch):
    monkeypatch.setattr(language_model, "KNOWN", 3000)  # so that counts also come by the join
    want = brute_base(docs.collect())
    rows = op1_lm_scoring(spark, sf).collect()
    assert len(rows) == len(want)
    for r in rows:
        n, known, train_tokens, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, train_tokens)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) and r["score"] < 0


def test_beats_the_unigram_model_on_held_out_texts(spark):
    rows = [r for r in op1_lm_scoring(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    gain = (sum(r["score"] for r in rows) - sum(r["base_score"] for r in rows)) / sum(r["n_tokens"] for r in rows)
    assert gain > 0.1, gain


def test_odd_rows(clashing, none):
    model = train(clashing)
    out = score(clashing, model).collect()
    assert len(out) == clashing.count()
    assert {r["n_tokens"] for r in out if r["doc_id"] in (3, 4, 5)} == {1}
    assert all(np.isfinite(r["score"]) and r["n_known"] == r["n_tokens"] for r in out)
    assert score(none, model).count() == 0
    blank = score(clashing, train(none)).collect()
    assert all(np.isfinite(r["score"]) and np.isfinite(r["base_score"]) and r["n_known"] == 0 for r in blank)
