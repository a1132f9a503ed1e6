import math
import zlib

import numpy as np

from countflow.llm import toxicity
from countflow.llm.text import id_remainder
from countflow.llm.toxicity import different_words, fit, op4_toxicity, score, stressed, stretches, toxic_marks, train, windows


def test_windows_cover_the_whole_text():
    for t in ("", " ", "a", "x" * 1000, "ab " * 300, "é" * 500 + " b"):
        assert b"".join(windows(t)) == ((b" " + b" ".join(t.lower().encode().split())) if t.split() else b"")


def auc(s, y):
    rank = np.argsort(np.argsort(s, kind="stable"))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


def test_held_out_accuracy(spark):
    """All held-out labelled rows, and those of each language."""
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op4_toxicity(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    for only in (None, "en", "de", "es", "fr"):
        held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels and only in (None, lang[r["doc_id"]])]
        s, y = np.array([h[0] for h in held]), np.array([h[1] for h in held])
        assert y.sum() >= 10
        assert auc(s, y) > 0.94, only
        assert (s[y == 1] >= 0.3).mean() > 0.8, only
        assert (s[y == 0] >= 0.3).mean() < (0.03 if only is None else 0.1), only


def brute_score(model, text):
    """The windows, lengths and curve of one text, written out plainly."""
    words, lines, line = text.lower().encode().split(), [], b""
    pieces = [b" " + w for w in words]
    for p in pieces:
        while len(line) + len(p) > toxicity.WINDOW:
            if line:
                lines.append(line)
                line = b""
            else:
                lines.append(p[: toxicity.WINDOW])
                p = p[toxicity.WINDOW :]
        line += p
    if line:
        lines.append(line)
    gains = []
    for w in lines:
        long = b" ".join(bytes([x[0]]) * 3 + x[1:] if x and k else x for k, x in enumerate(w.split(b" ")))
        a = toxicity.compressor(b"\0" * len(model["toxic"]) + model["ordinary"]).compress(long)
        b = toxicity.compressor(model["toxic"] + model["ordinary"]).compress(long)
        gains.append(len(a) - len(b))
    x = np.zeros(7)
    if gains:
        n, top = len(gains), sorted(gains)[-3:]
        x = np.array([sum(gains) / n, max(gains), sum(top) / len(top), *(sum(g >= k for g in gains) / n for k in (2, 4, 6)), math.log(1 + sum(g >= 4 for g in gains))])
    z = (x - model["mean"]) / model["dev"]
    return 1 / (1 + math.exp(-sum(z[k] * model["beta"][k] for k in range(7)) - model["beta"][7]))


def test_query_matches_brute_force(spark, sf, docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = train(docs, labels, where=id_remainder("doc_id", 4) != 2)
    some = docs.collect()[:60]
    got = {r["doc_id"]: r["score"] for r in op4_toxicity(spark, sf).collect()}
    assert len(got) == docs.count()
    for r in some:
        assert abs(got[r["doc_id"]] - brute_score(model, r["text"] or "")) < 1e-9
    assert len({round(got[r["doc_id"]], 6) for r in some}) > 5


def test_marks_are_contrasts_of_document_words():
    toxic = [different_words(f"plain words and horrid{k} things") for k in range(8)]
    ordinary = [different_words("plain words and other things " + " ".join(f"own{k}x{i}" for i in range(9))) for k in range(8)]
    marks = toxic_marks(toxic, ordinary)
    assert b" horri" in marks and not any(m in b" plain words and things" for m in marks)
    assert set(stretches([b" horrid5", b" plain"], marks)) == {b" horrid"}
    assert stressed(b" ab c") == b" aaab ccc"


def test_held_out_labels_are_not_learned(spark, sf):
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(id_remainder("doc_id", 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    where = id_remainder("doc_id", 4) != 2
    a, b = train(docs, labels, where=where), train(docs, flipped, where=where)
    assert a["toxic"] == b["toxic"] and np.array_equal(a["beta"], b["beta"])


def test_odd_rows(spark, sf, clashing, none):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = train(docs, labels)
    out = score(clashing, model).collect()
    assert len(out) == clashing.count() and all(0 <= r["score"] <= 1 and r["ids"] == "clash" for r in out)
    assert score(none, model).count() == 0
    assert train(docs, labels.limit(0)) is None
    assert {r["score"] for r in score(clashing, None).collect()} == {0.0}
    assert fit([(1, "a", 0)], 0.5) == {"constant": 0.0}
    assert set(toxicity.fit([(1, "some awful words", 1), (2, "plain words", 0)], 0.5)) == {"toxic", "ordinary", "mean", "dev", "beta"}
