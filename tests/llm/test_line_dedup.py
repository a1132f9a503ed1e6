import re
import time
from collections import defaultdict

import xxhash

from countflow.llm import line_dedup
from countflow.llm.exact_dedup import drop_exact_copies
from countflow.llm.near_copies import drop_similar
from countflow.llm.simhash import drop_near_copies
from countflow.llm.line_dedup import LEAST_WORDS, LONG_LINE, drop_repeated_chunks, op3_line_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MASK = (1 << 64) - 1


def h_text(s):
    return xxhash.xxh64_intdigest(s.encode(), seed=42)


def h_longs(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v & MASK).to_bytes(8, "little"), seed=seed)
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_spans(text):
    """(begin, lines) of the content-defined chunks and of the least windows of 50 words from and up to each line."""
    lines = text.split("\n")
    h, w = [h_text(x) for x in lines], [len(WORD.findall(x)) for x in lines]
    roll = [signed(h_longs(h[i - 1] if i else 0, h[i])) for i in range(len(h))]
    begin, out = 0, set()
    for i in range(len(lines)):
        last = i == len(lines) - 1
        if last or (i and roll[i - 1] > roll[i] < roll[i + 1]) or w[i] >= LONG_LINE or w[i + 1] >= LONG_LINE:
            words, n = sum(w[begin : i + 1]), i + 1 - begin
            if words >= LONG_LINE or (n >= 2 and words >= LEAST_WORDS):
                out.add((begin, n))
            begin = i + 1
    for i in range(len(lines)):
        for step in (1, -1):
            j, words = i, w[i]
            while words and words < LONG_LINE and 0 <= j + step < len(lines):
                j += step
                words += w[j]
            if w[i] and words >= LONG_LINE:
                out.add((min(i, j), abs(i - j) + 1))
    return out


def brute(rows):
    documents = sorted({(r["doc_id"], r["text"]) for r in rows if r["text"] is not None}, key=lambda k: (k[0] is not None, k[0] or 0, signed(h_text(k[1]))))
    places = defaultdict(list)
    for k, (_, t) in enumerate(documents):
        lines = t.split("\n")
        for begin, n in brute_spans(t):
            places["\n".join(lines[begin : begin + n])].append((k, begin, n))
    gone = defaultdict(set)
    for own in places.values():
        first, begin, n = min(own)
        for k, b, _ in own:
            gone[documents[k]].update(range(max(b, begin + n) if k == first else b, b + n))
    out = []
    for r in rows:
        if r["text"] is None:
            out.append((r["doc_id"], None, 0))
        else:
            drop = gone[(r["doc_id"], r["text"])]
            out.append((r["doc_id"], "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in drop), len(drop)))
    return sorted(out, key=str)


def test_query_matches_brute_force(spark, sf, docs):
    got = sorted((tuple(r) for r in op3_line_dedup(spark, sf).collect()), key=str)
    want = brute(docs.collect())
    assert got == want and sum(x[2] for x in want) > 0


def test_passages_go_wherever_they_stand(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    several = "\n".join(f"line {i} of a passage in ten short lines" for i in range(10))
    rows = [(i, "\n".join([f"own {i} text {j}" for j in range(i % 5)] + [passage] + [f"more {i} {j}" for j in range(i % 3)] + [several, f"tail {i}"])) for i in range(40)]
    out = {r["doc_id"]: r for r in drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"), removed_lines="gone").collect()}
    assert passage in out[0]["text"] and several in out[0]["text"]
    for i in range(1, 40):
        assert passage not in out[i]["text"] and several not in out[i]["text"] and out[i]["gone"] >= 4
        assert f"tail {i}" in out[i]["text"] and all(f"own {i} text {j}" in out[i]["text"] for j in range(i % 5))


def test_short_lines_stay(spark):
    rows = spark.createDataFrame([(i, f"All rights reserved.\nA text of its own, number {i}.") for i in range(20)], "doc_id long, text string")
    assert sorted(map(tuple, drop_repeated_chunks(rows).collect())) == sorted(map(tuple, rows.collect()))


def test_odd_rows(clashing, none):
    out = drop_repeated_chunks(clashing, removed_lines="removed")
    assert out.columns == [*clashing.columns, "removed"]
    assert sorted(((r["doc_id"], r["text"], r["removed"]) for r in out.collect()), key=str) == brute(clashing.collect())
    assert drop_repeated_chunks(none).count() == 0


def test_equal_hashes_of_other_bytes(spark, monkeypatch):
    """All passages share one hash: each body's repeats go, and nothing else."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(line_dedup.F, "xxhash64", lambda *c: F.hash(*c).cast("bigint") if isinstance(c[0], str) else F.lit(7).cast("bigint"))
    long = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(1, long), (2, long), (3, long + " other"), (4, long + " more"), (5, long + " more")], "doc_id long, text string")
    assert {r["doc_id"] for r in line_dedup.repeated_chunks(rows).collect()} == {2, 5}


def test_two_short_lines_go_where_they_are_a_chunk(spark):
    """A repeated chunk of lines goes however few words it has; one line alone stays."""
    own = "\n".join(" ".join(f"{c}{i}" for i in range(60)) for c in "xy").split("\n")
    rows = [(1, f"{own[0]}\nNotice one.\nNotice two."), (2, f"{own[1]}\nNotice one.\nNotice two."), (3, "Notice one.")]
    out = {r["doc_id"]: r["text"] for r in drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == rows[0][1] and out[3] == "Notice one."
    assert out[2] in (own[1], rows[1][1]) and (out[2] == own[1]) == all((1, 2) in brute_spans(r[1]) for r in rows[:2])


def test_columns_named_like_the_operators_own(spark):
    names = ["_mark", "_cell", "_cell0", "_block", "_block0", "_bitmap0", "_maybe", "_in", "_id", "_gone_id", "_removed", "_left", "mark", "id", "c0", "hash", "body", "first"]
    long = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(1, long, *["x"] * len(names)), (2, long, *["y"] * len(names))], ", ".join(["doc_id long", "text string", *(f"`{n}` string" for n in names)]))
    for out in (drop_repeated_chunks(rows, removed_lines="removed"), drop_exact_copies(rows), drop_near_copies(rows), drop_similar(rows)):
        assert out.columns[: len(rows.columns)] == rows.columns
        got = sorted(map(tuple, out.collect()))
        assert all(r[2 : 2 + len(names)] == ("xy"[r[0] - 1],) * len(names) for r in got)
        assert {r[0] for r in got if r[1]} in ({1}, {2})


def every_repeat(texts):
    """Plain search: the lines of each text that lie in a run of 50 words or more which stands in an earlier text too."""
    out = []
    for i, text in enumerate(texts):
        lines, gone = text.split("\n"), set()
        for begin in range(len(lines)):
            for end in range(begin + 1, len(lines) + 1):
                run = lines[begin:end]
                if sum(len(WORD.findall(x)) for x in run) >= LONG_LINE and any(f"\n{chr(10).join(run)}\n" in f"\n{t}\n" for t in texts[:i]):
                    gone.update(range(begin, end))
        out.append("\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_short_passages_go_whole(spark):
    """Passages of 2 to 6 short lines, and of one-word and blank lines, between lines of their texts' own."""
    passages = ["\n".join(" ".join(f"p{n}l{k}w{i}" for i in range(-(-60 // n) - (k == 1))) for k in range(n)) for n in range(2, 7)]
    passages += ["\n".join(f"one{i}" for i in range(55)), "\n\n".join(f"a blank line follows line {i}" for i in range(10))]
    texts = ["\n".join([f"own {i} line {k}" for k in range(i % 4 + 1)] + [x for j, p in enumerate(passages) for x in (p, f"between {i} and {j}")]) for i in range(12)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["text"] for r in drop_repeated_chunks(rows, removed_lines="gone").collect()}
    assert [got[i] for i in range(12)] == every_repeat(texts)
    assert got[0] == texts[0] and all("w1" not in got[i] and "one1" not in got[i] for i in range(1, 12))


def test_a_passage_that_overlaps_itself_keeps_its_first_lines(spark):
    rows = spark.createDataFrame([(1, "\n".join(["ten words of a line that comes again and again"] * 30))], "doc_id long, text string")
    left = drop_repeated_chunks(rows, removed_lines="gone").first()
    assert 5 <= len(left["text"].split("\n")) < 30 and left["gone"] == 30 - len(left["text"].split("\n"))


def test_a_text_of_very_many_lines(spark):
    """50,000 lines (1.4 MB), in time that grows with their number."""
    lines = [f"line {i} of {i * 7919 % 10007} with some words that differ" for i in range(50_000)]
    passage = [f"a passage {k} of many words that stands in both of the two texts and so is taken out of one" for k in range(6)]
    rows = [(1, "\n".join(lines[:25_000] + passage + lines[25_000:])), (2, "\n".join(["other start", *passage, "other end"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    begin = time.monotonic()
    found = {r["doc_id"]: r["removed_lines"] for r in drop_repeated_chunks(df, removed_lines="removed_lines").collect()}
    assert found == {1: 0, 2: 6} and time.monotonic() - begin < 120
