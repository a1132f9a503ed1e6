import hashlib
import string
from collections import defaultdict

from pyspark.sql import functions as F

from countflow.llm import bloom
from countflow.llm.exact_dedup import drop_exact_copies, exact_groups
from countflow.session import checkpoint

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r["text"] or "").translate(LOWER)].append(r["doc_id"])
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_matches_brute_force(docs):
    assert sorted(map(tuple, exact_groups(docs).collect()), key=str) == brute(docs.collect())


def test_odd_rows(odd, clashing, none):
    assert sorted(map(tuple, exact_groups(clashing).collect()), key=str) == brute(odd.collect())
    assert exact_groups(none).count() == 0


def test_a_full_filter_stays_exact(docs, monkeypatch):
    """With far too few cells every row looks repeated; the result is the same."""
    monkeypatch.setattr(bloom, "MAX_FILTER_BITS", 1)
    monkeypatch.setattr(bloom, "BLOCK_BITS", 64)
    monkeypatch.setattr(bloom, "MAX_RANGES", 1)
    assert sorted(map(tuple, exact_groups(docs).collect()), key=str) == brute(docs.collect())


def test_ranges_give_the_same_result(docs, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_FILTER_BITS", 1 << 10)
    monkeypatch.setattr(bloom, "BLOCK_BITS", 64)
    assert bloom.ranges_for(docs.count()) > 2
    assert sorted(map(tuple, exact_groups(docs).collect()), key=str) == brute(docs.collect())


def test_a_row_goes_for_its_own_text(spark):
    rows = spark.createDataFrame([(0, "b"), (0, "a"), (1, "b"), (2, None), (3, ""), (3, "c")], "doc_id long, text string")
    assert sorted(map(tuple, drop_exact_copies(rows).collect()), key=str) == sorted([(0, "a"), (1, "b"), (3, ""), (3, "c")], key=str)


def test_only_rows_that_may_repeat_are_marked(spark):
    rows = checkpoint(spark.range(20000).select(F.xxhash64("id").alias("h")).union(spark.range(50).select(F.xxhash64("id").alias("h"))))
    marked = bloom.may_repeat(rows, "h", 20050, {"_maybe": 2}).cache()
    assert marked.groupBy("h").count().filter("count > 1").join(marked, "h").filter("NOT _maybe").count() == 0
    assert marked.filter("_maybe").count() < 3000


def test_hot_group(spark):
    rows = spark.createDataFrame([(i, "Same" if i % 2 else "sAME") for i in range(2000)] + [(i, f"t{i}") for i in range(2000, 2100)], "doc_id long, text string")
    out = exact_groups(rows).collect()
    assert len(out) == 2100 and sum(r["kept"] for r in out) == 101
    assert {(r["keep_id"], r["group_size"]) for r in out if r["doc_id"] < 2000} == {(1999, 2000)}
    assert drop_exact_copies(rows).count() == 101
