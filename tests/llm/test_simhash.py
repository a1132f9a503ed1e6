from itertools import combinations

import numpy as np
import pytest
import xxhash

from countflow.llm.simhash import allocate, choose_groups, drop_near_copies, links, near_groups, op2_simhash


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    ids = {}
    for i, f in fps:
        ids.setdefault(f, []).append(i)
    root = {f: f for f in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(ids, 2):
        if (a ^ b).bit_count() <= 3:
            root[find(a)] = find(b)
    least = {}
    for f, own in ids.items():
        known = [i for i in own if i is not None]
        least[find(f)] = min([*known, *([least[find(f)]] if least.get(find(f)) is not None else [])], default=None)
    return {(i, f): least[find(f)] for i, f in fps}


def test_query_matches_brute_force(spark, sf, docs):
    fps = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    want = brute_components(fps)
    got = op2_simhash(spark, sf).collect()
    assert len(got) == len(fps)
    assert {(r["doc_id"], int(r["fingerprint"], 16)): r["component_id"] for r in got} == want


@pytest.mark.parametrize("groups", [None, 2, 3, 4])
def test_links_are_complete(spark, groups):
    """Clusters around common centres, so that values repeat and thresholds differ."""
    rng = np.random.default_rng(7)
    fps = set(rng.integers(0, 1 << 63, 150, dtype=np.uint64).tolist())
    for centre in list(fps)[:12]:
        for _ in range(40):
            x = centre
            for bit in rng.choice(64, rng.integers(0, 5), replace=False).tolist():
                x ^= 1 << bit
            fps.add(x)
    for low in range(400):  # one 16-bit value in common
        fps.add((low * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFF0000) | 0x1234)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    want = {(a, b) for a, b in combinations(sorted(signed), 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    got = [tuple(r) for r in links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3), groups=groups).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000


def test_groups_follow_the_number_of_fingerprints():
    assert [choose_groups(n)[0] for n in (1, 100, 10**5, 10**6, 10**7, 10**9)] == [4, 4, 4, 4, 3, 2]
    # a fingerprint's probes and the values that they meet stay few, so the whole grows with the number and not with its square
    assert all(choose_groups(n)[1] < 300 for n in (10**k for k in range(10)))


def test_probes_of_random_fingerprints_meet_few(spark, monkeypatch):
    """With far fewer counters than values, and with the least number of groups, links are the same as with exact counts."""
    rng = np.random.default_rng(11)
    fps = rng.integers(-(1 << 63), 1 << 63, 3000, dtype=np.int64).tolist()
    fps += [x ^ (1 << int(rng.integers(0, 63))) ^ (1 << int(rng.integers(0, 63))) for x in fps[:300]]
    frame = spark.createDataFrame([(x,) for x in set(fps)], "fp long").repartition(3)
    one = {tuple(r) for r in links(frame, groups=4).collect()}
    assert one == {tuple(r) for r in links(frame, groups=2).collect()} and len(one) >= 290


def test_thresholds_are_the_cheapest():
    rng = np.random.default_rng(3)
    costs = np.concatenate([np.zeros((50, 4, 1)), np.cumsum(rng.integers(1, 100, (50, 4, 4)), axis=2)], axis=2).astype(float)
    got = allocate(costs, 0)
    every = [t for t in np.ndindex(5, 5, 5, 5) if sum(t) - 4 == 0]
    for c, t in zip(costs, got):
        assert t.sum() == 0
        assert sum(c[i, t[i] + 1] for i in range(4)) == min(sum(c[i, e[i]] for i in range(4)) for e in every)


def test_odd_rows(odd, clashing, none):
    rows = clashing.collect()
    fps = [(r["doc_id"], brute_fingerprint(r["text"])) for r in rows]
    want = brute_components(fps)
    got = near_groups(clashing).collect()
    assert len(got) == len(rows)
    assert all(r["component_id"] == want[(r["doc_id"], r["fp"] % (1 << 64))] for r in got)
    assert near_groups(none).count() == 0
    kept = drop_near_copies(clashing)
    assert kept.columns == clashing.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["component_id"] for r in got}


def test_a_row_goes_for_its_own_text(spark):
    """Ids that repeat: the row (1, a) has no copy and stays; near copies under one id leave one."""
    a, b = " ".join(f"a{i}" for i in range(400)), " ".join(f"b{i}" for i in range(400))
    near = b + " one"
    assert (brute_fingerprint(b) ^ brute_fingerprint(near)).bit_count() <= 3
    frame = spark.createDataFrame([(0, b), (1, a), (1, b), (3, a.upper())], "doc_id long, text string")
    assert sorted(map(tuple, drop_near_copies(frame).collect())) == [(0, b), (1, a)]
    assert drop_near_copies(spark.createDataFrame([(5, b), (5, near)], "doc_id long, text string")).count() == 1
