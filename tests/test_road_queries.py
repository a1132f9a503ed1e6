import heapq
from collections import defaultdict

import __spark_entry__ as entry

from countflow.plans.views import edges, table

SF = "/root/testdata/sf0.001"


def brute(spark, limit):
    near = defaultdict(list)
    for r in edges(spark, SF).collect():
        near[r["a"]].append((r["b"], r["km"]))
        near[r["b"]].append((r["a"], r["km"]))
    out = {}
    for (k,) in table(spark, SF, "part").select("p_partkey").collect():
        heap, best = [(0.0, k)], {}
        while heap:
            km, node = heapq.heappop(heap)
            if node not in best:
                best[node] = km
                for other, step in near[node]:
                    if km + step <= limit + 1e-9:
                        heapq.heappush(heap, (km + step, other))
        out.update({(k, node): km for node, km in best.items()})
    return out


def test_every_part_is_a_source_and_a_unit(spark):
    """Lengths are tenths, so a distance at the limit itself may fall to either side."""
    want = brute(spark, 1.0)
    got = {(r["source"], r["node"]): r["km"] for r in entry.queries()["g7_bounded_shortest_paths"](spark, SF).collect()}
    assert all(abs(got[k] - want[k]) < 1e-6 for k in got) and all(k in got for k, km in want.items() if km < 0.99)
    parts = table(spark, SF, "part").count()
    pairs = entry.queries()["g8_pair_distance"](spark, SF).collect()
    far = {(min(k), max(k)): km + k[0] % 3 / 10 + k[1] % 3 / 10 for k, km in brute(spark, 3.0).items() if k[0] != k[1] and 0 < k[1] <= parts}
    got = {(r["a"], r["b"]): r["km"] for r in pairs}
    assert all(abs(got[k] - far[k]) < 1e-6 for k in got) and all(k in got for k, km in far.items() if km < 2.99)


def test_a_round_writes_the_frontier_only(spark, monkeypatch):
    """On a path from one source every round has a handful of open distances, however many are settled."""
    from countflow.operators import matching

    written, checkpoint = [], matching.checkpoint

    def watched(df):
        out = checkpoint(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(matching, "checkpoint", watched)
    path = spark.createDataFrame([(i, i + 1, 1.0) for i in range(30)], "a long, b long, km double")
    got = matching.bounded_shortest_paths(path, spark.createDataFrame([(0,)], "source long"), 25.0, bucket=2.0).collect()
    assert {r["node"]: r["km"] for r in got} == {i: float(i) for i in range(26)}
    assert max(written[1:]) <= 4 and sum(written[1:]) <= 4 * 26


def test_detours_that_turn_out_shorter(spark):
    """Many short edges beat a long one that was followed first; edges of no length; other widths give the same."""
    from countflow.operators import matching

    rows = [(0, 9, 8.0), *[(i, i + 1, 0.5) for i in range(9)], (9, 10, 0.0), (10, 11, 0.25), (20, 21, 1.0)]
    edges = spark.createDataFrame(rows, "a long, b long, km double")
    sources = spark.createDataFrame([(0,), (20,), (99,)], "source long")
    for bucket in (None, 0.3, 100.0):
        got = {(r["source"], r["node"]): r["km"] for r in matching.bounded_shortest_paths(edges, sources, 4.6, bucket=bucket).collect()}
        assert got == {**{(0, i): i / 2 for i in range(10)}, (0, 10): 4.5, (20, 20): 0.0, (20, 21): 1.0, (99, 99): 0.0}
    assert matching.bounded_shortest_paths(edges, sources.limit(0), 4.6).count() == 0
