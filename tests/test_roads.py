import itertools
import math

import pytest

from countflow.operators import matching, roads
from countflow.operators.components import connected_components

# key, group, start (kind, code, name), end (kind, code, name), unit, town, km
SECTIONS = [
    ("0010", "A", ("9", None, ""), ("4", "n1", ""), "0020", "t1", 2.0),
    ("0020", "A", ("4", "n1", ""), ("6", None, "x・y境"), "0020", "t1", 3.0),  # next: equal codes
    ("0030", "A", ("6", None, "y・x境"), ("8", None, ""), "0020", "t2", 4.0),  # next: the same towns
    ("0040", "A", ("8", None, ""), ("5", None, ""), "0040", "t2", 1.0),  # refused: kind 8
    ("0050", "A", ("5", None, ""), ("7", None, ""), None, "t2", 6.0),  # next: kind 5 without a name
    ("0060", "A", ("7", None, ""), ("4", "n2", ""), None, "t2", 6.5),  # refused: kind 7 without a name
    ("0070", "A", ("4", "n3", ""), ("3", "0110", ""), "0070", "t3", 2.5),  # refused: other code
    ("0110", "B", ("3", "0070", ""), ("7", None, "z"), "0110", "t3", 2.0),  # border: named back once
    ("0120", "B", ("7", None, "z"), ("3", "0130", ""), "0110", "t3", 1.5),
    ("0130", "B", ("3", "0120", ""), ("3", "0120", ""), "0130", "t4", 1.0),  # refused: named back twice
    ("0140", "B", ("1", "0050", ""), ("2", "0070", ""), "0130", "t4", 5.0),  # junctions: end of 0050, start of 0070
    ("0150", "B", ("1", "9999", ""), ("3", "0010", ""), "0130", "t4", 7.0),  # refused: no such section, not named back
]


@pytest.fixture(scope="module")
def sections(spark):
    rows = [(k, g, *((int(a) if i == 0 else a) for i, a in enumerate(s)), *((int(a) if i == 0 else a) for i, a in enumerate(e)), u, t, km) for k, g, s, e, u, t, km in SECTIONS]
    names = "key string, g string, start_kind int, start_code string, start_name string, end_kind int, end_code string, end_name string, unit string, town string, km double"
    return spark.createDataFrame(rows, names)


def same(x):
    kind, code, name = x
    return (kind, code) if kind in "1234" else (kind, frozenset(name.replace("境", "").split("・"))) if kind == "6" else (kind, name)


def loops():
    """The rules, section by section."""
    by_key = {s[0]: s for s in SECTIONS}
    out = set()
    for x, y in itertools.pairwise(SECTIONS):
        if x[1] == y[1] and same(x[3]) == same(y[2]) and x[3][0] != "8" and (same(x[3])[1] or x[3][0] in "59"):
            out.add((f"{x[0]}:e", f"{y[0]}:s", "next"))
    for s in SECTIONS:
        for side, (kind, code, _) in (("s", s[2]), ("e", s[3])):
            if kind in "12" and code in by_key:
                out.add((f"{s[0]}:{side}", f"{code}:{'e' if kind == '1' else 's'}", "junction"))
            if kind == "3" and code in by_key:
                back = [f"{code}:{z}" for z, end in (("s", by_key[code][2]), ("e", by_key[code][3])) if end[0] == "3" and end[1] == s[0]]
                if len(back) == 1:
                    out.add((f"{s[0]}:{side}", back[0], "border"))
    return out


def test_each_rule_and_each_refusal(sections):
    got = {tuple(r) for r in roads.same_place_edges(sections, "key", "g").collect()}
    assert got == loops()
    assert {r for *_, r in got} == {"next", "junction", "border"}
    assert got == {
        ("0010:e", "0020:s", "next"), ("0020:e", "0030:s", "next"), ("0040:e", "0050:s", "next"), ("0110:e", "0120:s", "next"),
        ("0070:e", "0110:s", "border"), ("0110:s", "0070:e", "border"), ("0130:s", "0120:e", "border"), ("0130:e", "0120:e", "border"),
        ("0140:s", "0050:e", "junction"), ("0140:e", "0070:s", "junction"),
    }


def test_empty_sections(sections):
    assert roads.same_place_edges(sections.limit(0), "key", "g").count() == 0


MATCHES = [(1, "0020", "t1"), (2, "0020", "t2"), (3, "0020", "t9"), (4, "0050", "t2"), (5, "0110", "t3"), (6, "0130", "t4")]


def test_the_whole_chain_of_the_road_graph(spark, sections):
    """Merged places, contracted edges, placement, distances and direct pairs, against plain loops over the same rows."""
    edges = roads.same_place_edges(sections, "key", "g")
    labels = connected_components(edges)
    placed = roads.with_places(sections, labels, "key")

    parent = {f"{s[0]}:{x}": f"{s[0]}:{x}" for s in SECTIONS for x in "se"}

    def root(p):
        return p if parent[p] == p else root(parent[p])

    for a, b, _ in loops():
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert {(r["key"], r["start_place"], r["end_place"]) for r in placed.collect()} == {(s[0], root(f"{s[0]}:s"), root(f"{s[0]}:e")) for s in SECTIONS}

    contracted = matching.contract_edges(sections.select(roads.point("key", "s").alias("a"), roads.point("key", "e").alias("b"), "km"), labels)
    want = {}
    for s in SECTIONS:
        a, b = sorted((root(f"{s[0]}:s"), root(f"{s[0]}:e")))
        if a != b:
            want[a, b] = min(want.get((a, b), math.inf), s[6])
    assert {(r["a"], r["b"]): r["km"] for r in contracted.collect()} == want

    matches = spark.createDataFrame(MATCHES, "counter long, key string, town string")
    stretch = roads.stretches(matches, placed, "counter", "key", "town")
    got = {r["counter"]: (r["from_section"], r["to_section"], r["placed_km"], r["in_town"]) for r in roads.place_on_chain(stretch, "counter", "key", "town").collect()}
    assert got == {1: ("0010", "0020", 5.0, True), 2: ("0030", "0030", 4.0, True), 3: ("0010", "0030", 9.0, False), 4: ("0050", "0050", 6.0, True), 5: ("0110", "0120", 3.5, True), 6: ("0130", "0130", 1.0, True)}

    points = {(r["counter"], r["node"]): r["offset"] for r in roads.chain_points(stretch, "counter").collect()}
    assert points[1, root("0010:s")] == 2.5 and points[1, root("0010:e")] == 0.5 and points[1, root("0020:e")] == 2.5
    assert points[3, root("0030:e")] == 4.5

    nodes = sorted({n for pair in want for n in pair})
    far = {(a, b): 0.0 if a == b else want.get((min(a, b), max(a, b)), math.inf) for a in nodes for b in nodes}
    for k, a, b in itertools.product(nodes, nodes, nodes):
        far[a, b] = min(far[a, b], far[a, k] + far[k, b])
    sources = spark.createDataFrame(sorted({(n,) for _, n in points}), "source string")
    paths = matching.bounded_shortest_paths(contracted, sources, 60.0)
    pairs = {(r["a"], r["b"]): r["km"] for r in matching.pair_distance(paths, roads.chain_points(stretch, "counter"), 60.0).collect()}
    best = {}
    for (i, p), (j, q) in itertools.product(points, points):
        if i < j:
            best[i, j] = min(best.get((i, j), math.inf), points[i, p] + far.get((p, q), 0.0 if p == q else math.inf) + points[j, q])
    best = {k: v for k, v in best.items() if v <= 60}
    assert pairs.keys() == best.keys() and all(math.isclose(pairs[k], best[k], abs_tol=1e-9) for k in best) and best

    distances = spark.createDataFrame([(*k, v) for k, v in best.items()], "a long, b long, km double")
    direct = {(r["a"], r["b"]): r["direct"] for r in matching.direct_pairs(distances).collect()}
    both = best | {(b, a): v for (a, b), v in best.items()}
    assert direct == {(a, b): not any(both.get((a, c), math.inf) + both.get((c, b), math.inf) <= v + 0.125 for c in range(1, 7) if c not in (a, b)) for (a, b), v in best.items()}
