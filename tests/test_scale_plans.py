"""Properties of plans and operators that the small tables can't show by their results alone."""

import math
import random

from pyspark.sql import functions as F

from countflow import catalog
from countflow.operators import joins, ordering
from countflow.operators import statistics as stt

SF = "/root/testdata/sf0.001"


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_one_scan_each(spark):
    assert scans(catalog.QUERIES["m5_daily_features"](spark, SF)) == 1
    assert scans(catalog.QUERIES["a5_partition_quality"](spark, SF)) == 1
    assert scans(catalog.QUERIES["q20_quality_report"](spark, SF)) == 1


def test_no_window_over_all_keys(spark):
    for name in ("m3_permutation", "q17_match_audit"):
        plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "row_number()" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_rows_are_numbered_in_order(spark):
    rows = spark.range(1000).select(F.xxhash64("id").alias("h"), "id")
    got = [(r["h"], r["n"]) for r in ordering.number_rows(rows, ["h"], "n").collect()]
    assert sorted(got) == [(h, i + 1) for i, h in enumerate(sorted(h for h, _ in got))]
    assert ordering.number_rows(rows.limit(0), ["h"], "n").count() == 0


def test_permutations_are_one_to_one_and_differ(spark):
    rows = spark.range(300).select(F.col("id").alias("k"))
    one, again, other = ({r["k"]: r["partner"] for r in stt.permutation(rows, "k", seed).collect()} for seed in (1, 1, 2))
    assert one == again != other and set(one) == set(one.values()) == set(range(300))
    assert sum(k == v for k, v in one.items()) < 15


def test_null_distribution(spark):
    rows = spark.createDataFrame([(k, float(k), float(k)) for k in range(50)], "k long, a double, b double")
    got = {r["draw"]: r["share"] for r in stt.null_distribution(rows, "k", "a", "b", 0.5, 3).collect()}
    assert got[0] == 0 and all(got[d] > 0.8 for d in (1, 2, 3))


def test_spearman_by_hand(spark):
    rng = random.Random(3)
    rows = [(g, rng.randrange(9), rng.random() if g else rng.randrange(3)) for g in (0, 1) for _ in range(60)] + [(2, 1, 1.0), (2, 1, 2.0), (None, 1, 1.0), (None, 2, 2.0)]

    def ranks(x):
        return [sum(y < v for y in x) + (sum(y == v for y in x) + 1) / 2 for v in x]

    got = {r["g"]: r["rho"] for r in stt.spearman(spark.createDataFrame([(g, float(x), float(y)) for g, x, y in rows], "g int, x double, y double"), "x", "y", ["g"]).collect()}
    for g in (0, 1):
        x, y = ranks([r[1] for r in rows if r[0] == g]), ranks([r[2] for r in rows if r[0] == g])
        m = (len(x) + 1) / 2
        want = sum((a - m) * (b - m) for a, b in zip(x, y)) / math.sqrt(sum((a - m) ** 2 for a in x) * sum((b - m) ** 2 for b in y))
        assert abs(got[g] - want) < 1e-9
    assert got[2] is None and abs(got[None] - 1) < 1e-9


def greedy_swaps(rows):
    """The pairs in order, each if neither of its ends is taken."""
    done, out = set(), []
    for a, ta, oa in rows:
        for b, tb, ob in rows:
            if a < b and len(ta) >= 2 and len(tb) >= 2 and ta not in oa and tb not in ob and ta in ob and tb in oa and not done & {a, b}:
                done |= {a, b}
                out.append((a, b))
    return out


def test_swaps_are_taken_first_come(spark):
    rng, towns = random.Random(4), ["ab", "bc", "cab", "dd", "x"]
    rows = [(k, rng.choice(towns), "".join(rng.choice("abcdx") for _ in range(9))) for k in range(70)] + [(101, "pp", "qq"), (102, "pp", "qq"), (103, "qq", "pp"), (104, "qq", "pp")]
    got = sorted(map(tuple, joins.swap_candidates(spark.createDataFrame(rows, "k long, t string, o string"), "k", "t", "o").collect()))
    assert got == sorted(greedy_swaps(rows)) and (101, 103) in got and (102, 104) in got and len(got) > 4
