"""Statistics, features and forecasts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countflow.functions import log_ratio
from countflow.operators.aggregates import error_scores
from countflow.operators.joins import neighbour_join, pair_series_join
from countflow.operators.ordering import number_rows
from countflow.operators.quantiles import average_ranks, exact_quantiles
from countflow.operators.windows import lag_features
from countflow.session import checkpoint

#: Bins of a feature, as many as Spark's trees tell apart if nothing is set.
BINS = 32
#: Keys of a block, whose series a task holds with those of one other block as a table of keys by times.
BLOCK = 512


def pair_correlation(df: DataFrame, pairs: DataFrame, key: str, ts: str, value: str, min_n: int = 300) -> DataFrame:
    """Pearson correlation of each pair over the times both have a value, if there are ``min_n``."""
    g = pair_series_join(df, pairs, key, ts, value).groupBy("a", "b").agg(F.count("*").alias("n"), F.corr("value_a", "value_b").alias("r"))
    return g.filter(F.col("n") >= min_n)


def dense_pair_correlation(df: DataFrame, pairs: DataFrame, key: str, ts: str, value: str, min_n: int = 300, size: int | None = None) -> DataFrame:
    """As ``pair_correlation`` (a key has one row a time), where pairs are a fair share of all there are: keys are dealt into blocks of about ``size``, and a task gets two blocks' series and the pairs between them, so series
    meet by blocks and no row is made for a pair's time. Sums over common times are products of matrices, exact for whole numbers (values are taken from their key's mean, rounded)."""
    at = F.unix_date(ts) if dict(df.dtypes)[ts] == "date" else F.col(ts).cast("timestamp").cast("double")
    rows = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull() & F.col(value).isNotNull()).select(F.col(key).alias("_k"), F.struct(at.cast("double").alias("t"), F.col(value).cast("double").alias("v")).alias("_s"))
    series = checkpoint(rows.groupBy("_k").agg(F.collect_list("_s").alias("_s"), F.round(F.avg("_s.v")).alias("_mean")).select("_k", F.col("_s.t").alias("t"), F.transform("_s", lambda x: x["v"] - F.col("_mean")).alias("v")))
    blocks = max(1, -(-series.count() // (size or BLOCK)))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    with_block = series.withColumn("_own", block("_k")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = lambda x, y: (F.least(x, y).alias("_i"), F.greatest(x, y).alias("_j"))
    left = with_block.select("_k", "_own", "t", "v", *both("_own", "_other"))
    right = pairs.select("a", "b", block("a").alias("_x"), block("b").alias("_y")).select("a", "b", "_x", *both("_x", "_y"))
    kind = dict(df.dtypes)[key]
    out = left.groupBy("_i", "_j").cogroup(right.groupBy("_i", "_j")).applyInArrow(_block_correlations, f"a {kind}, b {kind}, n long, r double")
    return out.filter(F.col("n") >= min_n)


def _block_correlations(series: pa.Table, pairs: pa.Table) -> pa.Table:
    """The pairs of two blocks (or of one) with the number of their common times and their correlation, null if one of them doesn't vary there."""
    if not (series.num_rows and pairs.num_rows):
        return pa.table({"a": pairs.column("a").slice(0, 0), "b": pairs.column("b").slice(0, 0), "n": pa.array([], pa.int64()), "r": pa.array([], pa.float64())})
    place = {k: i for i, k in enumerate(series.column("_k").to_pylist())}
    times = series.column("t").combine_chunks()
    lengths = np.diff(times.offsets.to_numpy())
    _, day = np.unique(times.flatten().to_numpy(), return_inverse=True)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    known, x = np.zeros((2, len(lengths), day.max(initial=-1) + 1))
    known[owner, day], x[owner, day] = 1, series.column("v").combine_chunks().flatten().to_numpy()
    a, b = ([place.get(k, -1) for k in pairs.column(c).to_pylist()] for c in ("a", "b"))
    a, b = np.array(a), np.array(b)
    good = (a >= 0) & (b >= 0)
    # of two blocks only the products between them are made
    turned = pairs.column("_x").to_numpy() != pairs.column("_i").to_numpy()
    one, two = np.where(turned, b, a)[good], np.where(turned, a, b)[good]
    (p, one), (q, two) = (np.unique(i, return_inverse=True) for i in (one, two))
    kp, kq, xp, xq = known[p], known[q].T, x[p], x[q].T
    n, sp, sq, spp, sqq, spq = ((u @ w)[one, two] for u, w in ((kp, kq), (xp, kq), (kp, xq), (xp * xp, kq), (kp, xq * xq), (xp, xq)))
    vp, vq = n * spp - sp * sp, n * sqq - sq * sq
    vary = (vp > 0) & (vq > 0)
    r = (n * spq - sp * sq) / np.sqrt(np.where(vary, vp, 1)) / np.sqrt(np.where(vary, vq, 1))
    kept = pairs.select(["a", "b"]).filter(pa.array(good))
    return kept.append_column("n", pa.array(n.astype(np.int64))).append_column("r", pa.array(r, mask=~vary))


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Rank correlation with average ranks of ties, per group. Rows are counted by their values before the shuffle, and ranks are sums over ranges of a group's different values; sums
    of products about the ranks' mean give the correlation. ``weight``: how often a row counts, once if not given."""
    times = F.count("*") if weight is None else F.sum(weight)
    pairs = checkpoint(df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by, F.col(x).alias("_x"), F.col(y).alias("_y")).agg(times.alias("_w")))

    def ranked(rows: DataFrame, c: str) -> DataFrame:
        rank = average_ranks(rows.groupBy(*by, c).agg(F.sum("_w").alias("_n")), by, c, "_n", "_r")
        right = rank.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)], F.col(c).alias("_v"), F.col("_r").alias(f"{c}_rank"))
        same = F.col(c) == F.col("_v")
        for i, k in enumerate(by):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        return rows.join(right, same).drop("_v", *[f"_k{i}" for i in range(len(by))])

    both = ranked(ranked(pairs, "_x"), "_y")
    w, a, b = F.col("_w"), F.col("_x_rank"), F.col("_y_rank")
    g = both.groupBy(*by).agg(F.sum("_w").alias("n"), *[F.sum(e).alias(n) for n, e in (("_a", w * a), ("_ab", w * a * b), ("_aa", w * a * a), ("_bb", w * b * b))])
    mean = (F.col("n") + 1) / 2  # of either kind of rank
    square = F.col("n") * mean * mean
    return g.select(*by, "n", ((F.col("_ab") - square) / F.nullif(F.sqrt((F.col("_aa") - square) * (F.col("_bb") - square)), F.lit(0.0))).alias("rho"))


def permutation(df: DataFrame, key: str, seed: int, out: str = "partner") -> DataFrame:
    """(key, partner): the keys paired with themselves in another order, by a hash; the same for the same seed. Keys are numbered by ranges, no task has all of them."""
    keys = checkpoint(df.select(key).distinct())
    plain = number_rows(keys, [key], "_r")
    mixed = number_rows(keys.select(F.col(key).alias(out), F.xxhash64(key, F.lit(seed)).alias("_h")), ["_h", out], "_r").drop("_h")
    return plain.join(mixed, "_r").drop("_r")


def null_distribution(df: DataFrame, key: str, own: str, other: str, far: float, draws: int, seed: int = 0) -> DataFrame:
    """(draw, n, share): how many rows differ by more than ``far`` between ``own`` and their partner's ``other``; draw 0 takes the row's own ``other``, each further one a permutation of its own."""
    base = df.select(F.col(key).alias("_k"), F.col(own).alias("_a"), F.col(other).alias("_b"))
    out = None
    for draw in range(draws + 1):
        if draw:
            mixed = permutation(base, "_k", seed + draw, "_p")
            rows = base.select("_k", "_a").join(mixed, "_k").join(base.select(F.col("_k").alias("_p"), "_b"), "_p")
        else:
            rows = base
        gap = F.abs(F.col("_a") - F.col("_b"))
        one = rows.agg(F.lit(draw).alias("draw"), F.count(gap).alias("n"), F.avg((gap > far).cast("int")).alias("share"))
        out = one if out is None else out.unionByName(one)
    return out


def time_split(df: DataFrame, ts: str, days: int) -> DataFrame:
    """``df`` with ``is_test``: whether the row lies in the last ``days`` days."""
    last = df.agg(F.max(F.to_date(ts)).alias("_last"))
    return df.crossJoin(F.broadcast(last)).withColumn("is_test", F.to_date(ts) > F.date_sub("_last", days)).drop("_last")


def daily_features(df: DataFrame, keys: Sequence[str], date: str, value: str, base: str, day_off: str) -> DataFrame:
    """Log of the target, logs of the values 1, 7 and 14 days before (exactly), log ratio to the usual value a week before, yesterday's day_off, log of the usual value.
    A key has one row a day. One shuffle brings a key's days together, each row once, and they are read in order of the day."""
    kept = list(dict.fromkeys((value, base, day_off)))
    days = Window.partitionBy(*keys).orderBy(F.unix_date(date))
    ago = lambda c, k: F.max(c).over(days.rangeBetween(-k, -k))
    lags = [ago(value, k).alias(f"_v{k}") for k in (1, 7, 14)] + [ago(base, 7).alias("_b7"), ago(day_off, 1).alias("_o1")]
    g = df.select(*keys, date, *kept, *lags)
    log = lambda c: F.when(F.col(c) > 0, F.log(F.col(c).cast("double")))
    return g.select(
        *keys, date, *kept, log(value).alias("y"), log("_v1").alias("lag1"), log("_v7").alias("lag7"), log("_v14").alias("lag14"),
        log_ratio(F.col("_v7").cast("double"), F.col("_b7").cast("double")).alias("ratio7"), F.col("_o1").alias("prev_day_off"), log(base).alias("log_base"), F.weekday(date).alias("weekday"),
    )


def hourly_graph_features(df: DataFrame, edges: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """On a dense grid: own value now and one and two steps before, the neighbours' mean now and one step before, and the next value as target."""
    near = neighbour_join(df, edges, key, ts, value).select(key, ts, F.col("neighbour_mean").alias("near"))
    both = df.select(key, ts, value).join(near, [key, ts], "left")
    own = lag_features(both, [key], ts, value, (1, 2), (1,))
    return lag_features(own, [key], ts, "near", (1,), ())


def fit_forecast(train: DataFrame, features: Sequence[str], target: str, trees: int = 40, depth: int = 5, seed: int = 7):
    """A boosted-tree pipeline; missing features get their median and a mark of their own, and each feature falls into ``BINS`` bins of about as many rows.

    Trees tell rows apart by bins only, so rows that agree in all of them are one cell with their number as weight and the mean of their targets: squared errors differ by a constant, and the trees are those
    of the rows. What the rounds of boosting read grows with the different cells, not with the rows."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import Imputer, QuantileDiscretizer, SQLTransformer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    marks = ", ".join(f"CAST({f} IS NULL AS DOUBLE) AS {f}_missing" for f in features)
    doubles = ", ".join(f"CAST({f} AS DOUBLE) AS {f}_in" for f in features)
    fill = Imputer(strategy="median", inputCols=[f"{f}_in" for f in features], outputCols=[f"{f}_filled" for f in features])
    cut = QuantileDiscretizer(numBuckets=BINS, inputCols=[f"{f}_filled" for f in features], outputCols=[f"{f}_bin" for f in features])
    seen = [f"{f}_{x}" for x in ("bin", "missing") for f in features]
    rows = train.filter(F.col(target).isNotNull()).select(*features, F.col(target).cast("double").alias("_target"))
    binned = Pipeline(stages=[SQLTransformer(statement=f"SELECT *, {marks}, {doubles} FROM __THIS__"), fill, cut]).fit(rows)
    join = VectorAssembler(inputCols=seen, outputCol="_features")
    order = [(F.col(x) + 0.0).alias(x) for x in seen]  # as numbers: bins that are named by their column's metadata would be categories
    cells = checkpoint(binned.transform(rows).groupBy(*order).agg(F.count("*").cast("double").alias("_weight"), F.avg("_target").alias("_target")))
    gbt = GBTRegressor(featuresCol="_features", labelCol="_target", weightCol="_weight", predictionCol="prediction", maxIter=trees, maxDepth=depth, maxBins=BINS, seed=seed)
    return PipelineModel([*binned.stages, join, gbt.fit(join.transform(cells))])


def naive_forecasts(df: DataFrame, actual: str, last_week: str, usual: str, kind: str) -> DataFrame:
    """Error scores of two forecasts that need no model: the same weekday last week, and the usual value."""
    parts = [error_scores(df, actual, c, kind).withColumn("forecast", F.lit(name)) for name, c in (("last_week", last_week), ("usual", usual))]
    return parts[0].unionByName(parts[1])


def ablation(train: DataFrame, test: DataFrame, sets: dict[str, Sequence[str]], target: str, **options) -> DataFrame:
    """Mean absolute error of the forecast with each set of features, on the same rows, and the gain over the first set."""
    out = None
    for name, features in sets.items():
        scored = fit_forecast(train, features, target, **options).transform(test.filter(F.col(target).isNotNull()))
        one = scored.agg(F.avg(F.abs(F.col(target) - F.col("prediction"))).alias("mae"), F.count("*").alias("n")).select(F.lit(name).alias("features"), "mae", "n")
        out = one if out is None else out.unionByName(one)
    first, out = next(iter(sets)), checkpoint(out)  # a row for each set, read twice
    base = out.filter(F.col("features") == first).select(F.col("mae").alias("_base"))
    return out.crossJoin(base).select("features", "mae", "n", (1 - F.col("mae") / F.col("_base")).alias("gain"))


def sign_agreement(df: DataFrame, a: str, b: str, min_gap: float) -> DataFrame:
    """Share of rows whose signs agree, where ``a`` is at least ``min_gap`` from zero."""
    big = F.abs(F.col(a)) >= min_gap
    same = (F.signum(a) == F.signum(b)).cast("int")
    return df.agg(F.avg(F.when(big, same)).alias("agreement"), F.count(F.when(big, same)).alias("n"))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: number, least, quartiles, median and largest value, exactly."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s")).select("s.*")
    at = lambda i: F.get("quantiles", F.lit(i))
    found = exact_quantiles(long, "v", [0.25, 0.5, 0.75], ["column"]).select("column", at(0).alias("q1"), at(1).alias("median"), at(2).alias("q3"))
    return long.groupBy("column").agg(F.count("v").alias("n"), F.min("v").alias("min"), F.max("v").alias("max")).join(found, "column", "left").select("column", "n", "min", "q1", "median", "q3", "max")
