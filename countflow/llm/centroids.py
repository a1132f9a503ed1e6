"""Clusters integer vectors around centroids (Lloyd's rounds), by scalar lookup tables.

Vectors are kept in blocks. A block lists, for each dimension, the different integers that occur in it, and codes every component as
one of them. A round tabulates the squared difference of each such integer from each centroid's component; a vector's distances are
then sums of rows gathered from these tables. All arithmetic is in integers, so results don't depend on the order of rows or tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.session import checkpoint

#: Vectors of a block; codes are 16 bits wide, so at most 65,536.
BLOCK = 4096
#: Components are below this, so that 64 squared differences fit in a long. A larger one is an error.
LIMIT = 1 << 27
#: Dimensions that stand for the count and the summed distance in the table of a round's sums.
COUNT, INERTIA = -1, -2
LONG = (1 << 63) - 1


def is_vector(col: Column | str, dims: int) -> Column:
    """Whether a list has exactly ``dims`` components, none null, NaN or infinite. Null lists: false."""
    col = F.col(col) if isinstance(col, str) else col
    good = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(col) == dims) & good, F.lit(False))


def scaled(col: Column | str, scale: int) -> Column:
    """``floor(scale * x)`` of each component, in doubles; one of 2^27 or more is an error."""
    col = F.col(col) if isinstance(col, str) else col
    too_large = F.raise_error(F.lit(f"a component times {scale} is {LIMIT} or more"))
    return F.transform(col, lambda x: F.when(F.abs(x.cast("double") * scale) < LIMIT, F.floor(x.cast("double") * scale)).otherwise(too_large.cast("bigint")))


def first_centroids(vectors: DataFrame, key: str, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ``seed:key`` has the smallest SHA-256, in that order (fewer, if there are fewer). Keys that are equal go by their components; a null key counts as empty."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    rows = vectors.select(hashed.alias("h"), "ints").orderBy("h", "ints").limit(k).collect()
    return np.array([r["ints"] for r in rows], np.int64)


def blocks(vectors: DataFrame, key: str, dims: int) -> DataFrame:
    """Rows of up to ``BLOCK`` vectors, written once: ``keys``, ``sizes`` (different integers of each dimension), ``values`` (those, dimension after
    dimension) and ``codes`` (for each dimension every vector's place among them)."""
    schema = T.StructType([T.StructField("keys", T.ArrayType(vectors.schema[key].dataType)), *(T.StructField(n, T.BinaryType()) for n in ("sizes", "values", "codes"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ints = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
                found = [np.unique(ints[:, d], return_inverse=True) for d in range(dims)]
                sizes = np.array([len(v) for v, _ in found], "<u4")
                values = np.concatenate([v for v, _ in found]).astype("<i4")
                codes = np.stack([c for _, c in found]).astype("<u2")
                keys = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([keys, *(pa.array([x.tobytes()], pa.binary()) for x in (sizes, values, codes))], schema.names)

    return checkpoint(vectors.select(key, "ints").mapInArrow(run, schema))


def _read(sizes: bytes, values: bytes, codes: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    n = np.frombuffer(sizes, "<u4")
    return np.split(np.frombuffer(values, "<i4").astype(np.int64), np.cumsum(n)[:-1]), np.frombuffer(codes, "<u2").reshape(len(n), -1)


def nearest(values: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid (the smaller number among equals) and its squared distance."""
    sums = np.zeros((codes.shape[1], len(centroids)), np.int64)
    for d, v in enumerate(values):
        table = (v[:, None] - centroids[None, :, d]) ** 2
        sums += table.take(codes[d], axis=0)
    cluster = sums.argmin(axis=1)
    return cluster, np.take_along_axis(sums, cluster[:, None], 1)[:, 0]


def round_sums(blocked: DataFrame, centroids: np.ndarray) -> dict[tuple[int, int], int]:
    """By cluster and dimension the exact sum of its vectors' components, and by (cluster, COUNT) and (cluster, INERTIA) their number and summed
    distance. A task gives a row for each of these at most, and the driver gets as many."""
    k, dims = centroids.shape
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("dim", T.IntegerType()), T.StructField("total", T.DecimalType(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, inertia, seen = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), [0] * k, False
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                values, codes = _read(*row)
                cluster, distance = nearest(values, codes, centroids)
                seen = True
                counts += np.bincount(cluster, minlength=k)
                for d, v in enumerate(values):  # sums of a block stay below 2^53, where doubles are exact
                    sums[:, d] += np.bincount(cluster, weights=v[codes[d]], minlength=k).astype(np.int64)
                for c in range(k):  # a distance may have 62 bits, so its halves are summed apart
                    own = distance[cluster == c]
                    inertia[c] += (int((own >> 31).sum()) << 31) + int((own & 0x7FFFFFFF).sum())
        if seen:
            out = [(c, d, int(sums[c, d])) for c in range(k) if counts[c] for d in range(dims)]
            out += [x for c in range(k) if counts[c] for x in ((c, COUNT, int(counts[c])), (c, INERTIA, inertia[c]))]
            cluster, dim, total = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(dim, pa.int32()), pa.array(total, pa.decimal128(38, 0))], schema.names)

    rows = blocked.select("sizes", "values", "codes").mapInArrow(run, schema).groupBy("cluster", "dim").agg(F.sum("total").alias("total"))
    return {(r["cluster"], r["dim"]): int(r["total"]) for r in rows.collect()}


def moved(centroids: np.ndarray, sums: dict[tuple[int, int], int]) -> np.ndarray:
    """Each centroid at its vectors' floored mean; one without vectors stays."""
    out = centroids.copy()
    for c in range(len(out)):
        if n := sums.get((c, COUNT), 0):
            out[c] = [sums[c, d] // n for d in range(out.shape[1])]
    return out


def cluster(df: DataFrame, key: str, vector: str, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """One row for each vector that ``is_vector``: key, ``cluster``, ``distance`` (squared, to its centroid), ``cluster_inertia`` and ``inertia`` (distances summed over its
    cluster and over all) and ``centroid`` (the centroid's integers).

    Other rows give none, and neither does an empty table. Repeated rows count each; null keys pass through; other columns are left out. With fewer than ``k`` vectors there are
    fewer centroids. Sums beyond a long are an error. The blocks are written to the shared folder once and read by each round; ``k`` times ``dims`` numbers a task are all that shuffles.
    """
    schema = T.StructType(
        [T.StructField(key, df.schema[key].dataType), T.StructField("cluster", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("distance", "cluster_inertia", "inertia")), T.StructField("centroid", T.ArrayType(T.LongType()))]
    )
    vectors = df.filter(is_vector(vector, dims)).select(key, scaled(vector, scale).alias("ints"))
    centroids = first_centroids(vectors, key, k, seed)
    if not len(centroids):
        return df.sparkSession.createDataFrame([], schema)
    blocked = blocks(vectors, key, dims)
    for _ in range(rounds):
        centroids = moved(centroids, round_sums(blocked, centroids))
    last = round_sums(blocked, centroids)
    by_cluster = [last.get((c, INERTIA), 0) for c in range(len(centroids))]
    total = sum(by_cluster)
    if total > LONG:
        raise OverflowError("the summed distance doesn't fit in a long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.array(centroids.tolist(), pa.list_(pa.int64()))
        for batch in batches:
            for i in range(batch.num_rows):
                values, codes = _read(*(batch.column(c)[i].as_py() for c in (1, 2, 3)))
                own, distance = nearest(values, codes, centroids)
                keys = batch.column(0).slice(i, 1).flatten()
                made = [pa.array(own.astype(np.int32)), pa.array(distance), pa.array(np.array(by_cluster, np.int64)[own]), pa.array(np.full(len(own), total, np.int64)), lists.take(pa.array(own))]
                yield pa.RecordBatch.from_arrays([keys, *made], schema.names)

    return blocked.mapInArrow(run, schema)


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    found = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def _sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS ints
            FROM embeddings WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dims})""",
        "long AS MATERIALIZED (SELECT r, generate_subscripts(ints, 1) AS d, unnest(ints) AS x FROM kept)",
        f"first AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), ints) - 1 AS c, ints FROM kept QUALIFY c < {k})",
        "c0 AS MATERIALIZED (SELECT c, generate_subscripts(ints, 1) AS d, unnest(ints) AS y FROM first)",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT r, min(s * {k} + c) % {k} AS c, min(s) AS s FROM
            (SELECT r, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS s FROM long JOIN c{i} USING (d) GROUP BY r, c) GROUP BY r)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT o.c, o.d, coalesce(m.y, o.y) AS y FROM c{i} o LEFT JOIN
                (SELECT c, d, (t - ((t % n) + n) % n) // n AS y FROM (SELECT c, d, CAST(sum(x) AS BIGINT) AS t, count(*) AS n FROM long JOIN a{i} USING (r) GROUP BY c, d)) m USING (c, d))"""
            )
    last = f"a{rounds}"
    return f"""WITH {", ".join(parts)},
        per AS (SELECT c, CAST(sum(s) AS BIGINT) AS s FROM {last} GROUP BY c),
        named AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c)
        SELECT vec_id, CAST({last}.c AS INTEGER) AS cluster, {last}.s AS distance, per.s AS cluster_inertia, CAST((SELECT sum(s) FROM per) AS BIGINT) AS inertia, h AS centroid_sha256
        FROM kept JOIN {last} USING (r) JOIN per ON per.c = {last}.c JOIN named ON named.c = {last}.c"""


OP12_SQL = _sql()
