"""Contracts, gates that stop a build, and audits."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.operators.ordering import sample_keys
from countflow.operators.sets import except_keys


#: Bytes of a file that a task holds at once.
PIECE = 8 << 20


class GateError(ValueError):
    """A build must stop; the message lists why."""


def check_contract(df: DataFrame, contract: Mapping[str, tuple[T.DataType, str]], exact: bool = True) -> DataFrame:
    """``df`` in the contract's order, each column with its description as metadata. New, missing and repeated columns stop the build, by name."""
    cols = df.columns
    faults = [f"missing: {c}" for c in contract if c not in cols]
    faults += [f"repeated: {c}" for c in sorted({c for c in cols if cols.count(c) > 1})]
    faults += [f"new: {c}" for c in cols if exact and c not in contract]
    faults += [f"type of {c}: {df.schema[c].dataType.simpleString()}, not {t.simpleString()}" for c, (t, _) in contract.items() if c in cols and df.schema[c].dataType != t]
    faults += [f"no description: {c}" for c, (_, text) in contract.items() if not text.strip()]
    if faults:
        raise GateError("; ".join(faults))
    return df.select(*[F.col(c).alias(c, metadata={"comment": text}) for c, (_, text) in contract.items()])


def domain_violations(df: DataFrame, rules: Mapping[str, Sequence]) -> DataFrame:
    """(column, value, rows) of values outside each column's closed set; null is in every set. One scan for all rules."""
    bad = [F.when(~F.col(c).isin(list(allowed)), F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))) for c, allowed in rules.items()]
    return df.select(F.explode(F.array_compact(F.array(*bad))).alias("b")).groupBy("b.column", "b.value").agg(F.count("*").alias("rows"))


def check_domain(df: DataFrame, rules: Mapping[str, Sequence]) -> DataFrame:
    bad = domain_violations(df, rules).limit(20).collect()
    if bad:
        raise GateError("; ".join(f"{r['column']}={r['value']!r} ({r['rows']} rows)" for r in bad))
    return df


def share_failures(stats: DataFrame, partition: str, rules: Mapping[str, tuple[str, str, float]]) -> DataFrame:
    """(partition, rule, share, limit) where a share is strictly above its limit; a rule is (numerator, denominator, limit), and a zero denominator has no share."""
    rows = F.array(*[F.struct(F.lit(k).alias("rule"), (F.col(n) / F.nullif(F.col(d), F.lit(0))).alias("share"), F.lit(float(m)).alias("limit")) for k, (n, d, m) in rules.items()])
    return stats.select(partition, F.explode(rows).alias("r")).select(partition, "r.*").filter("share > `limit`")


def presence_failures(parts: DataFrame, expected: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that lack (``required``) or that nobody expects (``unknown``)."""
    lacking = except_keys(expected, parts, key).withColumn("problem", F.lit("required"))
    return lacking.unionByName(except_keys(parts, expected, key).withColumn("problem", F.lit("unknown")))


def fill_share(df: DataFrame, value: str, inside: Column, min_share: float = 0.9, min_rows: int = 1000) -> DataFrame:
    """How many rows that should have a value have one, and whether that passes (also with too few rows to tell)."""
    g = df.agg(F.count_if(inside).alias("rows"), F.count_if(inside & F.col(value).isNotNull()).alias("filled"))
    share = F.col("filled") / F.nullif(F.col("rows"), F.lit(0))
    return g.select("rows", "filled", share.alias("share"), ((F.col("rows") < min_rows) | (share >= min_share)).alias("passes"))


def station_coverage(df: DataFrame, limits: Mapping[str, float], min_rows: int = 100) -> DataFrame:
    """Per column the share of rows that have a station, against its limit."""
    g = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in limits])
    rows = F.array(*[F.struct(F.lit(c).alias("element"), F.col("_n").alias("rows"), (F.col(c) / F.nullif(F.col("_n"), F.lit(0))).alias("share"), F.lit(float(m)).alias("limit")) for c, m in limits.items()])
    return g.select(F.explode(rows).alias("r")).select("r.*").withColumn("passes", (F.col("rows") < min_rows) | (F.col("share") >= F.col("limit")))


def calendar_span(calendar: DataFrame, facts: DataFrame, ts: str, margin: int = 14) -> DataFrame:
    """The calendar's last day, the day it must reach, and whether it does."""
    last = facts.agg(F.date_add(F.max(F.to_date(F.col(ts))), margin).alias("needed"))
    return calendar.agg(F.max("date").alias("last")).crossJoin(last).withColumn("passes", F.col("last") >= F.col("needed"))


def code_name_violations(df: DataFrame, codes: DataFrame, code: str, name: str, digits: int = 2) -> DataFrame:
    """Rows whose name isn't that of their code's first ``digits``; ``codes``: (prefix, name)."""
    right = codes.select(F.col("prefix").alias("_p"), F.col("name").alias("_n"))
    joined = df.join(right, F.substring(F.col(code).cast("string"), 1, digits) == F.col("_p"), "left")
    return joined.filter(~F.col(name).eqNullSafe(F.col("_n"))).select(*df.columns, F.col("_n").alias("expected_name"))


def file_manifest(spark, path: str | list[str]) -> DataFrame:
    """Path, name, bytes and SHA-256 of each file below ``path``. Tasks read the files piece by piece, so none has to fit in memory. Empty files aren't in Spark's list of files."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))
    spread = listed.repartition(F.col("path"))
    schema = T.StructType([*listed.schema.fields, T.StructField("sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for uri in batch.column(0).to_pylist():
                fs, at = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
                digest = hashlib.sha256()
                with fs.open_input_stream(at, compression=None) as f:
                    while piece := f.read(PIECE):
                        digest.update(piece)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], schema.names)

    return spread.mapInArrow(run, schema)


def manifest(stats: DataFrame, partition: str, counts: Sequence[str], inputs: DataFrame, outputs: DataFrame, expected: DataFrame, rules: Mapping[str, tuple[str, str, float]]) -> DataFrame:
    """A build's manifest in long form: (section, name, field, value as text).

    Sections: ``partition`` (each partition's ``counts``), ``total`` (their sums, and how many partitions there are), ``missing`` (expected partitions that aren't there), ``input`` and ``output`` (bytes and
    SHA-256 of each file, see ``file_manifest``), ``failure`` (partitions, and ``all`` of them together, whose share is above a rule's limit, see ``share_failures``). ``expected`` has the column ``partition``.
    """
    text = lambda c: F.col(c).cast("string")

    def long(df: DataFrame, section: str, name, fields: Sequence[str]) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), text(f).alias("value")) for f in fields]))
        return df.select(F.lit(section).alias("section"), name.cast("string").alias("name"), each.alias("f")).select("section", "name", "f.*")

    totals = stats.agg(*[F.sum(c).alias(c) for c in counts], F.count("*").alias("partitions"))
    lacking = expected.select(partition).distinct().join(stats, partition, "left_anti").withColumn("missing", F.lit(True))
    whole = totals.select(F.lit("all").alias(partition), *counts).unionByName(stats.select(text(partition).alias(partition), *counts))
    failed = share_failures(whole, partition, rules)
    parts = [
        long(stats, "partition", F.col(partition), counts),
        long(totals, "total", F.lit("all"), [*counts, "partitions"]),
        long(lacking, "missing", F.col(partition), ["missing"]),
        *[long(files, section, F.col("name"), ["bytes", "sha256"]) for section, files in (("input", inputs), ("output", outputs))],
        failed.select(F.lit("failure").alias("section"), F.col(partition).alias("name"), F.col("rule").alias("field"), text("share").alias("value")),
    ]
    return reduce(DataFrame.unionByName, parts)


def snapshot_diff(old: DataFrame, new: DataFrame, name: str = "name", digest: str = "sha256") -> DataFrame:
    """Assets added, removed or changed between two snapshots."""
    a, b = old.select(name, F.col(digest).alias("_old")), new.select(name, F.col(digest).alias("_new"))
    both = a.join(b, name, "full_outer")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "changed")
    return both.select(name, change.alias("change")).filter("change IS NOT NULL")


def table_diff(a: DataFrame, b: DataFrame, key: Sequence[str], cols: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """One row: keys only in a, only in b, twice in either, and for each column how many common keys differ (null against a value differs)."""
    def side(df: DataFrame, p: str) -> DataFrame:
        return df.groupBy(*key).agg(F.count("*").alias(f"{p}n"), *[F.min(c).alias(p + c) for c in cols])

    j = side(a, "_a_").join(side(b, "_b_"), list(key), "full_outer")

    def differ(c: str) -> Column:
        x, y = F.col("_a_" + c), F.col("_b_" + c)
        near = F.abs(x - y) <= tolerance if isinstance(a.schema[c].dataType, T.NumericType) else x == y
        return ~(x.eqNullSafe(y) | F.coalesce(near, F.lit(False)))

    both = F.col("_a_n").isNotNull() & F.col("_b_n").isNotNull()
    return j.agg(
        F.count_if(F.col("_b_n").isNull()).alias("only_a"),
        F.count_if(F.col("_a_n").isNull()).alias("only_b"),
        F.count_if((F.col("_a_n") > 1) | (F.col("_b_n") > 1)).alias("repeated"),
        *[F.count_if(both & differ(c)).alias(f"differ_{c}") for c in cols],
    )


def audit_sample(df: DataFrame, key: Sequence[str], rare: Column, n: int, seed: int = 0) -> DataFrame:
    """``n`` keys by hash and every key with a row for which ``rare`` holds."""
    odd = df.filter(rare).select(*key).distinct()
    return sample_keys(df, key, n, seed).union(odd).distinct()


def audit_partitions(sizes: DataFrame, partition: str, size: str, odd: Column, month: str) -> DataFrame:
    """Partitions to recompute: of those that aren't ``odd`` the two smallest and one that a hash of ``month`` chooses among the rest but the largest quarter (at least one is left to
    choose from); and every odd one. Sizes are ranked in one task: there are as many as partitions."""
    usual = Window.partitionBy(F.lit(0)).orderBy(size, partition)
    ranked = sizes.filter(~F.coalesce(odd, F.lit(False))).select(partition, (F.row_number().over(usual) - 1).alias("_at"), F.count("*").over(Window.partitionBy(F.lit(0))).alias("_n"))
    choice = F.greatest(F.lit(3), F.floor(3 * F.col("_n") / 4)) - 2  # how many there are to choose from, after the first two
    choice = F.least(choice, F.col("_n") - 2)
    digest = F.conv(F.substring(F.sha2(F.lit(month), 256), 50, 15), 16, 10).cast("bigint")
    picked = (choice > 0) & (F.col("_at") == 2 + digest % F.greatest(choice, F.lit(1)))
    return ranked.filter((F.col("_at") < 2) | picked).select(partition).union(sizes.filter(odd).select(partition)).distinct()


def backlog(expected: DataFrame, have: DataFrame, skip: DataFrame, attempts: DataFrame, key: str, max_attempts: int = 3) -> DataFrame:
    """What is expected, with its status: complete, skipped, failed (attempts used up), retry (failed before) or todo."""
    flag = lambda df, n: df.select(key).distinct().withColumn(n, F.lit(True))
    j = expected.select(key).distinct().join(flag(have, "_have"), key, "left").join(flag(skip, "_skip"), key, "left").join(attempts.select(key, F.col("attempts").alias("_n")), key, "left")
    status = F.when(F.col("_have"), "complete").when(F.col("_skip"), "skipped").when(F.col("_n") >= max_attempts, "failed").when(F.col("_n") > 0, "retry").otherwise("todo")
    return j.select(key, F.coalesce("_n", F.lit(0)).alias("attempts"), status.alias("status"))


def min_rows(df: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows of the table, or of each group, and whether that is enough."""
    return df.groupBy(*by).agg(F.count("*").alias("rows")).withColumn("passes", F.col("rows") >= n)


def enforce(report: DataFrame, what: str) -> None:
    """Stops if a gate's report (with ``passes``) has a row that fails, or a list of failures (without it) has any row."""
    bad = (report.filter(~F.col("passes")) if "passes" in report.columns else report).limit(20).collect()
    if bad:
        raise GateError(f"{what}: " + "; ".join(str(r.asDict()) for r in bad))
