"""Reading of raw counter files, each by a fixed, checked contract, and writing of the tables made from them."""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countflow.functions import ten_day_chunk
from countflow.operators.gates import GateError
from countflow.session import checkpoint

#: Rows of a written file and of a row group in it, at most.
FILE_ROWS, GROUP_ROWS = 2_000_000, 250_000
#: Parts of a raw file's name: sensor, resolution, road type and day.
FILE_NAME = r"(loop|cctv)_(5m|1h)_road([13])_(\d{8})\.csv(?:\.gz)?$"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_layer(spark: SparkSession, path: str, names: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """One layer's CSV files (plain or gzip), all columns text, under their canonical names. ``names`` maps each source column to its canonical name; every file must have
    just these and the columns to ``drop``, in an order of its own. A file with other columns stops the build, which names it and lists them."""
    expected = {*names, *drop}

    def layout(found: list[str], file: str) -> dict[str, str]:
        if set(found) != expected or len(found) != len(expected):
            twice = "; twice: " + str(sorted({c for c in found if found.count(c) > 1})) if len(set(found)) < len(found) else ""
            raise GateError(f"{file}: missing: {sorted(expected - set(found))}; new: {sorted(set(found) - expected)}{twice}")
        return {b: a for a, b in names.items()}

    return read_layouts(spark, path, list(names.values()), layout).drop("_file")


def read_layouts(spark: SparkSession, path: str | list[str], columns: Sequence[str], layout: Callable[[list[str], str], dict[str, str]], options: Mapping[str, str] | None = None, quoting: int = csv.QUOTE_MINIMAL, only: DataFrame | None = None) -> DataFrame:
    """The rows of CSV files that have headers of their own, as ``_file`` and text ``columns``, in one scan of their lines.

    ``layout`` gets a header's columns and the name of a file that has it, and says for each of ``columns`` which of the header's it is (a column left out is null). The driver gets the different headers, never the list of
    files: each line is joined with its file's header and read by that header's schema. Lines that are blank or repeat their header are left out; a file's first line may begin with a byte order mark. ``only``: the names (_name) of the files that count.
    """
    plain = F.regexp_replace("value", "^\ufeff|\r$", "")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_n"), plain.alias("value"))
    if only is not None:
        lines = lines.withColumn("_name", F.regexp_extract("_file", "([^/]+)$", 1)).join(only.distinct(), "_name", "left_semi").drop("_name")
    headers = checkpoint(lines.filter("_at = 0").groupBy("_file").agg(F.min_by("value", "_n").alias("header")))
    return rows_by_header(lines, headers, columns, layout, options, quoting)


#: Characters that are cut off a cell's ends.
BLANK = "".join(map(chr, range(33)))


def rows_by_header(lines: DataFrame, headers: DataFrame, columns: Sequence[str], layout: Callable[[list[str], str], dict[str, str]], options: Mapping[str, str] | None = None, quoting: int = csv.QUOTE_MINIMAL) -> DataFrame:
    """``lines`` (_file, value) of the files that ``headers`` (_file, header, once each; more columns are kept) name, each read by its file's header as in ``read_layouts``.
    With ``csv.QUOTE_NONE`` cells end at commas, whatever they hold; blanks around them go and empty ones are null."""
    spark, more = lines.sparkSession, [c for c in headers.columns if c not in ("_file", "header")]
    kinds = headers.groupBy("header").agg(F.min("_file").alias("file")).orderBy("header").collect()
    rows, plain = None, quoting == csv.QUOTE_NONE
    for kind in kinds:
        found = next(csv.reader([kind["header"]], quoting=quoting), [])
        of = layout(found, kind["file"])
        if plain:  # without quotes a split by commas says the same, far faster than a parser that begins anew with each line
            cell = lambda i: F.nullif(F.trim(F.get(F.split("value", ","), F.lit(i)), F.lit(BLANK)), F.lit(""))
            row = F.struct(*[(cell(found.index(of[c])) if c in of else F.lit(None).cast("string")).alias(c) for c in columns])
        else:
            fields = ", ".join(f"`c{i}` STRING" for i in range(len(found)))
            read = F.from_csv("value", fields, {"mode": "PERMISSIVE", **(options or {})})
            row = F.transform(F.array(read), lambda r: F.struct(*[(r[f"c{found.index(of[c])}"] if c in of else F.lit(None).cast("string")).alias(c) for c in columns]))[0]
        rows = F.when(F.col("header") == kind["header"], row) if rows is None else rows.when(F.col("header") == kind["header"], row)
    if rows is None:
        return spark.createDataFrame([], text_schema(["_file", *more, *columns]))
    body = lines.filter("trim(value) <> ''").join(headers, "_file").filter("value <> header")
    return body.select("_file", *more, rows.alias("_r")).select("_file", *more, "_r.*")


def discover_partitions(spark: SparkSession, path: str, pattern: str = FILE_NAME) -> DataFrame:
    """(path, sensor, res, road, day, chunk) of the files below ``path`` whose names fit; the others have nulls."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    part = lambda k: F.nullif(F.regexp_extract("path", pattern, k), F.lit(""))
    day = F.to_date(F.try_to_timestamp(part(4), F.lit("yyyyMMdd")))
    return files.select("path", part(1).alias("sensor"), part(2).alias("res"), part(3).alias("road"), day.alias("day"), ten_day_chunk(day).alias("chunk"))


def read_positional_csv(spark: SparkSession, paths: Sequence[str], columns: Mapping[int, str], key: str | None = None, width: int = 11, region_pattern: str = r"([^/]+)\.csv$", encoding: str = "UTF-8") -> DataFrame:
    """Wide tables without a header: the columns at the given places under their names, ``region`` from the file's name, ``key`` padded with zeros.

    The files are read as text of ``max(columns) + 1`` columns or more, so short rows have nulls.
    """
    n = max(columns) + 1
    raw = spark.read.schema(text_schema([f"_c{i}" for i in range(n)])).option("header", False).option("encoding", encoding).csv(list(paths))
    out = raw.select(*[F.col(f"_c{i}").alias(c) for i, c in columns.items()], F.regexp_extract(F.col("_metadata.file_path"), region_pattern, 1).alias("region"))
    return out if key is None else out.withColumn(key, F.lpad(key, width, "0"))


def write_chunks(df: DataFrame, path: str, ts: str, key: Sequence[str], res: str | None = None, rows: int = FILE_ROWS, group_rows: int = GROUP_ROWS) -> None:
    """Parquet with zstd by resolution and ten-day chunk, in key order within a chunk: over its files, in order of their names, and in each.

    A chunk has as many ranges of the key as its number of rows asks for, so a large one is written by many tasks. A file has at most ``rows`` rows and a row group at most ``group_rows``.
    The rows are written to the shared folder first, since they are read for the counts, for the ranges' ends and for the chunks; that also keeps a constant column from being
    taken out of the sort order, after which Spark would sort by chunk alone.
    """
    out = checkpoint(df.withColumn("chunk", ten_day_chunk(F.to_date(F.col(ts)))))
    parts = [c for c in (res, "chunk") if c]
    ranges = out.groupBy(*parts).agg(F.count("*").alias("n")).agg(F.sum(F.ceil(F.col("n") / rows))).first()[0]
    writer = out.repartitionByRange(int(ranges or 1), *parts, *key).sortWithinPartitions(*parts, *key).write.mode("overwrite").partitionBy(*parts)
    writer.option("compression", "zstd").option("maxRecordsPerFile", rows).option("parquet.block.row.count.limit", group_rows).parquet(path)


def write_region_parts(df: DataFrame, path: str, key: Sequence[str]) -> None:
    """One month's table in key order over all files."""
    df.repartitionByRange(*key).sortWithinPartitions(*key).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_csv_dimension(df: DataFrame, path: str, compression: str = "none") -> None:
    """A small table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
