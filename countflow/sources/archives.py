"""Detector archives: zip files of CSV members as a table."""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import itertools
import re
import uuid
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countflow.session import checkpoint, shared_dir
from countflow.sources.counts import rows_by_header, text_schema

MEMBERS = "archive string, region string, member string, bytes long, sha256 string, file string, problem string, header string"
#: Bytes of a member that a task holds at once, and rows about members.
PIECE, ROWS = 1 << 20, 10_000


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def read_archive_members(spark: SparkSession, path: str, member_pattern: str, region_pattern: str, encoding: str = "cp932", to: str | None = None) -> DataFrame:
    """One row per member of the zip files below ``path``, one nested level deep. ``region`` is the first group of ``region_pattern`` in the innermost archive's name. A
    member whose name doesn't fit, an archive that can't be read, and one of another kind give a row with ``problem`` and no file.

    Archives are opened in place, with seeks; members are copied piece by piece, as lines of UTF-8 text, to one text file for each task below ``to`` (a folder that all machines share), and a
    nested archive as it is. So there are as many files as tasks, however many members; each line follows its member's number in the file and a tab, and ``file`` is the file's name, # and that number. ``header`` is the
    member's first line. No task holds an archive or a member, whatever their size. A repeated task leaves files that no row names.
    """
    to = to or f"{shared_dir(spark)}/members-{uuid.uuid4().hex}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")

    def pieces(z: zipfile.ZipFile, info: zipfile.ZipInfo, digest) -> Iterator[bytes]:
        with z.open(info) as source:
            while piece := source.read(PIECE):
                digest.update(piece)
                yield piece

    def copy(z: zipfile.ZipFile, info: zipfile.ZipInfo) -> tuple[str, int]:
        fs, root = _open(to)
        fs.create_dir(root, recursive=True)
        name, size = f"{uuid.uuid4().hex}.zip", 0
        with fs.open_output_stream(f"{root}/{name}", compression=None) as target:
            for piece in pieces(z, info, hashlib.sha256()):
                size += len(piece)
                target.write(piece)
        return f"{to}/{name}", size

    def copy_lines(z: zipfile.ZipFile, info: zipfile.ZipInfo, number: int, target) -> tuple[int, str, str | None]:
        digest, size, header, rest, begun = hashlib.sha256(), 0, None, [], f"{number}\t"
        text = io.IncrementalNewlineDecoder(codecs.getincrementaldecoder(encoding)(), translate=True)

        def put(found: list[str]) -> None:
            nonlocal header
            if found:
                header = found[0] if header is None else header
                target.write("".join(f"{begun}{line}\n" for line in found).encode("utf-8"))

        for piece in pieces(z, info, digest):
            size += len(piece)
            first, *others = text.decode(piece).split("\n")
            rest.append(first)
            if others:
                put(["".join(rest), *others[:-1]])
                rest = [others[-1]]
        first, *others = text.decode(b"", True).split("\n")
        put([x for x in ["".join([*rest, first]), *others][: None if not others or others[-1] else -1] if x or others])
        return size, digest.hexdigest(), header

    def walk(name: str, uri: str, size: int, depth: int, shared: list) -> Iterator[tuple]:
        region = m[1] if (m := re.search(region_pattern, name)) else None
        fs, at = _open(uri)
        with fs.open_input_file(at) as source:
            try:
                z = zipfile.ZipFile(source)
            except (zipfile.BadZipFile, ValueError):  # pyarrow refuses seeks before the beginning of a tiny file
                yield name, region, None, size, None, None, "not a zip file", None
                return
            for info in z.infolist():
                if info.is_dir():
                    continue
                if info.filename.lower().endswith(".zip") and depth == 0:
                    inner, n = copy(z, info)
                    yield from walk(info.filename, inner, n, 1, shared)
                elif re.search(member_pattern, info.filename):
                    shared[1] += 1
                    n, sha, header = copy_lines(z, info, shared[1], shared[0])
                    yield name, region, info.filename, n, sha, f"{to}/{shared[2]}#{shared[1]}", None, header
                else:
                    yield name, region, info.filename, info.file_size, None, None, "unexpected member", None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _open(to)
        fs.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.txt"
        with fs.open_output_stream(f"{root}/{name}", compression=None, buffer_size=PIECE) as target:
            shared = [target, 0, name]
            rows = (row for batch in batches for path, size in zip(batch["path"], batch["length"]) for row in walk(path.rsplit("/", 1)[-1], path, int(size), 0, shared))
            while some := list(itertools.islice(rows, ROWS)):
                yield pd.DataFrame(some, columns=[c.split()[0] for c in MEMBERS.split(", ")])

    return checkpoint(files.repartition(max(1, min(files.count(), spark.sparkContext.defaultParallelism)), "path").mapInPandas(run, MEMBERS))


def drop_identical_members(members: DataFrame) -> DataFrame:
    """Each member with ``kept_as``: itself, or the first member of its region with the same bytes."""
    w = Window.partitionBy("region", "sha256").orderBy("archive", "member")
    return members.withColumn("kept_as", F.first("member").over(w)).withColumn("is_kept", F.row_number().over(w) == 1)


def read_detector_csv(members: DataFrame, spellings: Mapping[str, str], columns: Sequence[str], optional: Sequence[str]) -> DataFrame:
    """The rows of the members' files in canonical ``columns``, all text and trimmed, after their region. ``spellings`` maps each header spelling to its column; a missing ``optional`` column
    is null and any other missing or unknown one is an error. Short rows have nulls; there is no quoting.

    The lines of all members are read in one scan, each by its member's header (counts.rows_by_header); of the list of members only their folders and different headers go to the driver.
    """
    spark = members.sparkSession
    plain = lambda c: F.regexp_replace(c, "^\ufeff|\r$", "")
    last = lambda c: F.substring_index(c, "/", -1)  # noqa: E731 (a pattern that ends with $ would be tried from each place of the path, for each line)
    known = checkpoint(members.filter("file IS NOT NULL").select(last("file").alias("_file"), "region", "member", F.regexp_extract("file", "^(.*)/", 1).alias("folder"), plain("header").alias("header")))
    folders = [r["folder"] for r in known.select("folder").distinct().collect()]
    if not folders:
        return spark.createDataFrame([], text_schema(["region", *columns]))

    def layout(found: list[str], file: str) -> dict[str, str]:
        head = [spellings.get(h.strip(), f"?{h.strip()}") for h in found]
        bad = [h for h in head if h.startswith("?")] + [n for n in columns if n not in head and n not in optional]
        if bad:
            member = known.filter(F.col("_file") == file).first()
            raise ValueError(f"{member['member'] if member else file}: columns {bad}")
        return {h: f for h, f in zip(head, found)}

    number = F.substring_index("value", "\t", 1)
    text = spark.read.option("pathGlobFilter", "*.txt").text(folders)
    lines = text.select(F.concat(last("_metadata.file_path"), F.lit("#"), number).alias("_file"), plain(F.expr("substr(value, instr(value, '\t') + 1)")).alias("value"))
    headers = known.filter("header IS NOT NULL").select("_file", "header", "region")
    options = {"quote": "", "nullValue": "\x01", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    return rows_by_header(lines, headers, columns, layout, options, csv.QUOTE_NONE).select("region", *columns)
