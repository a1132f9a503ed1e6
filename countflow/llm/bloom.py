"""Bloom filters in DataFrame functions: which hashes may repeat, or may be in a table, without shuffling the rows that can't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countflow.session import checkpoint

#: Bits of one filter block, as Spark's bitmap functions lay it out (4 KB).
BLOCK_BITS = 32768
#: A filter has 16 cells for each row and at most this many: 2**29 bits, 64 MB, whatever the input.
MAX_FILTER_BITS = 1 << 29
CELLS_PER_ROW = 16
#: Beyond MAX_FILTER_BITS / CELLS_PER_ROW rows the hashes are split into so many ranges at most, with a filter each, one in use at a time.
#: Beyond that (2**31 rows) more rows pass the filters and shuffle; results are exact at any size.
MAX_RANGES = 64


def filter_bits(rows: int) -> int:
    bits = BLOCK_BITS
    while bits < min(rows * CELLS_PER_ROW, MAX_FILTER_BITS):
        bits *= 2
    return bits


def ranges_for(rows: int) -> int:
    return max(1, min(MAX_RANGES, -(-rows * CELLS_PER_ROW // MAX_FILTER_BITS)))


def in_range(hash64: Column, which: int, ranges: int) -> Column:
    """Whether a hash belongs to one of ``ranges`` parts; the cell comes from other bits."""
    return F.lit(True) if ranges == 1 else F.pmod(F.shiftrightunsigned(hash64, 32), F.lit(ranges)) == which


def _cell(hash64: Column, bits: int) -> Column:
    return hash64.bitwiseAND(F.lit(bits - 1)).cast("int")


def filter_blocks(hashes: DataFrame, hash_col: str, bits: int, least: dict[str, int]) -> DataFrame:
    """Filter blocks (block, and for each name in ``least`` a bitmap of the cells that so many rows set or more).

    Only 32-bit cell numbers shuffle, counted in each task first, so a hot hash costs a task one row; the result is at most ``bits`` / 8
    bytes a bitmap.
    """
    often = hashes.select(_cell(F.col(hash_col), bits).alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") >= min(least.values()))
    maps = [F.expr(f"bitmap_construct_agg(cell % {BLOCK_BITS}) FILTER (WHERE n >= {n})").alias(name) for name, n in least.items()]
    return often.groupBy(F.floor(F.col("cell") / BLOCK_BITS).cast("int").alias("block")).agg(*maps)


def _bit(bitmap: Column, position: Column) -> Column:
    """Whether the bit at ``position`` is set; false where the block is missing."""
    byte = F.conv(F.hex(F.substr(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))


def mark_members(df: DataFrame, hash_col: str, blocks: DataFrame, bits: int, names: list[str]) -> DataFrame:
    """``df`` with a boolean for each of the filters ``names``: whether the hash's cell is set. A filter's size is bounded, so it is broadcast; ``df``
    isn't shuffled. Columns of ``df`` must not be named like the filters, ``_block`` or ``_cell``."""
    df = df.withColumn("_cell", _cell(F.col(hash_col), bits))
    found = df.join(F.broadcast(blocks.withColumnRenamed("block", "_block")), F.floor(F.col("_cell") / BLOCK_BITS).cast("int") == F.col("_block"), "left")
    tests = [_bit(F.col(n), F.col("_cell") % BLOCK_BITS).alias(n) for n in names]
    return found.select(*[c for c in df.columns if c != "_cell"], *tests)


def may_repeat(rows: DataFrame, hash_col: str, count: int, least: dict[str, int]) -> DataFrame:
    """``rows`` (a written table of ``count`` rows) with a boolean for each name in ``least``: whether so many rows may have the row's hash. Never
    false where they do."""
    bits, ranges, out = filter_bits(count), ranges_for(count), None
    for k in range(ranges):
        part = rows if ranges == 1 else rows.filter(in_range(F.col(hash_col), k, ranges))
        marked = mark_members(part, hash_col, checkpoint(filter_blocks(part.select(hash_col), hash_col, bits, least)), bits, list(least))
        out = marked if out is None else out.unionByName(marked)
    return out


def split_members(rows: DataFrame, hash_col: str, keys: DataFrame, key_col: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose hash may be in ``keys`` (a written table), and those whose hash is not, by a Bloom filter of ``keys``; no row shuffles."""
    bits = filter_bits(keys.count())
    marked = mark_members(rows, hash_col, checkpoint(filter_blocks(keys.select(key_col), key_col, bits, {"_in": 1})), bits, ["_in"])
    return marked.filter("_in").drop("_in"), marked.filter(~F.col("_in")).drop("_in")


def plain_names(df: DataFrame, **own: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns named ``c0``, ``c1`` ..., or as ``own`` says (new name = old name), so that no name clashes with an operator's own;
    and the old name of each."""
    back = {next((n for n, old in own.items() if old == c), f"c{k}"): c for k, c in enumerate(df.columns)}
    return df.toDF(*back), back


def without(documents: DataFrame, gone: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``documents`` without the rows that are in ``gone`` (id, mark: the text's XXH64), a written table. Only rows that a Bloom filter of the marks lets
    pass are shuffled."""
    rows, back = plain_names(documents, text=text, **({} if doc_id == text else {"id": doc_id}))
    hit, rest = split_members(rows.withColumn("mark", F.xxhash64("text")), "mark", gone, "mark")
    key = "id" if "id" in back else "text"
    lost = gone.select(F.col("id").alias("_id"), F.col("mark").alias("_mark"))
    left = hit.join(lost, (hit["mark"] == lost["_mark"]) & hit[key].eqNullSafe(lost["_id"]), "left_anti")
    return left.unionByName(rest).select(*[F.col(n).alias(c) for n, c in back.items()])
