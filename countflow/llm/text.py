"""Small text helpers shared by the text operators."""

from __future__ import annotations

import string
from collections.abc import Callable, Hashable, Iterator
from itertools import islice
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

ASCII_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of ``text`` with A-Z lower-cased, as UTF-8 (null: none).

    ``bytes.split()`` cuts at just these six ASCII characters, unlike ``str.split()``.
    """
    return text.encode("utf-8", "replace").translate(ASCII_LOWER).split() if text else []


def lower_ascii(col: Column | str) -> Column:
    """``col`` with A-Z lower-cased and every other character as it is."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def id_remainder(doc_id: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: the fold that a document belongs to."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % divisor


def slices(batch: pa.RecordBatch, col: int, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most`` bytes of text, so that a batch of long texts stays small in Python."""
    sizes = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        total += n
        if total >= most:
            yield batch.slice(begin, i + 1 - begin)
            begin, total = i + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def trim(memo: dict, most: int) -> None:
    """Cuts a memo of more than ``most`` entries to the first third, the words that came soonest and so are mostly frequent."""
    if len(memo) > most:
        first = list(islice(memo.items(), most // 3))
        memo.clear()
        memo.update(first)


_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept from task to task. A Python worker keeps one such thing at a time, so the memo of a
    tokenizer isn't held while other operators run."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    _KEPT.clear()
