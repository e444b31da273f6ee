"""Column rules and row keys that several operators of this package share."""

from __future__ import annotations

import string
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Runs without space, tab, line feed, vertical tab, form feed or carriage return.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
#: Runs of digits, small ASCII letters and characters beyond ASCII.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def whole_text(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ASCII texts take the faster built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def by_bytes(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches in slices of about ``size`` bytes of ``column``; a longer row is a slice of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def id_lists(rows: list[bytes]) -> pa.ListArray:
    """Rows of little-endian 32-bit ids as an Arrow list column."""
    ends = np.cumsum([0, *map(len, rows)]) // 4
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(rows))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


class WordTable(dict):
    """Ids of words met before, as bytes; bounded by its size in bytes.

    When half the size is full, the words so far become the older half, and what was in that
    half and not asked for since is forgotten. Frequent words so stay, whatever number
    of rare ones comes between. Long words are encoded whenever they come and not kept.
    """

    def __init__(self, encode: Callable[[str], Iterable[int]], size: int = 96 << 20, longest: int = 1000) -> None:
        super().__init__()
        self.encode, self.size, self.longest, self.held = encode, size, longest, 0
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = array("i", self.encode(word)).tobytes()
        if len(word) <= self.longest:
            # An entry is a string, a bytes object and their place in the table.
            cost = 200 + 4 * len(word) + len(ids)
            if self.held + cost > self.size // 2:
                self.older = dict(self)
                self.clear()
                self.held = 0
            self[word] = ids
            self.held += cost
        return ids
