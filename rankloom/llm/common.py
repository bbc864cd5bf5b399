"""Registration of this package's queries and helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where DuckDB can express it, its SQL counterpart."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    """Shuffle partitions of the session, which set how finely work is dealt."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 4; 2 is held out. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_bytes(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each followed by a zero byte, and where each starts (one more entry for the end)."""
    starts = np.zeros(len(chunks) + 1, np.int64)
    np.cumsum([len(c) + 1 for c in chunks], out=starts[1:])
    joined = b"\0".join(chunks) + b"\0" if chunks else b""
    return np.frombuffer(joined, np.uint8), starts


def by_size(rows: Iterator[tuple], size: Callable[[tuple], int], limit: int) -> Iterator[list[tuple]]:
    """Consecutive rows in blocks of about ``limit`` bytes; a row larger than that is a block of its own."""
    block, held = [], 0
    for row in rows:
        if block and held + size(row) > limit:
            yield block
            block, held = [], 0
        block.append(row)
        held += size(row)
    if block:
        yield block


def by_bytes(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes in a text column; a row larger than that is a slice of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Python workers live on and would keep it through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
