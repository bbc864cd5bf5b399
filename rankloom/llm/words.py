"""Words, hashes and blocks of text as NumPy arrays, for functions that run over Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from rankloom.llm.common import by_size, give_back, text_bytes

#: Bytes of text that one NumPy step works on; a longer text is a step of its own.
BLOCK = 2_000_000


def map_texts(df: DataFrame, make: Callable[[], Callable], fields: StructType, text_col: str = "text") -> DataFrame:
    """``df`` with the columns of ``fields`` computed from its texts; they replace columns of the same name.

    ``make()`` runs once per task and gives a function from a list of UTF-8 texts to one list per field. Null is empty.
    """
    kept = [f for f in df.schema.fields if f.name not in fields.names]
    read = [f.name for f in kept] + ([text_col] if text_col in fields.names else [])
    schema = StructType(kept + fields.fields)
    kinds = [to_arrow_type(f.dataType) for f in fields.fields]

    def run(batches):
        work = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [t or b"" for t in batch.column(text_col).cast(pa.binary()).to_pylist()]
            done = [work(block) for block in by_size(texts, len, BLOCK)]
            new = [pa.array([v for part in done for v in part[i]], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + new, names=schema.names)
        del work
        give_back()

    return df.select(*[f"`{c}`" for c in read]).mapInArrow(run, schema)


class Hasher:
    """64-bit polynomial hashes of any byte range of an array, from one running sum."""

    STEP = np.uint64(0x9E3779B97F4A7C15)
    BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

    def __init__(self) -> None:
        self.letters = np.random.default_rng(20250101).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(0, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            for name, step in (("up", self.STEP), ("down", self.BACK)):
                powers = np.full(len(data) + 1, step, np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.up[:len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((sums[ends] - sums[starts]) * self.down[starts])


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits spread, so that any of them can choose a bucket."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_bytes(digits: bool = True) -> np.ndarray:
    """Which bytes belong to words: letters, every byte outside ASCII, digits if asked."""
    table = np.zeros(256, bool)
    table[65:91] = table[97:123] = table[128:] = True
    table[48:58] = digits
    return table


def word_ranges(data: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of member bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = member[data]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


class Block:
    """Texts of a step: lower-cased bytes, words, and the words of each text."""

    def __init__(self, texts: list[bytes], member: np.ndarray, hasher: Hasher) -> None:
        raw, self.starts = text_bytes(texts)
        self.data = lowered(raw)
        self.raw = raw
        self.begin, self.end = word_ranges(self.data, member)
        self.first = np.searchsorted(self.begin, self.starts)  # of each text, its first word; then the number of words
        self.hasher, self.sums = hasher, hasher.sums(self.data)
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return self.hasher.of(self.sums, self.begin, self.end)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)
