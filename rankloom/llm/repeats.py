"""Repeated byte strings by blockwise suffix sorting with a difference cover (operator 1).

A position starts a repeat if the ``length`` bytes from it also start elsewhere. Suffixes are compared to that depth only.
The positions i of a document with i mod 91 in a perfect difference cover are its sample: whatever the places of two equal
strings of 200 bytes, some offset below 91 puts both on sample positions, where 110 bytes or more are still equal.

1. Sample suffixes, cut at 110 bytes, are dealt to buckets, one bucket is sorted at a time, and equal ones get a tie mark. Only
   positions with a tied sample within reach can start a repeat: elsewhere no further suffix is built.
2. Long ties are settled in runs: anchors, positions chosen by the 16 bytes that follow, have their suffixes sorted at 200 bytes
   and the way to the next anchor. A tie there settles all positions from one anchor to the next.
3. The suffixes still open, near the ends of matches, and one copy of each settled one are sorted at 200 bytes.

A suffix is represented by the 64-bit hash of its prefix (in step 1 by its leading 5 bytes, 6 above some 30 GB and 7 above
10 TB, so that false ties, which cost only work, stay below one sample in 256), since equality at a fixed depth is all that is asked; so buckets hold numbers, not texts, and ties within a block of
texts are joined before they are dealt. Answers come back as bits per suffix and block. Buckets grow in number with the
input, so memory is bounded by block and bucket. Blocks are whole documents of one task, about ``BLOCK`` bytes; they are named by
their content, so a lost task that comes back with other rows is an error, not a wrong answer.

Defined cases: null texts are empty; texts shorter than the length start no repeat; repeated rows are documents, so they repeat each
other whole; null and repeated ids are kept row by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from rankloom.llm.common import by_size, parts, query, table
from rankloom.llm.words import Hasher
from rankloom.storage import scratch_path

#: A perfect difference cover: each number from 1 to 90 is the difference of one pair, mod 91. Fixed values.
COVER = (0, 1, 3, 9, 27, 49, 56, 61, 77, 81)
PERIOD = 91
BLOCK = 3_000_000
#: Bytes that choose an anchor, one place in how many is one, and the farthest that one settles.
ANCHOR, EVERY, WAY = 16, 64, 512
#: Bytes of a hash that are dealt for anchors and open suffixes; and the fewest for samples, of which larger inputs need more.
FULL, LEAST = 8, 5
#: Bytes of hashes that a bucket should hold on average.
BUCKET = 16_000_000


def packed(a: np.ndarray) -> bytes:
    return zstandard.compress(a.tobytes(), 3)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.uint8)


def steps(hashes: np.ndarray, width: int) -> bytes:
    """Sorted hashes, of which the leading ``width`` bytes are given, as their differences by byte place: small and exact."""
    lead = hashes >> np.uint64(64 - 8 * width)
    return packed(np.ascontiguousarray(np.diff(lead, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, :width].T))


def unstepped(data: bytes, width: int) -> np.ndarray:
    planes = unpacked(data).reshape(width, -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, :width] = planes.T
    return np.cumsum(whole.view(np.uint64).ravel(), dtype=np.uint64) << np.uint64(64 - 8 * width)


class Texts:
    """A block's bytes, the documents' bounds in it, and each byte's place in its document and bytes left from it."""

    def __init__(self, data: np.ndarray, sizes: list[int]) -> None:
        self.data, self.sizes = data, np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.place = np.arange(len(self.data), dtype=np.int32) - np.repeat(self.starts, self.sizes).astype(np.int32)
        self.left = np.repeat(self.sizes, self.sizes).astype(np.int32) - self.place
        self.sums: np.ndarray | None = None

    def hashes(self, at: np.ndarray, length: np.ndarray | int, hasher: Hasher) -> np.ndarray:
        if self.sums is None:
            self.sums = hasher.sums(self.data)
        return hasher.of(self.sums, at, at + length)


def sample_width(held: int) -> int:
    """Bytes of a sample's hash with which at most one sample in 256 is tied by chance, over so many bytes of text."""
    samples = max(1, held * len(COVER) // PERIOD)
    return min(FULL, max(LEAST, -(-(samples.bit_length() + 8) // 8)))


class Depths:
    """Which suffixes of a block are compared, how far, and by how many bytes of a hash per kind."""

    def __init__(self, length: int, width: int = LEAST) -> None:
        if length < PERIOD + 15:
            raise ValueError(f"repeats must be of {PERIOD + 15} bytes or more")
        self.repeat, self.sample = length, length - PERIOD + 1
        self.widths = (width, FULL, FULL)
        self.sieve = ~np.uint64((1 << (64 - 8 * width)) - 1)

    def samples(self, t: Texts, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the sample."""
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        at = np.flatnonzero(cover[t.place % PERIOD] & (t.left >= self.sample))
        return at, t.hashes(at, self.sample, hasher) & self.sieve

    def anchors(self, t: Texts, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions, ways to the next anchor (or ``WAY``), and hashes."""
        at = np.arange(max(0, len(t.data) - ANCHOR + 1))
        at = at[t.hashes(at, ANCHOR, hasher) % np.uint64(EVERY) == 0]
        at = at[t.left[at] >= ANCHOR]
        way = np.minimum(np.diff(np.append(at, len(t.data) + WAY)), WAY)
        fits = t.left[at] >= self.repeat + way
        at, way = at[fits], way[fits]
        return at, way, t.hashes(at, self.repeat + way, hasher)

    def possible(self, t: Texts, ties: np.ndarray) -> np.ndarray:
        """Whether a tied sample is in reach of each position."""
        reach = np.minimum(t.place[ties], PERIOD - 1).astype(np.int64)
        return covered(ties - reach, reach + 1, len(t.data)) & (t.left >= self.repeat)


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Places that lie in any of the stretches."""
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + lengths, n), -1)
    return np.cumsum(edges[:-1]) > 0


def bounds(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes; a bucket is an equal share of the 32 leading bits."""
    lows = (np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets)
    return np.append(np.searchsorted(sorted_hashes >> np.uint64(32), lows[:-1]), len(sorted_hashes))


def ties(rows: DataFrame, suffixes: Callable, buckets: int, widths: tuple[int, ...]) -> DataFrame:
    """(block, marks): for each block, per kind and bucket two bits for each distinct suffix: it stands elsewhere too; this block
    is the one that speaks for it.

    ``suffixes(batches, hasher)`` gives (block, [hashes of kind 0, of kind 1, ...]); ``widths`` bytes of each are dealt.
    """
    dealt = StructType([StructField("kind", IntegerType()), StructField("bucket", IntegerType()), StructField("block", LongType()),
                        StructField("hashes", BinaryType()), StructField("twice", BinaryType())])

    def deal(batches):
        hasher = Hasher()
        for block, kinds in suffixes(batches, hasher):
            for kind, hashes in kinds:
                h, times = np.unique(hashes, return_counts=True)
                at = bounds(h, buckets)
                some = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays([
                    pa.array([kind] * len(some), pa.int32()), pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()),
                    pa.array([steps(h[at[b]:at[b + 1]], widths[kind]) for b in some], pa.binary()),
                    pa.array([np.packbits(times[at[b]:at[b + 1]] > 1).tobytes() for b in some], pa.binary())], names=dealt.names)

    def sort(bucket: pa.Table) -> pa.Table:
        bucket = bucket.sort_by("block")  # so that a second run, after a loss, answers alike
        width = widths[bucket.column("kind")[0].as_py()]
        held = [unstepped(x, width) for x in bucket.column("hashes").to_pylist()]
        sizes, hashes = [len(x) for x in held], np.concatenate(held)
        order = np.argsort(hashes)
        same = hashes[order[1:]] == hashes[order[:-1]]
        tied, first = np.zeros(len(hashes), bool), np.ones(len(hashes), bool)
        tied[order[1:][same]] = tied[order[:-1][same]] = True
        first[order[1:][same]] = False
        at, out, leads = 0, [], []
        for n, twice in zip(sizes, bucket.column("twice").to_pylist(), strict=True):
            out.append(np.packbits(tied[at:at + n] | (np.unpackbits(np.frombuffer(twice, np.uint8), count=n) == 1)).tobytes())
            leads.append(np.packbits(first[at:at + n]).tobytes())
            at += n
        columns = [bucket.column("block"), bucket.column("kind"), bucket.column("bucket"), pa.array(out, pa.binary()), pa.array(leads, pa.binary())]
        return pa.table(columns, names=["block", "kind", "bucket", "bits", "first"])

    return rows.mapInArrow(deal, dealt).groupBy("kind", "bucket").applyInArrow(
        sort, "block long, kind int, bucket int, bits binary, first binary").groupBy("block").agg(
            F.array_sort(F.collect_list(F.struct("kind", "bucket", "bits", "first"))).alias("marks"))


def marked(hashes: np.ndarray, row: dict, kind: int, buckets: int, plane: str = "bits") -> np.ndarray:
    """A mark of each suffix of a block, from the bits per bucket."""
    distinct, number = np.unique(hashes, return_inverse=True)
    at, tied, known = bounds(distinct, buckets), np.zeros(len(distinct), bool), 0
    for mark in row["marks"] or ():
        if mark["kind"] == kind:
            low, high = at[mark["bucket"]], at[mark["bucket"] + 1]
            tied[low:high] = np.unpackbits(np.frombuffer(mark[plane], np.uint8), count=high - low)
            known += high - low
    if known != len(distinct):
        raise RuntimeError("a block's rows changed between two reads of the input; give documents in a stable order")
    return tied[number]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Blocks on disk in small row groups, as they were compressed."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("parquet.block.size", 16 << 20).option("compression", "uncompressed").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def find_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) per row; spans: start, end, start, end in bytes.

    ``docs`` are read twice and must come in the same order, as files do.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    held = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    depth, kind = Depths(length, sample_width(held)), rows.schema["id"].dataType
    buckets = max(4 * parts(spark), int(held * 8 * len(COVER) / PERIOD / BUCKET))
    result = StructType([StructField("id", kind), StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
                         StructField("n_spans", LongType()), StructField("kept_sha256", StringType()), StructField("spans", ArrayType(LongType()))])
    block_kind = StructType([StructField("block", LongType()), StructField("ids", ArrayType(kind)), StructField("sizes", ArrayType(LongType())),
                             StructField("data", BinaryType())])
    live_kind = StructType(block_kind.fields + [StructField("settled", BinaryType()), StructField("open", BinaryType()),
                                                StructField("done", ArrayType(result))])

    def blocks_of(batches):
        number = 0  # of the task, not of the batch: two batches of the same rows are two blocks
        for batch in batches:
            pairs = list(zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True))
            for part in by_size(pairs, lambda r: len(r[1]), BLOCK):
                data, sizes = b"".join(t for _, t in part), [len(t) for _, t in part]
                name = hashlib.blake2b(data, digest_size=8, salt=TaskContext.get().partitionId().to_bytes(8) + number.to_bytes(8))
                name.update(repr(sizes).encode())
                number += 1
                yield int.from_bytes(name.digest(), "big", signed=True), [i for i, _ in part], sizes, data

    def make_blocks(batches):
        for block, ids, sizes, data in blocks_of(batches):
            yield from frame(block_kind, [{"block": block, "ids": ids, "sizes": sizes, "data": packed(np.frombuffer(data, np.uint8))}])

    def first_suffixes(batches, hasher: Hasher):
        for block, _, sizes, data in blocks_of(batches):
            t = Texts(np.frombuffer(data, np.uint8), sizes)
            yield block, [(0, depth.samples(t, hasher)[1]), (1, depth.anchors(t, hasher)[2])]

    def narrow(batches):
        """Documents where a repeat can start go on, with the settled and the open positions; the others are done."""
        hasher = Hasher()
        for batch in batches:
            for row in batch.to_pylist():
                t = Texts(unpacked(row["data"]), row["sizes"])
                at, hashes = depth.samples(t, hasher)
                possible = depth.possible(t, at[marked(hashes, row, 0, buckets)])
                at, way, hashes = depth.anchors(t, hasher)
                tied = marked(hashes, row, 1, buckets)
                speaks = tied & marked(hashes, row, 1, buckets, "first")
                settled = covered(at[tied], way[tied], len(t.data))
                to_sort = (possible & ~settled) | covered(at[speaks], way[speaks], len(t.data))
                some = np.zeros(len(t.sizes), bool)
                some[np.searchsorted(t.ends, np.flatnonzero(settled | to_sort), "right")] = True
                done = [{"id": row["ids"][d], "n_bytes": int(t.sizes[d]), "n_removed": 0, "n_spans": 0, "spans": [],
                         "kept_sha256": hashlib.sha256(t.data[t.starts[d]:t.ends[d]].tobytes()).hexdigest()} for d in np.flatnonzero(~some)]
                keep = np.repeat(some, t.sizes)
                yield from frame(live_kind, [{
                    "block": row["block"], "ids": [i for i, on in zip(row["ids"], some, strict=True) if on], "sizes": t.sizes[some].tolist(),
                    "data": packed(t.data[keep]), "settled": packed(np.packbits(settled[keep])), "open": packed(np.packbits(to_sort[keep])), "done": done}])

    def last_suffixes(batches, hasher: Hasher):
        for batch in batches:
            for row in batch.to_pylist():
                t = Texts(unpacked(row["data"]), row["sizes"])
                yield row["block"], [(2, t.hashes(places(row["open"], t), depth.repeat, hasher))]

    def finish(batches):
        hasher = Hasher()
        for batch in batches:
            for row in batch.to_pylist():
                t = Texts(unpacked(row["data"]), row["sizes"])
                at = places(row["open"], t)
                found = at[marked(t.hashes(at, depth.repeat, hasher), row, 2, buckets)]
                gone = covered(np.concatenate([found, places(row["settled"], t)]), depth.repeat, len(t.data))
                out = []
                for i, a, b in zip(row["ids"], t.starts, t.ends, strict=True):
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
                    out.append({"id": i, "n_bytes": int(b - a), "n_removed": int(gone[a:b].sum()), "n_spans": len(edges) // 2,
                                "kept_sha256": hashlib.sha256(t.data[a:b][~gone[a:b]].tobytes()).hexdigest(), "spans": edges.tolist()})
                yield from frame(result, out)

    blocks = rows.mapInArrow(make_blocks, block_kind)
    staged_blocks = staged(blocks.join(ties(rows, first_suffixes, buckets, depth.widths), "block", "left").mapInArrow(narrow, live_kind), "repeat-blocks")
    live = staged_blocks.filter(F.size("ids") > 0).drop("done")
    found = live.join(ties(live.drop("ids", "settled"), last_suffixes, buckets, depth.widths), "block", "left").mapInArrow(finish, result)
    return found.unionByName(staged_blocks.select(F.explode("done").alias("d")).select("d.*")).withColumnRenamed("id", id_col)


def places(mask: bytes, t: Texts) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(unpacked(mask), count=len(t.data)))


def frame(schema: StructType, rows: list[dict]) -> list[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    return [pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in kinds], schema=kinds)] if rows else []


@query("op1_repeats")
def op1(spark, sf_dir):
    """Repeats of 200 bytes in all documents."""
    return find_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
