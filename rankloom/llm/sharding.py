"""Minimax contiguous sharding (operator 7).

Groups (equal texts) are atomic and ordered by a 64-bit hash of the text. The smallest capacity is sought for which
filling shard after shard with whole groups needs no more than the wanted number of shards. The groups never come to the
driver: it sees sums of ranges of the order, 4096 per step. Ranges taken as whole give a capacity that suffices, ranges
taken as divisible one that is needed; only ranges in which a cut can lie between the two are opened further, until every
cut lies between single groups. Then the cuts are as if all groups had been walked one by one.

Slots number the rows of a shard from 0 without gaps: rows are dealt by a hash of the row to bins, counted per shard and
bin, and numbered within their bin, so no task holds a shard. The texts are read once and never shuffled.

Defined cases: a null text has size 1 and belongs to the group of the empty text; repeated rows and null ids are placed
like any other row; with fewer groups than shards some shards stay empty; a group larger than a fair share sets the
capacity, and the other groups spread over the other shards; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import parts, query, table
from rankloom.storage import stage

#: Bits of the order that each step opens, and the shifts of the steps.
SHIFTS = (52, 40, 28, 16, 4, 0)


def cuts(sizes: np.ndarray, shards: int, capacity: int, whole: np.ndarray) -> np.ndarray | None:
    """Where each shard ends when it takes ranges from the left up to ``capacity``: reached sums, or None if not all fit.

    A range that is not ``whole`` may be divided anywhere.
    """
    ends = np.concatenate([[0], np.cumsum(sizes)])
    reached, out = 0, []
    for _ in range(shards):
        at = int(np.searchsorted(ends, reached + capacity, "right")) - 1
        to = int(ends[at])
        if at < len(sizes) and not whole[at]:
            to = max(to, reached + capacity)
        reached = min(max(to, reached), int(ends[-1]))
        out.append(reached)
    return np.array(out) if reached == ends[-1] else None


def least_capacity(sizes: np.ndarray, shards: int, whole: np.ndarray) -> int:
    low, high = -(-int(sizes.sum()) // shards), int(sizes.sum())
    while low < high:
        mid = (low + high) // 2
        if cuts(sizes, shards, mid, whole) is None:
            low = mid + 1
        else:
            high = mid
    return high


def balanced(sizes: np.ndarray, shards: int, capacity: int) -> np.ndarray:
    """Where each shard ends: near an even share of what is left, within a capacity that suffices.

    Ranges above the mean count for a shard of their own, the others share the rest. A cut moves towards its share only while the
    shards behind it can still take what is left, and every shard takes a range while there is one.
    """
    ends = np.concatenate([[0], np.cumsum(sizes)])
    total = int(ends[-1])
    hot = sizes * shards > total
    hot_bytes, hot_count = np.concatenate([[0], np.cumsum(sizes * hot)]), np.concatenate([[0], np.cumsum(hot)])
    least = [total]  # from the last shard back: how far the shards before must reach at least
    for _ in range(shards - 1):
        least.append(int(ends[np.searchsorted(ends, least[-1] - capacity, "left")]))
    least.reverse()
    reached, out = 0, []
    for k in range(shards):
        done = int(np.searchsorted(ends, reached, "right")) - 1  # ranges in earlier shards
        if done < len(sizes):
            rest = total - reached - int(hot_bytes[-1] - hot_bytes[done])
            want = reached + rest / max(1, shards - k - int(hot_count[-1] - hot_count[done]))
            at = int(np.searchsorted(ends, want, "left"))
            if at > 0 and (at == len(ends) or ends[at] - want > want - ends[at - 1]):
                at -= 1
            farthest = int(ends[np.searchsorted(ends, reached + capacity, "right") - 1])
            reached = min(max(int(ends[max(at, done + 1)]), least[k]), farthest)
        out.append(reached)
    return np.array(out)


def minimax_cuts(groups: DataFrame, shards: int) -> list[int]:
    """Keys at which shards 1, 2, ... begin; ``groups`` has rows of key long and size, a key in one or more rows."""
    ranges: list[tuple[int, int, bool]] = []  # first key, size, single group

    def opened(shift: int, above: int | None, inside: list[int]) -> list[tuple[int, int, bool]]:
        rows = groups if above is None else groups.filter(F.shiftright("key", above).isin(inside))
        return sorted((r["lo"], r["size"], r["lo"] == r["hi"]) for r in rows.groupBy(
            F.shiftright("key", shift)).agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum("size").alias("size")).collect())

    for step, shift in enumerate(SHIFTS):
        if not step:
            ranges = opened(shift, None, [])
        else:
            ranges = sorted([r for i, r in enumerate(ranges) if i not in wide] + opened(
                shift, SHIFTS[step - 1], sorted({ranges[i][0] >> SHIFTS[step - 1] for i in wide})))
        if not ranges:
            return []
        sizes = np.array([r[1] for r in ranges], np.int64)
        single = np.array([r[2] for r in ranges])
        every = np.ones(len(ranges), bool)
        enough, needed = least_capacity(sizes, shards, every), least_capacity(sizes, shards, single)
        most = cuts(sizes, shards, enough, single)
        # With the needed capacity and whole ranges the shards reach at least this far; they may not reach the end.
        ends, least, reached = np.concatenate([[0], np.cumsum(sizes)]), [], 0
        for _ in range(shards):
            reached = max(reached, int(ends[np.searchsorted(ends, reached + needed, "right") - 1]))
            least.append(reached)
        wide = {i for a, b in zip(least, most, strict=True) for i in range(
            int(np.searchsorted(ends, a, "right")) - 1, min(len(ranges), int(np.searchsorted(ends, b, "left")) + 1)) if not single[i]}
        if not wide or shift == 0:
            done = balanced(sizes, shards, enough)
            return [ranges[i][0] for i in np.searchsorted(ends, done[:-1]) if i < len(ranges)]
    raise AssertionError("the last step opens single keys")


def numbered(rows: DataFrame, shards: int, order: list[str]) -> DataFrame:
    """``rows`` (with shard) and slot: 0, 1, ... within the shard. Counts per shard and bin are few: shards x bins."""
    bins = parts(rows.sparkSession)
    rows = rows.withColumn("bin", F.pmod(F.xxhash64(*order), F.lit(bins)).cast("int"))
    counts = sorted((r["shard"], r["bin"], r["count"]) for r in rows.groupBy("shard", "bin").count().collect())
    before, table_rows = dict.fromkeys(range(shards), 0), []
    for shard, number, count in counts:
        table_rows.append((shard, number, before[shard]))
        before[shard] += count
    offsets = rows.sparkSession.createDataFrame(table_rows, "shard int, bin int, before long")
    within = Window.partitionBy("shard", "bin").orderBy(*order)
    return rows.withColumn("nth", F.row_number().over(within)).join(F.broadcast(offsets), ["shard", "bin"]).withColumn(
        "slot", F.col("before") + F.col("nth") - 1).drop("bin", "nth", "before")


def shard_by_bytes(docs: DataFrame, shards: int = 8, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, size, text_crc32, key, shard, slot): near-equal bytes per shard, equal texts together."""
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    slim = stage(docs.select(F.col(id_col), (F.octet_length(data) + 1).cast("long").alias("size"),
                             F.crc32(data).alias("text_crc32"), F.xxhash64(data).alias("key")), "shard-sizes")
    begins = minimax_cuts(slim.select("key", "size"), shards)
    shard = sum([(F.col("key") >= b).cast("int") for b in begins], F.lit(0))
    return numbered(slim.withColumn("shard", shard), shards, [id_col, "key", "size"])


@query("op7_minimax_shards")
def op7(spark, sf_dir):
    """All documents in 8 shards by the law ``bytes``."""
    rows = shard_by_bytes(table(spark, sf_dir, "documents"), 8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))
