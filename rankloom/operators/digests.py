"""Digest tree over stored game hashes: only the leaves that differ are compared game by game.

A game falls into a leaf by a hash of its id. A leaf's digest is the number of its games and the sums of four 60-bit pieces
of SHA-256 over id and content, so it can be summed in any order, added up to the digest of a coarser prefix, and updated by
adding what came and subtracting what went. A store keeps the game hashes in one folder per leaf and the leaf digests beside
them. Comparing a build with it reads the stored digests from the top down, first whole slices, then ever longer prefixes
of those that differ, and opens the folders of differing leaves alone; the build itself is hashed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.joins import join_on
from rankloom.operators.integrity import diff_hashes
from rankloom.sources.files import list_paths
from rankloom.storage import stage

#: Bits of a leaf's number, and how many of them each step of the comparison looks at.
LEAF_BITS, STEPS = 8, (0, 4, 8)
PIECES = ("d0", "d1", "d2", "d3")


def leaf_number(game_id: str = "game_id") -> Column:
    return F.shiftrightunsigned(F.xxhash64(game_id), 64 - LEAF_BITS).cast("int")


def leaf_digests(hashes: DataFrame, slice_cols: Sequence[str]) -> DataFrame:
    """(slice columns, leaf, n, d0 .. d3) of rows (slice columns, leaf, game_id, game_hash)."""
    code = F.sha2(F.concat_ws(":", F.octet_length("game_id").cast("string"), "game_id", "game_hash"), 256)
    pieces = [F.conv(F.substring(code, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(len(PIECES))]
    return hashes.groupBy(*slice_cols, "leaf").agg(
        F.count("*").alias("n"), *[F.sum(p).cast("decimal(38,0)").alias(name) for name, p in zip(PIECES, pieces, strict=True)])


def rolled_up(digests: DataFrame, slice_cols: Sequence[str], bits: int) -> DataFrame:
    """Digests of prefixes of ``bits`` bits, as column ``prefix``; none is the whole slice."""
    prefix = F.shiftright("leaf", LEAF_BITS - bits).alias("prefix")
    return digests.groupBy(*slice_cols, prefix).agg(F.sum("n").alias("n"), *[F.sum(p).cast("decimal(38,0)").alias(p) for p in PIECES])


def differing(stored: DataFrame, current: DataFrame, slice_cols: Sequence[str]) -> DataFrame:
    """(slice columns, leaf) whose digests differ or that one side lacks, found from whole slices down to leaves."""
    keys = [*slice_cols, "prefix"]
    found = None
    for bits in STEPS:
        sides = []
        for digests in (stored, current):
            if found is not None:
                above = F.shiftright("leaf", LEAF_BITS - found[0])
                kept = join_on(digests.withColumn("prefix", above), found[1].withColumn("_open", F.lit(True)), keys)
                digests = kept.drop("_open", "prefix")
            sides.append(rolled_up(digests, slice_cols, bits))
        # One side's sums are negative: prefixes that agree cancel out, and nothing has to be joined.
        minus = sides[0].select(*keys, F.lit(1).alias("old"), F.lit(0).alias("new"), *[(-F.col(c)).alias(c) for c in ("n", *PIECES)])
        plus = sides[1].select(*keys, F.lit(0).alias("old"), F.lit(1).alias("new"), "n", *PIECES)
        sums = minus.unionByName(plus).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("old", "new", "n", *PIECES)])
        same = (F.col("old") == F.col("new")) & (F.col("n") == 0)
        for p in PIECES:
            same = same & (F.col(p) == 0)
        found = (bits, stage(sums.where(~same).select(*keys), f"digests-{bits}"))
    return found[1].withColumnRenamed("prefix", "leaf")


def write_store(hashes: DataFrame, folder: str, slice_cols: Sequence[str] = ()) -> None:
    """Store game hashes, one folder per leaf, and the digests of the leaves."""
    rows = stage(hashes.select(*slice_cols, "game_id", "game_hash", leaf_number().alias("leaf")), "hash-rows")
    rows.repartition("leaf").sortWithinPartitions("leaf", *slice_cols, "game_id").write.partitionBy("leaf").mode("overwrite").parquet(f"{folder}/rows")
    leaf_digests(rows, slice_cols).write.mode("overwrite").parquet(f"{folder}/digests")


def stored_rows(spark: SparkSession, folder: str, leaves: Sequence[int], schema) -> DataFrame:
    """Stored hashes of the given leaves; no other folder is opened."""
    there = set(list_paths(spark, f"{folder}/rows/leaf=*"))
    paths = [p for p in sorted(there) if int(p.rstrip("/").rsplit("=", 1)[1]) in set(leaves)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{folder}/rows").parquet(*paths)


def diff_store(current: DataFrame, folder: str, slice_cols: Sequence[str] = ()) -> DataFrame:
    """Status of every game id of ``current`` hashes or of the store, as ``diff_hashes`` gives it.

    Games of leaves with equal digests are unchanged; their stored rows are not read.
    """
    spark, keys = current.sparkSession, list(slice_cols)
    now = stage(current.select(*keys, "game_id", "game_hash", leaf_number().alias("leaf")), "hash-rows")
    digests = leaf_digests(now, keys)
    stored = spark.read.schema(digests.schema).parquet(f"{folder}/digests")
    open_leaves = differing(stored, digests, keys)
    numbers = [r["leaf"] for r in open_leaves.select("leaf").distinct().collect()]  # 2^LEAF_BITS at most
    rows = stored_rows(spark, folder, numbers, now.schema)
    marks = open_leaves.withColumn("_open", F.lit(True))
    marked = join_on(now, marks, [*keys, "leaf"], "left")
    old = join_on(rows, marks, [*keys, "leaf"]).drop("_open", "leaf")
    changed = diff_hashes(old, marked.where("_open").drop("_open", "leaf"), keys)
    return changed.unionByName(marked.where("_open IS NULL").select(*keys, "game_id", F.lit("unchanged").alias("status")))


def check_batch(batch: DataFrame, folder: str, slice_cols: Sequence[str] = ()) -> DataFrame:
    """Status of the games of a batch against the store: new, modified or unchanged; only leaves that the batch touches are read."""
    spark, keys = batch.sparkSession, [*slice_cols, "game_id"]
    now = stage(batch.select(*keys, "game_hash", leaf_number().alias("leaf")), "hash-rows")
    numbers = [r["leaf"] for r in now.select("leaf").distinct().collect()]  # 2^LEAF_BITS at most
    old = stored_rows(spark, folder, numbers, now.schema).withColumnRenamed("game_hash", "_old").drop("leaf")
    status = F.when(F.col("_old").isNull(), "new").when(F.col("_old") != F.col("game_hash"), "modified").otherwise("unchanged")
    return join_on(now, old, keys, "left").select(*keys, status.alias("status"))
