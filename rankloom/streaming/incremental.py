"""Incremental jobs on Structured Streaming: append without repeats, tamper check, running totals.

What is known per team is kept by ``streaming.state``. Here each batch writes a
folder named by its number, so a repeated batch overwrites its own rows and
results are the same after a failure.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.operators.digests import check_batch
from rankloom.operators.integrity import hash_games
from rankloom.operators.windows import best_row
from rankloom.sources.files import list_paths
from rankloom.storage import stage
from rankloom.streaming.state import run_progress  # noqa: F401 - one of the jobs here, kept with its state

#: Days of one batch that are named to prune the stored partitions; a batch with more reads them all.
MAX_DAYS = 400


def game_stream(spark: SparkSession, folder: str, schema: T.StructType, file_filter: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process all that is available, batch by batch, then stop."""
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(each).start()
    )
    query.awaitTermination()


class VersionedTable:
    """A small table kept as ``<root>/v<batch>`` folders."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root, schema

    def before(self, batch: int | None = None) -> DataFrame:
        """Newest version (below ``batch`` if given), or an empty table."""
        numbers = [int(p.rsplit("/v", 1)[1].split("/")[0]) for p in list_paths(self.spark, f"{self.root}/v*/_SUCCESS")]
        done = [n for n in numbers if batch is None or n < batch]
        if not done:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/v{max(done):012d}")

    def write(self, df: DataFrame, batch: int) -> None:
        df.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/v{batch:012d}")


# ---------------------------------------------------------------- append with dedupe

def run_deduped(stream: DataFrame, folder: str, day_col: str, keys: Sequence[str]) -> DataFrame:
    """Append the stream's rows whose ``keys`` are not stored yet, however late they come.

    ``day_col`` is one of the keys; stored rows are partitioned by it, and only
    the days of a batch are read again. A repeated batch overwrites its own rows.
    """
    spark, out = stream.sparkSession, f"{folder}/games"
    part = "_day"

    def stored(number: int | None = None) -> DataFrame | None:
        done = [p for p in list_paths(spark, f"{out}/batch=*") if number is None or int(p.rstrip("/").rsplit("=", 1)[1]) < number]
        return spark.read.schema(f"`{part}` string, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)).option(
            "basePath", out).parquet(*done) if done else None

    def each(batch: DataFrame, number: int) -> None:
        fresh = stage(best_row(batch, keys, []).withColumn(part, F.coalesce(F.col(day_col).cast("string"), F.lit("none"))), "fresh-games")
        before = stored(number)
        if before is not None:
            days = [r[0] for r in fresh.select(part).distinct().limit(MAX_DAYS + 1).collect()]
            if len(days) <= MAX_DAYS:
                before = before.where(F.col(part).isin(days))
            same = reduce(and_, [fresh[k].eqNullSafe(before[k]) for k in [part, *keys]])
            fresh = fresh.join(before, same, "left_anti")
        fresh.write.partitionBy(part).mode("overwrite").parquet(f"{out}/batch={number}")

    run_batches(stream, each, f"{folder}/offsets")
    games = stored()
    return spark.createDataFrame([], stream.schema) if games is None else games.select(*stream.columns)


# ---------------------------------------------------------------- tamper check

def run_integrity(stream: DataFrame, store: str, folder: str, slice_cols: Sequence[str] = (),
                  with_opponent: bool = False) -> DataFrame:
    """Status of each arriving game against the hash store (``operators.digests``), of which a batch reads the leaves it touches.

    Deletions need the full picture and are not judged.
    """
    out = f"{folder}/status"

    def each(batch: DataFrame, number: int) -> None:
        check_batch(hash_games(batch, slice_cols, with_opponent), store, slice_cols).write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_batches(stream, each, f"{folder}/offsets")
    return stream.sparkSession.read.parquet(out).drop("batch")


# ---------------------------------------------------------------- running totals

def run_totals(stream: DataFrame, folder: str, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Totals per key, rewritten in full after each batch."""
    totals = stream.groupBy(*keys).agg(*measures)
    table = VersionedTable(stream.sparkSession, f"{folder}/totals", totals.schema)
    run_batches(totals, table.write, f"{folder}/offsets", mode="complete")
    return table.before()
