"""A game store by day that appends without reading or rewriting what it does not have to.

Rows lie in one folder per day (or per longer ``period``, where days are small). Beside them lies a Bloom filter per folder, in blocks: a key belongs to one block of 32,768 bits and
sets ``BITS`` of them, so a key is looked up in one row of the filter table. New rows whose key the filter does not know
are surely new and are appended as they are. The others, repeats and the few that the filter takes for repeats, meet the stored
rows of their day in an exact join; only days in which a stored row gives way to a newer one are written again, by
dynamic partition overwrite, and all other folders keep their files.

The filter is extended before rows are written. A run that is lost in between leaves a filter that knows more than is stored,
which costs an exact join at the next try and nothing else, so an append that is repeated stores every game once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions.joins import join_on
from rankloom.operators.windows import best_row
from rankloom.sources.files import list_paths
from rankloom.storage import stage

#: Bits of a block (what a bitmap aggregate holds), bits set per key, blocks of a day, and the folder of rows without a day.
BLOCK_BITS, BITS, BLOCKS, NO_DAY = 32_768, 4, 16, "none"


def _folder(col: str, period: str) -> Column:
    """First day of the period a day is in, as text."""
    return F.coalesce(F.date_format(F.date_trunc(period, col), "yyyy-MM-dd"), F.lit(NO_DAY))


def _block(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BLOCKS)).cast("int")


def _positions(keys: Sequence[str]) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(BLOCK_BITS)) for i in range(BITS)])


def bloom_filter(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_day, block, bitmap) of rows with ``_day``."""
    return rows.select("_day", _block(keys).alias("block"), F.explode(_positions(keys)).alias("_at")).groupBy("_day", "block").agg(
        F.bitmap_construct_agg("_at").alias("bitmap"))


def merged(*filters: DataFrame) -> DataFrame:
    """One filter that knows what each of them knows."""
    both = filters[0]
    for other in filters[1:]:
        both = both.unionByName(other)
    return both.groupBy("_day", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _known(bitmap: Column, positions: Column) -> Column:
    """Whether all bits of a key are set; false without a bitmap."""
    def bit(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (at % 8).cast("int")) == 1
    return F.coalesce(F.forall(positions, bit), F.lit(False))


class GameStore:
    """Games under a folder, unique by ``keys``; of repeats the one with the largest ``newest`` stays."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType | str, keys: Sequence[str], day: str, newest: str,
                 period: str = "day") -> None:
        if day not in keys:
            raise ValueError("the day must be one of the keys: repeats lie in one folder")
        self.spark, self.folder = spark, folder
        self.none = spark.createDataFrame([], schema)
        self.keys, self.newest, self.folder_of = list(keys), newest, _folder(day, period).alias("_day")

    def read(self, days: Sequence[str] | None = None) -> DataFrame:
        """All games, or those of some days, from their folders alone."""
        found = list_paths(self.spark, f"{self.folder}/games/_day=*")
        if days is not None:
            wanted = {f"_day={d}" for d in days}
            found = [p for p in found if p.rstrip("/").rsplit("/", 1)[1] in wanted]
        if not found:
            return self.none
        return self.spark.read.schema(self.none.schema).option("basePath", f"{self.folder}/games").parquet(*found).select(*self.none.columns)

    def _filter(self, days: Sequence[str]) -> DataFrame | None:
        """The filter of some days; none where nothing was ever stored in them."""
        wanted = {f"_day={d}" for d in days}
        found = [p for p in list_paths(self.spark, f"{self.folder}/filter/_day=*") if p.rstrip("/").rsplit("/", 1)[1] in wanted]
        if not found:
            return None
        return self.spark.read.schema("_day string, block int, bitmap binary").option("basePath", f"{self.folder}/filter").parquet(*found)

    def _extend(self, before: DataFrame | None, fresh: DataFrame) -> None:
        """Have the filter know ``fresh`` too. Days without a fresh key keep their filter: keys it takes for known add no bit."""
        added = bloom_filter(fresh, self.keys)
        if before is not None:
            days = [r["_day"] for r in fresh.select("_day").distinct().collect()]
            added = stage(merged(before.where(F.col("_day").isin(days)), added), "store-filter")
        self._write(added, "filter", "overwrite")

    def _write(self, rows: DataFrame, table: str, mode: str) -> None:
        """Rows by day; overwriting touches the days of ``rows`` alone."""
        rows.hint("rebalance", "_day").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("_day").parquet(f"{self.folder}/{table}")

    def append(self, new: DataFrame) -> dict[str, int]:
        """Add games; returns how many were surely new, were compared, and how many days were written again."""
        names, newest = self.none.columns, [F.col(self.newest).desc_nulls_last()]
        # Dealt by key before they are numbered: games hardly repeat, so a limit ahead of the shuffle would sort every row for nothing.
        rows = stage(best_row(new.repartition(*self.keys), self.keys, newest).select(*names, self.folder_of), "store-new")
        days = [r["_day"] for r in rows.select("_day").distinct().collect()]  # bounded by the calendar
        before = self._filter(days)
        if before is None:
            asked = rows.withColumn("_maybe", F.lit(False))
        else:
            looked = join_on(rows.withColumn("block", _block(self.keys)), before, ["_day", "block"], "left")
            asked = stage(looked.withColumn("_maybe", _known(F.col("bitmap"), _positions(self.keys))).select(*names, "_day", "_maybe"), "store-asked")
        self._extend(before, asked.where("NOT _maybe"))
        maybe = asked.where("_maybe").drop("_maybe")
        seen_days = [r["_day"] for r in maybe.select("_day").distinct().collect()]
        fresh, again, compared = asked.where("NOT _maybe").drop("_maybe"), [], 0
        if seen_days:
            stored = self.read(seen_days).select(*self.keys, F.col(self.newest).alias("_stored"), F.lit(True).alias("_there"))
            met = stage(join_on(maybe, stored, self.keys, "left"), "store-met")
            compared = met.count()
            newer = F.col("_there") & F.coalesce(F.col(self.newest) > F.col("_stored"), F.col(self.newest).isNotNull() & F.col("_stored").isNull())
            replaced = met.where(newer).drop("_stored", "_there")
            again = [r["_day"] for r in replaced.select("_day").distinct().collect()]
            fresh = fresh.unionByName(met.where("_there IS NULL").drop("_stored", "_there"))
        if again:
            # Days that are written again take their fresh rows along. Stored keys are unique and so are new ones, so what is not
            # replaced stays as it is. Spark moves the new files in after all stored ones were read.
            gone = join_on(self.read(again).select("*", self.folder_of), replaced.select(*self.keys, F.lit(True).alias("_gone")), self.keys, "left")
            whole = gone.where("_gone IS NULL").drop("_gone").unionByName(replaced).unionByName(fresh.where(F.col("_day").isin(again)))
            self._write(whole, "games", "overwrite")
            fresh = fresh.where(~F.col("_day").isin(again))
        self._write(fresh, "games", "append")
        return {"new": asked.where("NOT _maybe").count(), "compared": compared, "days_rewritten": len(again)}
