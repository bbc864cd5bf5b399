"""Detecting changed game records by content hash."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields a game's hash is made of, in order.
HASH_FIELDS = ("team_id_source", "opponent_id", "game_date", "goals_for", "goals_against", "home_away")


def content_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of ``field:value`` parts joined by a bar; NULL stands for a missing value."""
    parts = [
        F.concat(F.lit(f"{c}:"), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
        for c in HASH_FIELDS if c in columns
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)


def game_key(with_opponent: bool = False) -> Column:
    """Id of a game: team and date, optionally the opponent (two games on a day then differ)."""
    parts = [F.lit("game"), F.coalesce("team_id_source", F.lit("unknown")),
             F.coalesce(F.col("game_date").cast("string"), F.lit("unknown"))]
    if with_opponent:
        parts.append(F.coalesce("opponent_id", F.lit("unknown")))
    return F.concat_ws("_", *parts)


def hash_games(
    games: DataFrame, slice_cols: Sequence[str] = (), with_opponent: bool = False
) -> DataFrame:
    """(slice columns, game_id, game_hash): one per id, the largest hash where several games share an id."""
    return games.select(
        *slice_cols, game_key(with_opponent).alias("game_id"), content_hash(games.columns).alias("game_hash")
    ).groupBy(*slice_cols, "game_id").agg(F.max("game_hash").alias("game_hash"))


def diff_hashes(stored: DataFrame, current: DataFrame, slice_cols: Sequence[str] = ()) -> DataFrame:
    """Status of every game id on either side: unchanged, modified, deleted or new. A missing slice is a slice."""
    keys = [*slice_cols, "game_id"]
    old = stored.select(*keys, F.col("game_hash").alias("_old"))
    new = current.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("game_hash").alias("_new"))
    status = (
        F.when(F.col("_new").isNull(), "deleted").when(F.col("_old").isNull(), "new")
        .when(F.col("_old") != F.col("_new"), "modified").otherwise("unchanged")
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    side = F.col("_new").isNull()
    return old.join(new, same, "full").select(
        *[F.when(side, F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys], status.alias("status"))


def integrity_report(diff: DataFrame, slice_cols: Sequence[str] = ()) -> DataFrame:
    """Counts, score and refresh flag per slice.

    Refresh when over 5 % of the stored games changed, any game vanished, or the
    score is under 95. A slice with nothing stored scores 0 and needs a refresh.
    """
    def n(*kinds: str) -> Column:
        return F.count_if(F.col("status").isin(*kinds))

    counts = diff.groupBy(*slice_cols).agg(
        n("modified").alias("modified"), n("deleted").alias("deleted"), n("new").alias("new"),
        n("unchanged").alias("unchanged"), n("unchanged", "modified", "deleted").alias("total_stored"),
        n("unchanged", "modified", "new").alias("total_current"), F.count("*").alias("_all"),
    )
    raw = F.when(F.col("total_stored") == 0, 0.0).otherwise(F.col("unchanged") * 100.0 / F.col("_all"))
    return counts.withColumn("_score", raw).select(
        *slice_cols, "modified", "deleted", "new", "total_stored", "total_current",
        F.round("_score", 2).alias("integrity_score"),
        ((F.col("total_stored") == 0) | (F.col("modified") > F.col("total_stored") * 0.05)
         | (F.col("deleted") > 0) | (F.col("_score") < 95.0)).alias("needs_refresh"),
    )


def integrity_rollup(report: DataFrame) -> DataFrame:
    """One row over slices: how many need a refresh and the mean score (100 without slices)."""
    return report.agg(
        F.count("*").alias("total_slices"), F.count_if("needs_refresh").alias("slices_needing_refresh"),
        F.coalesce(F.round(F.avg("integrity_score"), 2), F.lit(100.0)).alias("overall_score"),
    )
