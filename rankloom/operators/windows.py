"""Per-team selection, recency and outlier operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from rankloom.functions import stats
from rankloom.functions.joins import join_on
from rankloom.storage import stage


def payload_order(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """All other columns, so that ties are broken alike on every run; what holds maps or variants has no order and goes by a hash of its text."""
    def key(field: StructField) -> Column:
        col, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        return F.xxhash64(F.to_json(F.struct(col))) if "map<" in kind or "variant" in kind else col

    return [key(f).asc_nulls_last() for f in df.schema if f.name not in used]


def newest_first(games: DataFrame) -> list[Column]:
    """Order of a team's games: date, then opponent and score, then all that is left."""
    first = ("date", "opponent_id_master", "gf", "ga")
    return [F.col("date").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in first[1:]], *payload_order(games, first)]


def recent_games(games: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """The ``limit`` newest games per key with ``game_index`` from 0.

    ``row_number() <= limit`` becomes a group limit on both sides of the
    shuffle, so a hot team sends at most ``limit`` rows per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first(games))
    return (
        games.withColumn("game_index", F.row_number().over(window))
        .where(F.col("game_index") <= limit)
        .withColumn("game_index", F.col("game_index") - 1)
    )


def with_days_since(games: DataFrame, as_of: Column) -> DataFrame:
    return games.withColumn("days_since", F.datediff(as_of, F.col("date")))


def clip_by_group(df: DataFrame, keys: Sequence[str], cols: Sequence[str], z: float) -> DataFrame:
    """Hold each value within z sample deviations of its group mean.

    Group statistics are pre-aggregated, staged and joined back, so that the
    rows of a hot group can be split. Groups of one row, or without spread, stay
    as they are.
    """
    measures = []
    for c in cols:
        measures += [F.avg(c).alias(f"_{c}_mean"), F.stddev_samp(c).alias(f"_{c}_std")]
    # Staged: a join with rows that are still being summed up cannot be split where one group is hot.
    bounds = stage(df.groupBy(*keys).agg(*measures), "group_bounds")
    joined = join_on(df, bounds, keys, "left")
    for c in cols:
        joined = joined.withColumn(c, stats.sigma_clip(F.col(c), F.col(f"_{c}_mean"), F.col(f"_{c}_std"), z))
    return joined.select(*df.columns)


def guard_outliers(selected: DataFrame, keys: Sequence[str], z: Column | float) -> DataFrame:
    """Clip goals of already selected games (a bounded number per key) in a window."""
    window = Window.partitionBy(*keys)
    for c in ("gf", "ga"):
        selected = selected.withColumn(
            c, stats.sigma_clip(F.col(c), F.avg(c).over(window), F.stddev_samp(c).over(window), z)
        )
    return selected


def decay_weights(selected: DataFrame, keys: Sequence[str], rate: float) -> DataFrame:
    """Exponential decay by game index, scaled to sum 1 per key."""
    raw = F.exp(F.lit(-rate) * F.col("game_index"))
    return selected.withColumn("weight", raw / F.sum(raw).over(Window.partitionBy(*keys)))


def last_activity(games: DataFrame, keys: Sequence[str], as_of: Column, inactive_days: int) -> DataFrame:
    """Last game date and whether it is recent enough to count as active."""
    return (
        games.groupBy(*keys).agg(F.max("date").alias("last_game_date"))
        .withColumn("is_active", F.datediff(as_of, F.col("last_game_date")) <= inactive_days)
    )


def newest_row(games: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Attributes as on the newest game of each key."""
    return recent_games(games, keys, 1).select(*keys, *cols)


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``, then under all other columns; limited before and after the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order, *payload_order(df, keys))
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
