"""Build history: trends, comparisons, latest builds, retention."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.operators.ordering import ranked
from rankloom.storage import stage

BUILD_TIME = "yyyyMMdd_HHmm"


def build_time(build_id: Column) -> Column:
    """Timestamp in a name like ``build_20251017_0932``; null when there is none."""
    return F.try_to_timestamp(F.regexp_extract(build_id, "([0-9]{8}_[0-9]{4})", 1), F.lit(BUILD_TIME))


def metadata_summary(entries: DataFrame) -> DataFrame:
    """One row: latest build and the range of teams, states and quality over all builds."""
    def latest(c: str) -> Column:
        return F.max_by(c, "timestamp")

    measures = []
    for c, name in (("teams_total", "teams"), ("states_total", "states"), ("data_quality", "quality")):
        measures += [latest(c).alias(f"latest_{name}"), F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}"),
                     F.avg(c).alias(f"avg_{name}")]
    return entries.agg(
        F.count("*").alias("total_builds"), F.max("timestamp").alias("latest_timestamp"), *measures,
        (latest("teams_total") - F.min_by("teams_total", "timestamp")).alias("team_growth"),
    )


def history_summary(entries: DataFrame) -> DataFrame:
    """One row: latest build, summed changes, mean duration, number of build types."""
    def latest(c: str) -> Column:
        return F.max_by(c, "timestamp")

    return entries.agg(
        F.count("*").alias("total_builds"), latest("teams_total").alias("latest_teams"),
        latest("states_covered").alias("latest_states"), F.sum("added").alias("total_added"),
        F.sum("removed").alias("total_removed"), F.sum("renamed").alias("total_renamed"),
        F.max("timestamp").alias("latest_timestamp"),
        (F.sum("duration_seconds") / F.count("*")).alias("avg_duration"),
        F.countDistinct("build_type").alias("build_types"),
    )


def compare_metrics(metrics: DataFrame, build1: Column | str, build2: Column | str) -> DataFrame:
    """One row: change of team count, states, duration and quality from build1 to build2."""
    first = metrics.where(F.col("build_id") == build1).alias("a")
    second = metrics.where(F.col("build_id") == build2).alias("b")

    def change(c: str) -> Column:
        return F.max(F.when(F.col("side") == 2, F.col(c))) - F.max(F.when(F.col("side") == 1, F.col(c)))

    both = first.withColumn("side", F.lit(1)).unionByName(second.withColumn("side", F.lit(2)))
    return both.agg(
        F.max(F.when(F.col("side") == 1, F.col("build_id"))).alias("build1"),
        F.max(F.when(F.col("side") == 2, F.col("build_id"))).alias("build2"),
        change("team_count").alias("team_count_change"), change("states_covered").alias("states_change"),
        F.max(F.when(F.col("side") == 2, F.col("new_teams"))).alias("new_teams"),
        change("build_duration_seconds").alias("build_duration_change"),
        change("data_quality_score").alias("data_quality_change"),
    )


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """One row: latest and earliest build, range of team counts, states and durations."""
    measures = []
    for c, name in (("team_count", "teams"), ("states_covered", "states"), ("build_duration_seconds", "duration")):
        measures += [F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}"), F.avg(c).alias(f"avg_{name}"),
                     F.max_by(c, "build_id").alias(f"latest_{name}")]
    return metrics.agg(
        F.count("*").alias("total_builds"), F.max("build_id").alias("latest_build"),
        F.min("build_id").alias("earliest_build"), *measures,
    )


def latest_builds(files: DataFrame) -> DataFrame:
    """Newest build of each slice, by the time in its name; names without a time are left out."""
    timed = files.withColumn("built_at", build_time(F.col("build_id"))).where("built_at IS NOT NULL")
    return timed.groupBy("slice_key").agg(
        F.max_by("build_id", "built_at").alias("latest_build"), F.max("built_at").alias("built_at")
    )


def registry_health(latest: DataFrame, as_of: Column, stale_days: int = 7) -> DataFrame:
    """One row: slices, stale slices and the share that is fresh (100 without slices)."""
    stale = F.datediff(as_of, F.to_date("built_at")) > stale_days
    n = F.count("*")
    return latest.agg(
        n.alias("total_slices"), F.count_if(stale).alias("stale_count"),
        F.coalesce((n - F.count_if(stale)) * 100.0 / F.nullif(n, F.lit(0)), F.lit(100.0)).alias("registry_health"),
    )


def stale_slices(latest: DataFrame, as_of: Column, stale_days: int = 7) -> DataFrame:
    return latest.where(F.datediff(as_of, F.to_date("built_at")) > stale_days)


def search_builds(entries: DataFrame, criteria: Mapping[str, object]) -> DataFrame:
    """Entries equal to every criterion."""
    for name, value in criteria.items():
        entries = entries.where(F.col(name) == F.lit(value))
    return entries


def build_at(entries: DataFrame, timestamp: str) -> DataFrame:
    return entries.where(F.col("timestamp") == timestamp)


def last_builds(entries: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` newest entries (a report, limited by design)."""
    return entries.orderBy(F.desc("timestamp")).limit(n)


def retention_split(entries: DataFrame, keep: int = 20) -> DataFrame:
    """Adds ``retained``: true for the ``keep`` newest entries, the rest goes to the archive."""
    placed = ranked(stage(entries, "entries"), [], [F.desc("timestamp")], "_age")
    return placed.withColumn("retained", F.col("_age") <= keep).drop("_age")
