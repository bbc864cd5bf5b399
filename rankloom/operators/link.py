"""Linking games to the master index, and membership reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.ids import spread_null
from rankloom.operators.windows import best_row

ID_COLUMNS = ("team_id_master", "opponent_id_master", "team_id_source", "opponent_id")
ENRICH = ("team_name", "club_name", "state", "gender", "age_group")


def ids_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in ID_COLUMNS if c in df.columns})


def text_key_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join after the id columns of both sides became text."""
    return ids_as_text(left).join(ids_as_text(right), list(on), how)


def link_primary(games: DataFrame, master: DataFrame) -> DataFrame:
    """Left join on team_id_master; master attributes carry the suffix ``_master``. A game stays one row."""
    attributes = [c for c in ENRICH if c in master.columns]
    right = best_row(master, ["team_id_master"], []).select(
        F.col("team_id_master").cast("string").alias("_mid"), *[F.col(c).alias(f"{c}_master") for c in attributes]
    )
    return (
        ids_as_text(games).join(right, F.col("team_id_master") == F.col("_mid"), "left")
        .withColumn("linked_primary", F.col("_mid").isNotNull()).drop("_mid")
    )


def link_fallback(linked: DataFrame, master: DataFrame) -> DataFrame:
    """Rows without a primary link are tried by team_id_source = provider_team_id, of the same provider if both name one.

    Of several master rows with one key (see ``ambiguous_keys``) the one with the smallest team id counts.
    """
    attributes = [c for c in ENRICH if f"{c}_master" in linked.columns]
    on_provider = "provider" in linked.columns and "provider" in master.columns
    keys = _fallback_keys(master) if on_provider else ["provider_team_id"]
    known = best_row(master.where(F.col("provider_team_id").isNotNull()), keys, [F.col("team_id_master").asc_nulls_last()])
    right = known.select(
        F.col("provider_team_id").cast("string").alias("_pid"),
        F.col("provider" if on_provider else "provider_team_id").cast("string").alias("_feed"),
        *[F.col(c).alias(f"_{c}") for c in attributes],
    )
    # Only the unlinked rows look for a second match; the others spread over the tasks.
    row = [c for c in ("team_id_source", "team_id_master", "opponent_id", "game_date") if c in linked.columns]
    key = spread_null(F.when(~F.col("linked_primary"), F.col("team_id_source")), *row)
    same = F.col("_key") == F.col("_pid")
    if on_provider:
        same = same & linked["provider"].eqNullSafe(F.col("_feed"))
    joined = linked.withColumn("_key", key).join(right, same, "left")
    filled = {f"{c}_master": F.coalesce(f"{c}_master", f"_{c}") for c in attributes}
    return joined.withColumns({
        **filled, "link_status": F.when(F.col("linked_primary"), "primary")
        .when(F.col("_pid").isNotNull(), "fallback").otherwise("unlinked"),
    }).drop("_key", "_pid", "_feed", *[f"_{c}" for c in attributes])


def _fallback_keys(master: DataFrame) -> list[str]:
    return [c for c in ("provider", "provider_team_id") if c in master.columns]


def ambiguous_keys(master: DataFrame) -> DataFrame:
    """Feed ids that several master teams share, with their number and the team that a fallback link takes."""
    keys = _fallback_keys(master)
    return master.where(F.col("provider_team_id").isNotNull()).groupBy(*keys).agg(
        F.countDistinct("team_id_master").alias("teams"), F.min("team_id_master").alias("taken")).where("teams > 1")


def backfill_club(linked: DataFrame, identities: DataFrame) -> DataFrame:
    """Missing club names from the last entry of the identity's (alphabetical) club history."""
    last = identities.where(F.size("club_history") > 0).select(
        F.col("team_id").alias("_tid"), F.element_at("club_history", -1).alias("_club")
    )
    return linked.join(last, F.col("team_id_master") == F.col("_tid"), "left").withColumn(
        "club_name", F.coalesce("club_name", "_club")
    ).drop("_tid", "_club")


def link_games(games: DataFrame, master: DataFrame, identities: DataFrame | None = None) -> DataFrame:
    linked = link_fallback(link_primary(games, master), master)
    return linked if identities is None else backfill_club(linked, identities)


def link_coverage(linked: DataFrame) -> DataFrame:
    hit = F.count_if(F.col("link_status") != "unlinked")
    return linked.agg(
        F.count("*").alias("total"), hit.alias("linked"),
        F.coalesce(hit * 100.0 / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("linked_pct"),
    )


def unlinked(linked: DataFrame) -> DataFrame:
    return linked.where(F.col("link_status") == "unlinked")


def strength_by_opponent(games: DataFrame, teams: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Adds ``opp_<col>`` of the opponent to each game, null where the opponent is unknown."""
    side = teams.select(F.col("team_id_master").alias("_oid"), *[F.col(c).alias(f"opp_{c}") for c in cols])
    keyed = games.withColumn("_key", spread_null(F.col("opponent_id_master"), *games.columns))
    return keyed.join(side, F.col("_key") == F.col("_oid"), "left").drop("_oid", "_key")


def remaining_teams(teams: DataFrame, progress: DataFrame) -> DataFrame:
    """Teams without a progress row."""
    return teams.join(progress.select("team_id_master").distinct(), "team_id_master", "left_anti")


def stale_teams(teams: DataFrame, progress: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Teams not fetched within the last ``days``; never fetched ones stay in."""
    last = progress.select(F.col("team_id_master").alias("_tid"), "last_scraped")
    fresh = F.coalesce(F.datediff(as_of, F.col("last_scraped")) < days, F.lit(False))
    return teams.join(last, F.col("team_id_master") == F.col("_tid"), "left").where(~fresh).drop("_tid")


def id_overlap(games: DataFrame, master: DataFrame) -> DataFrame:
    """One row: distinct team, opponent and master ids and how they overlap."""
    sides = (
        games.select(F.col("team_id_master").alias("id"), F.lit(1).alias("t"), F.lit(0).alias("o"), F.lit(0).alias("m"))
        .unionAll(games.select("opponent_id_master", F.lit(0), F.lit(1), F.lit(0)))
        .unionAll(master.select("team_id_master", F.lit(0), F.lit(0), F.lit(1)))
        .where("id IS NOT NULL").groupBy("id").agg(F.max("t").alias("t"), F.max("o").alias("o"), F.max("m").alias("m"))
    )
    return sides.agg(
        F.sum("t").alias("team_ids"), F.sum("o").alias("opponent_ids"), F.sum("m").alias("master_ids"),
        F.sum(F.col("t") * F.col("o")).alias("team_and_opponent"),
        F.sum(F.col("t") * F.col("m")).alias("team_and_master"),
        F.sum(F.col("o") * F.col("m")).alias("opponent_and_master"),
    )
