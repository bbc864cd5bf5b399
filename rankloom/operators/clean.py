"""Projection, filtering and cleaning of games and team rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions import ids
from rankloom.functions.games import iso_date, result_code
from rankloom.functions.strings import strip
from rankloom.schemas import (GAME_COLUMNS, GAME_RENAMES, NON_US, REGION_TO_STATE, REQUIRED_GAME, US_STATES)

ACTIVITY_FIELDS = ("last_seen_active_date", "last_active_date", "last_game_date")
INDEX_COLUMNS = ("team_name", "age_group", "gender", "state", "rank", "points", "source", "provider", "url")
MASTER_COLUMNS = ("team_id", "provider_team_id", "team_name", "age_group", "age_u", "gender", "state", "provider",
                  "club_name", "source_url", "created_at")
TEAM_KEYS = ("team_id_source", "team_id_master", "team_name", "club_name", "state", "gender", "age_group")
GAME_KEYS = ("provider", "team_id_source", "team_id_master", "team_name", "opponent_name", "game_date",
             "goals_for", "goals_against")


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def rename_game_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in GAME_RENAMES.items() if old in df.columns})


def coerce_games(df: DataFrame) -> DataFrame:
    """Dates and goals to types; rows where one does not parse are dropped."""
    typed = df.withColumns({
        "date": iso_date(F.col("date").cast("string")),
        "gf": F.col("gf").try_cast("double"),
        "ga": F.col("ga").try_cast("double"),
    })
    return typed.dropna(subset=["date", "gf", "ga"])


def normalize_games(df: DataFrame) -> DataFrame:
    """Raw game rows to the normalized layout."""
    return coerce_games(require_columns(rename_game_columns(df), REQUIRED_GAME))


def slice_filter(
    df: DataFrame, state: str | None, genders: Sequence[str], ages: Sequence[str]
) -> DataFrame:
    """One state (or the whole country with None), some genders and age groups."""
    if state is not None:
        df = df.where(F.col("state") == state)
    return df.where(F.col("gender").isin(*genders) & F.col("age_group").isin(*ages))


def slice_grid(
    spark: SparkSession, states: Sequence[str], genders: Sequence[str], ages: Sequence[str]
) -> DataFrame:
    """Every (state, gender, age group) slice key of three short code lists."""
    return spark.createDataFrame([(list(states), list(genders), list(ages))],
                                 "s array<string>, g array<string>, a array<string>").select(
        F.explode("s").alias("state"), "g", "a"
    ).select("state", F.explode("g").alias("gender"), "a").select(
        "state", "gender", F.explode("a").alias("age_group")
    )


# ---------------------------------------------------------------- states

def normalized_state(state: Column) -> Column:
    case = None
    for region, target in REGION_TO_STATE.items():
        case = F.when(state == region, target) if case is None else case.when(state == region, target)
    return case.otherwise(state)


def normalize_states(df: DataFrame) -> DataFrame:
    """Regional codes to states, then foreign, empty and one-letter codes out."""
    mapped = df.withColumn("state", normalized_state(F.col("state")))
    return mapped.where(~F.col("state").isin(*NON_US) & (F.length("state") >= 2))


def valid_states(df: DataFrame) -> DataFrame:
    return df.where(F.col("state").isNotNull() & ~F.col("state").isin(*NON_US)).select("state").distinct()


def state_statistics(df: DataFrame) -> DataFrame:
    """Per state: teams, the state it maps to if regional, and whether it is foreign."""
    target = F.when(F.col("state").isin(*REGION_TO_STATE), normalized_state(F.col("state")))
    return df.where(F.col("state").isNotNull()).groupBy("state").agg(F.count("*").alias("teams")).withColumns({
        "maps_to": target, "non_us": F.col("state").isin(*NON_US),
    })


def top_states(df: DataFrame, n: int = 10) -> DataFrame:
    counts = df.where(F.col("state").isNotNull()).groupBy("state").agg(F.count("*").alias("teams"))
    return counts.orderBy(F.desc("teams"), "state").limit(n)


# ---------------------------------------------------------------- master index

def with_identity(df: DataFrame) -> DataFrame:
    """Adds team_id, age_u and the normalized gender of a raw team row."""
    return df.withColumns({
        "team_id": ids.team_id(F.col("team_name"), F.col("state"), F.col("age_group"), F.col("gender")),
        "age_u": ids.age_number(F.col("age_group")),
        "gender": ids.gender_code(F.col("gender")),
    })


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that get a team id, and the others with a ``reason``."""
    reason = ids.reject_reason(F.col("team_name"), F.col("state"), F.col("age_group"), F.col("gender"))
    flagged = df.withColumn("reason", reason)
    return flagged.where("reason IS NULL").drop("reason"), flagged.where("reason IS NOT NULL")


def migrate_master(df: DataFrame, created_at: str) -> DataFrame:
    """Raw index rows to the master layout: ids, ages, genders, clubs; extra columns follow."""
    if "team_id" in df.columns:
        df = df.withColumnRenamed("team_id", "provider_team_id")
    else:
        df = df.withColumn("provider_team_id", F.lit(None).cast("string"))
    if "url" in df.columns and "source_url" not in df.columns:
        df = df.withColumnRenamed("url", "source_url")
    if "club_name" not in df.columns:
        df = df.withColumn("club_name", F.lit(None).cast("string"))
    df = df.where(F.col("team_name").isNotNull() & F.col("state").rlike("^[A-Z]{2}$"))
    df = with_identity(df).withColumn("created_at", F.lit(created_at))
    return df.select(*MASTER_COLUMNS, *[c for c in df.columns if c not in MASTER_COLUMNS])


def normalize_index(df: DataFrame) -> DataFrame:
    """State clean-up, the index columns in their order, sorted."""
    clean = normalize_states(df)
    clean = clean.select(*[c for c in INDEX_COLUMNS if c in clean.columns])
    return clean.orderBy(*[c for c in ("state", "age_group", "gender", "rank") if c in clean.columns])


def clean_feed_rows(df: DataFrame) -> DataFrame:
    """Feed rows with a name; unknown states blanked, missing fields defaulted."""
    state = F.when(F.col("state").isin(*US_STATES), F.col("state")).otherwise("")
    return df.where(F.coalesce(F.col("team_name"), F.lit("")) != "").select(
        strip("team_name").alias("team_name"),
        F.coalesce("age_group", F.lit("Unknown")).alias("age_group"),
        F.coalesce("gender", F.lit("Unknown")).alias("gender"),
        F.coalesce("source", F.lit("Unknown")).alias("source"),
        F.coalesce("points", F.lit(0)).alias("points"),
        state.alias("state"),
        F.coalesce("rank", F.lit(0)).alias("rank"),
        F.coalesce("url", F.lit("")).alias("url"),
    )


# ---------------------------------------------------------------- activity

def active_teams(df: DataFrame, as_of: Column, threshold_days: int = 120) -> DataFrame:
    """Teams seen within the threshold; without a usable date a team counts as active."""
    seen = iso_date(F.col("last_seen_active_date").cast("string"))
    return df.where(F.coalesce(seen >= F.date_sub(as_of, threshold_days), F.lit(True)))


def recent_team_games(
    df: DataFrame, as_of: Column, months: int = 12, min_games: int = 1, keys: Sequence[str] = ("team_id_master",),
    date_col: str = "game_date",
) -> DataFrame:
    """Games of the last months; teams left with fewer than ``min_games`` lose all of them."""
    recent = df.where(iso_date(F.col(date_col).cast("string")) >= F.add_months(as_of, -months))
    if min_games <= 1:
        return recent
    enough = recent.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_games).drop("_n")
    return recent.join(enough, list(keys), "left_semi")


def last_activity_date(columns: Sequence[str]) -> Column:
    """First usable date among the activity fields present."""
    dates = [iso_date(F.col(c).cast("string")) for c in ACTIVITY_FIELDS if c in columns]
    return F.coalesce(*dates) if dates else F.lit(None).cast("date")


# ---------------------------------------------------------------- game records

def clean_game_records(df: DataFrame) -> DataFrame:
    """All 20 game fields, non-ISO dates nulled, names trimmed, goals whole numbers or null."""
    def field(name: str) -> Column:
        return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")

    out = {c: field(c) for c in GAME_COLUMNS}
    out["game_date"] = F.when(out["game_date"].rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), out["game_date"])
    for c in ("team_name", "opponent_name", "venue"):
        out[c] = strip(out[c])
    for c in ("goals_for", "goals_against"):
        out[c] = out[c].try_cast("int")
    return df.select(*[out[c].alias(c) for c in GAME_COLUMNS])


def with_result(df: DataFrame) -> DataFrame:
    return df.withColumn("result", result_code(F.col("goals_for"), F.col("goals_against")))


def split_complete(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every key present, and the others with the list of what they miss."""
    missing = F.array_compact(F.array(*[
        F.when(F.col(k).isNull(), k) if k in df.columns else F.lit(k) for k in keys
    ]))
    flagged = df.withColumn("missing", missing)
    return flagged.where(F.size("missing") == 0).drop("missing"), flagged.where(F.size("missing") > 0)


def link_quality(games: DataFrame) -> DataFrame:
    """One row: share of missing team ids, of missing opponents, of opponents that are teams."""
    teams = games.select(F.col("team_id_master").alias("_t")).distinct()

    def blank(c: str) -> Column:
        return (F.col(c).isNull() | (F.col(c) == "")).cast("double")

    # Opponents are counted first, so the join carries one row per opponent, not per game.
    per_opponent = games.groupBy("opponent_id_master").agg(
        F.count("*").alias("n"), F.sum(blank("team_id_master")).alias("no_team"),
        F.sum(blank("opponent_id_master")).alias("no_opp"),
    )
    joined = per_opponent.join(teams, F.col("opponent_id_master") == F.col("_t"), "left")
    total = F.nullif(F.sum("n"), F.lit(0))
    return joined.agg(
        (F.sum("no_team") / total).alias("missing_team"),
        (F.sum("no_opp") / total).alias("missing_opponent"),
        (F.sum(F.when(F.col("_t").isNotNull(), F.col("n")).otherwise(0)) / total).alias("overlap"),
    )


def check_links(games: DataFrame, national: bool = False, max_missing: float = 0.05) -> str:
    """Raises when too many opponents are missing; returns ``low_overlap`` or ``ok``."""
    row = link_quality(games).first()
    if row["missing_opponent"] is not None and row["missing_opponent"] > max_missing:
        raise ValueError(f"opponent ids missing for {row['missing_opponent']:.1%} of rows")
    floor = 0.30 if national else 0.20
    return "low_overlap" if (row["overlap"] or 0.0) < floor else "ok"


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
