"""The identity map: names, feed ids and clubs known for each team."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import ids, text
from rankloom.functions.strings import strip
from rankloom.operators.windows import best_row


def club_lookup(games: DataFrame, provider: str) -> DataFrame:
    """Distinct club and state: first and last seen, first non-empty city."""
    named = games.withColumn("club_name", strip("club_name")).where(F.coalesce("club_name", F.lit("")) != "")
    city = F.when(F.col("city") != "", F.struct("scraped_at", "city"))
    return named.groupBy("club_name", "state").agg(
        F.min("scraped_at").alias("first_seen_at"), F.max("scraped_at").alias("last_seen_at"),
        F.min(city)["city"].alias("city"), F.min("source_url").alias("source_url"),
    ).select(
        F.lit(provider).alias("provider"), F.lit(None).cast("string").alias("club_id"), "club_name", "state",
        F.coalesce("city", F.lit("")).alias("city"), F.lit(None).cast("string").alias("website"), "first_seen_at",
        "last_seen_at", "source_url",
    )


def observe_identities(rows: DataFrame) -> DataFrame:
    """Fold sightings into one entry per team id.

    ``rows``: team_id (computed where null), team_name, provider,
    provider_team_id, club_name, state, gender, age_group, seen_at. The newest
    sighting of a feed gives its id; aliases are sorted, clubs sorted.
    """
    tid = F.coalesce(F.col("team_id"), ids.team_id(
        F.col("team_name"), F.col("state"), F.col("age_group"), F.col("gender")))
    valid = rows.withColumn("team_id", tid).where(F.col("team_id").rlike("^[a-f0-9]{12}$"))
    name = F.when(F.coalesce("team_name", F.lit("")) != "", F.col("team_name"))
    club = F.when(strip("club_name") != "", strip("club_name"))
    # Per team and feed first: map entries come from one row per feed.
    per_feed = valid.groupBy("team_id", "provider").agg(
        F.max(F.struct("seen_at", F.col("provider_team_id").cast("string").alias("pid")))["pid"].alias("pid"),
        F.min(F.struct("seen_at", "team_name")).alias("first_name"),
        F.collect_set(name).alias("aliases"), F.collect_set(club).alias("clubs"),
        F.min("seen_at").alias("created_at"), F.max("seen_at").alias("updated_at"),
    )
    return per_feed.groupBy("team_id").agg(
        F.min("first_name")["team_name"].alias("canonical_name"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("provider", "pid")))).alias("provider_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("clubs")))).alias("club_history"),
        F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"),
    )


def upsert_identities(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Existing map with new sightings merged in; ``is_new`` and ``was_updated`` say what happened."""
    new = observe_identities(rows)
    n = new.select("team_id", *[F.col(c).alias(f"_{c}") for c in new.columns if c != "team_id"])
    empty_map = F.create_map().cast("map<string,string>")
    empty_list = F.array().cast("array<string>")
    old_ids, new_ids = F.coalesce("provider_ids", empty_map), F.coalesce("_provider_ids", empty_map)
    kept = F.map_filter(old_ids, lambda k, _: ~F.map_contains_key(new_ids, k))
    merged_ids = F.map_concat(kept, new_ids)
    names = F.array_sort(F.array_distinct(F.concat(F.coalesce("aliases", empty_list), F.coalesce("_aliases", empty_list))))
    clubs = F.array_sort(F.array_distinct(F.concat(F.coalesce("club_history", empty_list), F.coalesce("_club_history", empty_list))))
    joined = existing.join(n, "team_id", "full")
    changed = (
        F.col("canonical_name").isNull() | (F.size(names) != F.size(F.coalesce("aliases", empty_list)))
        | (F.size(clubs) != F.size(F.coalesce("club_history", empty_list)))
        | (F.array_sort(F.map_entries(merged_ids)) != F.array_sort(F.map_entries(old_ids)))
    )
    return joined.select(
        "team_id", F.coalesce("canonical_name", "_canonical_name").alias("canonical_name"),
        merged_ids.alias("provider_ids"), names.alias("aliases"), clubs.alias("club_history"),
        F.coalesce("created_at", "_created_at").alias("created_at"),
        F.when(changed, F.coalesce("_updated_at", "updated_at")).otherwise(F.col("updated_at")).alias("updated_at"),
        F.col("canonical_name").isNull().alias("is_new"), changed.alias("was_updated"),
    )


def identity_summary(identities: DataFrame) -> DataFrame:
    return identities.agg(
        F.count("*").alias("total_teams"), F.sum(F.size("provider_ids")).alias("total_providers"),
        F.sum(F.size("aliases")).alias("total_aliases"), F.sum(F.size("club_history")).alias("total_clubs"),
    )


def audit_aliases(identities: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Similarity of each alias to the canonical name; below the threshold it is flagged."""
    pairs = identities.select("team_id", "canonical_name", F.explode("aliases").alias("alias"), "updated_at").where(
        (F.col("alias") != "") & (F.col("canonical_name") != "")
    )
    score = text.token_sort_ratio(F.col("canonical_name"), F.col("alias"))
    return pairs.withColumn("similarity_score", score).withColumn(
        "review_flag", F.col("similarity_score") < threshold
    )


def audit_report(audit: DataFrame) -> DataFrame:
    """Flagged first, lowest similarity first."""
    return audit.orderBy(F.desc("review_flag"), "similarity_score", "team_id", "alias")


def weekly_review(audit: DataFrame, as_of, days: int = 7) -> DataFrame:
    """One row: flagged, teams seen in the last ``days``, entries and mean similarity."""
    recent = F.to_date("updated_at") >= F.date_sub(as_of, days)
    return audit.agg(
        F.count_if("review_flag").alias("flagged_count"),
        F.countDistinct(F.when(recent, F.col("team_id"))).alias("new_teams_this_week"),
        F.count("*").alias("total_entries"),
        F.coalesce(F.round(F.avg("similarity_score"), 3), F.lit(0.0)).alias("avg_similarity"),
    )


def lowest_similarity(audit: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` worst flagged aliases (a report, limited by design)."""
    return audit.where("review_flag").orderBy("similarity_score", "team_id", "alias").limit(n)


def latest_sightings(rows: DataFrame) -> DataFrame:
    """Newest sighting per team and feed."""
    return best_row(rows, ["team_id", "provider"], [F.desc("seen_at")])
