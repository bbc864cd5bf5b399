"""The master build and the game build as jobs over all slices at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.operators import clean, delta, link, quality
from rankloom.sources.payloads import parse_matches
from rankloom.storage import stage


def build_master(feeds: DataFrame, created_at: str) -> DataFrame:
    """Feed rows -> deduplicated, US only, with ids, one row per team."""
    merged = clean.normalize_states(delta.dedupe_feed(feeds))
    migrated = clean.migrate_master(delta.dedupe_prefer_id(merged), created_at)
    return delta.resolve_conflicts(migrated.where("team_id IS NOT NULL"))


def update_master(feeds: DataFrame, baseline: DataFrame, created_at: str) -> dict[str, DataFrame]:
    """Incremental build: merged index, its changes against the baseline, and the validation row."""
    candidate = stage(build_master(feeds, created_at), "candidate")
    fresh = delta.new_teams(candidate, baseline)
    merged = stage(delta.merge_with_baseline(fresh, baseline), "merged")
    changes = delta.compare_builds(merged, baseline, delta.TEAM_KEY)
    return {"master": merged, **changes, "renamed": delta.renamed_teams(candidate, baseline),
            "validation": quality.validation_report(merged)}


def build_games(payloads: DataFrame, master: DataFrame, identities: DataFrame | None, since: Column | None = None) -> dict[str, DataFrame]:
    """Raw match documents -> cleaned, linked games and the ones that stay unlinked."""
    games = clean.clean_game_records(parse_matches(payloads, since))
    complete, rejected = clean.split_complete(games, clean.GAME_KEYS[:6])
    linked = link.link_games(complete, master, identities)
    return {"games": linked.where(F.col("link_status") != "unlinked"), "unlinked": link.unlinked(linked), "rejected": rejected}
