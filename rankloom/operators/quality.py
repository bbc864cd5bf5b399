"""Checks and summaries of the master index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.strings import strip
from rankloom.operators.clean import last_activity_date
from rankloom.schemas import (AGE_GROUP_FORMAT, DATE_FORMAT, STATE_FORMAT, TEAM_ID_FORMAT, TIMESTAMP_FORMAT,
                              US_STATES)

NAME_KEY = ("team_name", "age_group", "gender")


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


# ---------------------------------------------------------------- duplicates and distributions

def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows in groups of two or more, and rows after the first of each group."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_in_duplicates"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_after_first"),
    )


def distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(dimension, value, teams) for each column in one pass."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("p")).select("p.*").where("value IS NOT NULL")
    return pairs.groupBy("dimension", "value").agg(F.count("*").alias("teams"))


def _totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"), F.countDistinct("state").alias("unique_states"),
        F.count_if(F.col("state").isNull()).alias("missing_state_rows"),
        F.countDistinct("age_group").alias("age_groups"), F.countDistinct("gender").alias("genders"),
        F.countDistinct("provider").alias("providers"),
    )


def master_summary(df: DataFrame) -> DataFrame:
    """One row: rows, states, missing states, distinct ages, genders and providers, rows that share name, age and gender, and shares in percent."""
    n = F.col("total_rows")
    return _totals(df).withColumn("duplicate_rows", _duplicate_scalar(df, "rows_in_duplicates")).withColumns({
        "state_completeness_percent": _share(n - F.col("missing_state_rows"), n) * 100, "duplicate_percent": _share(F.col("duplicate_rows"), n) * 100})


def age_gender_crosstab(df: DataFrame, genders: Sequence[str]) -> DataFrame:
    """Teams per age group (rows) and gender (columns); the genders are given, so no extra pass finds them."""
    table = df.where(F.col("age_group").isNotNull()).groupBy("age_group").pivot("gender", list(genders)).agg(F.count(F.lit(1)))
    return table.select("age_group", *[F.coalesce(F.col(g), F.lit(0)).alias(g) for g in genders])


def _duplicate_scalar(df: DataFrame, column: str) -> Column:
    return duplicate_counts(df, NAME_KEY).select(column).scalar()


def quality_score(df: DataFrame) -> DataFrame:
    """One row: weighted score up to 100 of completeness, uniqueness and diversity."""
    counts = _totals(df).withColumn("duplicates", _duplicate_scalar(df, "rows_in_duplicates"))
    n = F.col("total_rows")
    completeness = _share(n - F.col("missing_state_rows"), n) * 30
    uniqueness = (1 - F.least(_share(F.col("duplicates"), n), F.lit(0.2))) * 25
    diversity = (
        F.least(F.col("unique_states") / 50, F.lit(1.0)) * 20 + F.least(F.col("age_groups") / 9, F.lit(1.0)) * 15
        + F.least(F.col("genders") / 2, F.lit(1.0)) * 10
    )
    total = F.when(n > 0, completeness + uniqueness).otherwise(0.0) + diversity
    return counts.select("total_rows", "duplicates", F.least(total, F.lit(100.0)).alias("data_quality_score"))


def quality_checks(df: DataFrame, required: Sequence[str] = ("team_name", "age_group", "gender", "state", "source")) -> DataFrame:
    """One row of six checks and their conjunction."""
    filled = [F.count(c) > 0 for c in df.columns]
    no_empty = filled[0]
    for more in filled[1:]:
        no_empty = no_empty & more
    n = F.col("n")
    base = df.agg(
        F.count("*").alias("n"), no_empty.alias("no_empty_columns"), F.count("state").alias("with_state"),
        F.countDistinct("state").alias("states"),
    ).withColumn("later", _duplicate_scalar(df, "rows_after_first"))
    checks = {
        "has_data": n > 0,
        "has_required_columns": F.lit(set(required) <= set(df.columns)),
        "no_empty_columns": F.col("no_empty_columns"),
        "good_state_completeness": _share(F.col("with_state"), n) >= 0.8,
        "low_duplicate_rate": (n > 0) & (_share(F.col("later"), n) < 0.05),
        "multiple_states": F.col("states") >= 3,
    }
    row = base.select(*[c.alias(name) for name, c in checks.items()])
    every = F.lit(True)
    for name in checks:
        every = every & F.col(name)
    return row.withColumn("overall_valid", every)


def trends(df: DataFrame) -> DataFrame:
    """One row: most common values and how evenly ages and genders are spread."""
    counts = distribution(df, ["age_group", "gender", "state", "provider"])
    total = df.agg(F.count("*")).scalar()

    def of(dim: str, value: Column) -> Column:
        return F.when(F.col("dimension") == dim, value)

    def top(dim: str) -> Column:
        # Largest count, smallest value among equals.
        return F.min_by(of(dim, F.col("value")), of(dim, F.struct(-F.col("teams"), F.col("value"))))

    def spread(dim: str) -> Column:
        return F.stddev_samp(of(dim, F.col("teams"))) / F.avg(of(dim, F.col("teams")))

    n_states = F.count(of("state", F.col("teams")))
    return counts.agg(
        top("age_group").alias("most_common_age_group"), spread("age_group").alias("age_group_balance"),
        spread("gender").alias("gender_balance"),
        (F.max(of("state", F.col("teams"))) / F.first(total)).alias("state_concentration"),
        (n_states / 50).alias("geographic_diversity"),
        F.count(of("provider", F.col("teams"))).alias("provider_diversity"),
        top("provider").alias("dominant_provider"),
    )


# ---------------------------------------------------------------- rule tables

def _not(pattern: str, col: str) -> Column:
    return ~F.col(col).rlike(pattern)


def _missing(col: str) -> Column:
    return F.col(col).isNull()


def _valid_state(col: str = "state") -> Column:
    return F.col(col).isin(*US_STATES)


def master_rules() -> dict[str, Column]:
    """Name -> condition that marks a failing team row (null marks no failure)."""
    return {
        "team_id_format": _missing("team_id") | _not(TEAM_ID_FORMAT, "team_id"),
        "team_name_missing": _missing("team_name"),
        "age_group_format": _missing("age_group") | _not(AGE_GROUP_FORMAT, "age_group"),
        "age_range": _missing("age_u") | ~F.col("age_u").between(10, 18),
        "gender_code": _missing("gender") | ~F.col("gender").isin("M", "F"),
        "state_format": _missing("state") | _not(STATE_FORMAT, "state"),
        "state_unknown": ~F.coalesce(_valid_state(), F.lit(False)),
        "provider_missing": _missing("provider"),
        "source_url_missing": _missing("source_url"),
        "created_at_format": _not(TIMESTAMP_FORMAT, "created_at"),
        "age_mismatch": ~F.coalesce(F.col("age_group") == F.concat(F.lit("U"), F.col("age_u").cast("string")), F.lit(False)),
    }


def game_rules() -> dict[str, Column]:
    def goals(col: str) -> Column:
        return F.col(col).try_cast("int") < 0

    return {
        **{f"{c}_missing": _missing(c) for c in (
            "provider", "team_id_source", "team_id_master", "team_name", "opponent_name", "source_url")},
        "age_group_format": _missing("age_group") | _not(AGE_GROUP_FORMAT, "age_group"),
        "gender_code": _missing("gender") | ~F.col("gender").isin("M", "F"),
        "state_format": _missing("state") | _not(STATE_FORMAT, "state"),
        "state_unknown": ~F.coalesce(_valid_state(), F.lit(False)),
        "game_date_format": _missing("game_date") | _not(DATE_FORMAT, "game_date")
        | F.try_to_date("game_date", "yyyy-MM-dd").isNull(),
        "home_away_code": _missing("home_away") | ~F.col("home_away").isin("H", "A"),
        "goals_for_negative": goals("goals_for"),
        "goals_against_negative": goals("goals_against"),
        "result_code": _missing("result") | ~F.col("result").isin("W", "L", "D", "U"),
        "scraped_at_format": _missing("scraped_at") | _not(TIMESTAMP_FORMAT, "scraped_at"),
    }


def club_rules() -> dict[str, Column]:
    return {
        **{f"{c}_missing": _missing(c) for c in ("provider", "club_name", "source_url")},
        "state_format": _missing("state") | _not(STATE_FORMAT, "state"),
        "state_unknown": ~F.coalesce(_valid_state(), F.lit(False)),
        "first_seen_format": _missing("first_seen_at") | _not(TIMESTAMP_FORMAT, "first_seen_at"),
        "last_seen_format": _missing("last_seen_at") | _not(TIMESTAMP_FORMAT, "last_seen_at"),
    }


def rule_failures(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, failures) for every rule, in one pass over the rows."""
    counted = df.agg(*[F.count_if(cond).alias(name) for name, cond in rules.items()])
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("failures")) for name in rules
    ])).alias("r")).select("r.*")


def rejected_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Failing rows with the names of the rules they break."""
    broken = F.array_compact(F.array(*[F.when(cond, name) for name, cond in rules.items()]))
    return df.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)


def validation_report(df: DataFrame) -> DataFrame:
    """One row: issue counts, score and status of a migrated master index.

    Failed when state codes are wrong in over 1 % of rows or ids repeat; else
    passed without issues, warnings under 5 % of rows, failed beyond.
    """
    rules = master_rules()
    dup = duplicate_counts(df, ("team_name", "state", "age_u", "gender")).select("rows_in_duplicates").scalar()
    dup_ids = duplicate_counts(df, ("team_id",)).select("rows_in_duplicates").scalar()
    base = df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(rules["state_unknown"]).alias("invalid_states"),
        F.count_if(~F.coalesce(F.col("gender").isin("M", "F"), F.lit(False))).alias("invalid_genders"),
        F.count_if(~F.col("age_u").between(10, 18)).alias("invalid_ages"),
        F.count_if(rules["age_group_format"]).alias("invalid_age_groups"),
        F.count_if(rules["age_mismatch"]).alias("inconsistent_ages"),
    ).withColumns({"duplicates": dup, "duplicate_ids": dup_ids})
    issues = sum((F.col(c) for c in ("duplicates", "invalid_states", "invalid_genders", "invalid_ages",
                                     "invalid_age_groups", "inconsistent_ages")), start=F.lit(0))
    n = F.col("total_rows")
    status = (
        F.when((F.col("duplicate_ids") > 0) | (F.col("invalid_states") > n * 0.01), "failed")
        .when(F.col("total_issues") == 0, "passed").when(F.col("total_issues") < n * 0.05, "warnings")
        .otherwise("failed")
    )
    return base.withColumn("total_issues", issues).withColumns({
        "data_quality_score": F.greatest(F.lit(0.0), 100 - _share(F.col("total_issues"), n) * 100),
        "overall_status": status,
    })


# ---------------------------------------------------------------- state summaries

def state_summary(df: DataFrame, build_id: str | None = None) -> DataFrame:
    """Per state: teams, the sets of feeds, ages and genders, their breakdowns as maps, and the build they are from."""
    dims = ("provider", "age_group", "gender")
    counts = df.where(F.col("state").isNotNull()).select("state", F.explode(F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in dims
    ])).alias("p")).select("state", "p.*").groupBy("state", "dimension", "value").agg(F.count("*").alias("n"))

    def breakdown(dim: str) -> Column:
        entry = F.when((F.col("dimension") == dim) & F.col("value").isNotNull(), F.struct("value", "n"))
        return F.map_from_entries(F.sort_array(F.collect_list(entry)))

    return counts.groupBy("state").agg(
        F.sum(F.when(F.col("dimension") == "provider", F.col("n"))).alias("teams"),
        breakdown("provider").alias("provider_breakdown"), breakdown("age_group").alias("age_breakdown"),
        breakdown("gender").alias("gender_breakdown"),
    ).select(
        "state", "teams", F.map_keys("provider_breakdown").alias("providers"),
        F.map_keys("age_breakdown").alias("age_groups"), F.map_keys("gender_breakdown").alias("genders"),
        "provider_breakdown", "age_breakdown", "gender_breakdown", F.least("teams", F.lit(10)).alias("top_teams"),
        F.lit(build_id).cast("string").alias("last_build"),
    )


def state_statistics(summary: DataFrame) -> DataFrame:
    """One row over the states: mean size, largest and smallest state, number of feeds."""
    by_size = F.struct("teams", "state")
    return summary.agg(
        F.count("*").alias("total_states"), F.avg("teams").alias("avg_teams_per_state"),
        F.min(F.struct((-F.col("teams")).alias("n"), F.col("state").alias("s")))["s"].alias("max_teams_state"),
        F.min(by_size)["state"].alias("min_teams_state"),
        F.size(F.array_distinct(F.flatten(F.collect_list("providers")))).alias("total_providers"),
    )


def coverage_report(summary: DataFrame) -> DataFrame:
    """One row: spread of state sizes (the median is the upper one) and totals.

    ``summary`` has one row per state code, so the ordered list is short.
    """
    sizes = F.sort_array(F.collect_list("teams"))
    return summary.agg(
        F.count("*").alias("total_states"), F.sum("teams").alias("total_teams"),
        F.avg("teams").alias("avg_teams_per_state"), F.min("teams").alias("min_teams"),
        F.max("teams").alias("max_teams"),
        F.get(sizes, F.floor(F.size(sizes) / 2).cast("int")).alias("median_teams"),
    )


def coverage_outliers(summary: DataFrame) -> DataFrame:
    """States under half and over one and a half times the mean size."""
    mean = summary.agg(F.avg("teams")).scalar()
    kind = F.when(F.col("teams") < mean * 0.5, "low").when(F.col("teams") > mean * 1.5, "high")
    return summary.select("state", "teams", kind.alias("coverage")).where("coverage IS NOT NULL")


def provider_coverage(summary: DataFrame) -> DataFrame:
    return summary.select(F.explode("providers").alias("provider")).groupBy("provider").agg(F.count("*").alias("states"))


def state_coverage(summary: DataFrame, code: str) -> DataFrame:
    return summary.where(F.col("state") == code.upper())


def age_gender_cube(df: DataFrame) -> DataFrame:
    """Counts per (state, gender, age), per state, per (gender, age) in the country, and the total."""
    dims = ["state", "gender", "age_group"]
    keep = {c: F.col(c).isNotNull() for c in dims}
    rows = df.where(keep["state"] & keep["gender"] & keep["age_group"])
    sets = [["state", "gender", "age_group"], ["state"], ["gender", "age_group"], []]
    cube = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims]).agg(
        F.count("*").alias("teams")
    )
    return cube.select(
        F.coalesce("state", F.lit("USA")).alias("state"), F.coalesce("gender", F.lit("Total")).alias("gender"),
        F.coalesce("age_group", F.lit("Total")).alias("age_group"), "teams",
    )


# ---------------------------------------------------------------- activity, games, slices

def activity_metrics(df: DataFrame, as_of, threshold_days: int = 120) -> DataFrame:
    last = last_activity_date(df.columns)
    cutoff = F.date_sub(as_of, threshold_days)
    n = F.count("*")
    active, inactive = F.count_if(last >= cutoff), F.count_if(last < cutoff)
    return df.agg(
        n.alias("total_teams"), active.alias("active_teams"), inactive.alias("inactive_teams"),
        F.count_if(last.isNull()).alias("teams_without_activity_date"),
        (_share(active, n) * 100).alias("active_percentage"), (_share(inactive, n) * 100).alias("inactive_percentage"),
    )


def game_statistics(games: DataFrame) -> DataFrame:
    return games.agg(
        F.count("*").alias("games"), F.countDistinct("team_id_master").alias("teams"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.countDistinct("state").alias("states"), F.countDistinct("gender").alias("genders"),
        F.countDistinct("age_group").alias("age_groups"),
    )


def slice_summary(games: DataFrame, provider: str, build_id: str) -> DataFrame:
    """Per slice of one build: teams, games, clubs."""
    club = F.when(strip("club_name") != "", strip("club_name"))
    return games.groupBy("state", "gender", "age_group").agg(
        F.countDistinct("team_id_master").alias("teams_processed"), F.count("*").alias("games_written"),
        F.countDistinct(club).alias("clubs_found"),
    ).select(
        F.concat_ws("_", F.lit(provider), "state", "gender", "age_group").alias("slice_key"),
        F.lit(provider).alias("provider"), "state", "gender", "age_group", F.lit(build_id).alias("build_id"),
        "teams_processed", "games_written", "clubs_found",
    )


def build_totals(results: DataFrame) -> DataFrame:
    """Per build: slices, successful slices, teams and games."""
    return results.groupBy("build_id").agg(
        F.count("*").alias("total_slices"), F.count_if("success").alias("successful_slices"),
        F.sum("teams_processed").alias("total_teams_processed"), F.sum("games_scraped").alias("total_games_scraped"),
    )


