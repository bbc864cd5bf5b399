"""Quality, registry, identity and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom import adapters as A
from rankloom.catalog.base import day_text, joined, query, rounded
from rankloom.catalog.sql import inlist, with_ctes
from rankloom.config import BASELINE
from rankloom.operators import clean, delta, identity, quality, registry, reports
from rankloom.plans import ranking as R
from rankloom.schemas import US_STATES
from rankloom.storage import stage

AS_OF = "2001-11-05"


def _master(spark, sf):
    return clean.migrate_master(A.feed(spark, sf), "2001-11-05T00:00:00").where("team_id IS NOT NULL")


def _migrated(spark, sf):
    return clean.migrate_master(A.feed(spark, sf), "2001-11-05T00:00:00")


# ---------------------------------------------------------------- D1-D10, D25

DUP = "(SELECT coalesce(sum(n) FILTER (n > 1), 0) FROM (SELECT count(*) AS n FROM feed GROUP BY team_name, age_group, gender) g)::BIGINT"


@query("d01_master_summary", f"""
SELECT count(*) AS total_rows, count(DISTINCT state) AS unique_states, count(*) FILTER (state IS NULL) AS missing_state_rows,
       count(DISTINCT age_group) AS age_groups, count(DISTINCT gender) AS genders, count(DISTINCT provider) AS providers, {DUP} AS duplicate_rows,
       round(count(state) * 100.0::DOUBLE / count(*), 6) AS state_completeness_percent, round({DUP} * 100.0::DOUBLE / count(*), 6) AS duplicate_percent FROM feed""")
def d01(spark, sf):
    return rounded(quality.master_summary(A.feed(spark, sf)), "state_completeness_percent", "duplicate_percent")


@query("d01_distributions", " UNION ALL ".join(
    f"SELECT '{c}' AS dimension, {c} AS value, count(*) AS teams FROM feed WHERE {c} IS NOT NULL GROUP BY 2" for c in ("state", "age_group", "gender", "provider")))
def d01_dist(spark, sf):
    return quality.distribution(A.feed(spark, sf), ["state", "age_group", "gender", "provider"])


@query("d02_age_gender_crosstab", """
SELECT age_group, count(*) FILTER (gender = 'M') AS "M", count(*) FILTER (gender = 'F') AS "F" FROM master GROUP BY 1""")
def d02(spark, sf):
    return quality.age_gender_crosstab(_master(spark, sf), ["M", "F"])


@query("d03_duplicate_counts", """
SELECT coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS rows_in_duplicates, sum(n - 1)::BIGINT AS rows_after_first
FROM (SELECT count(*) AS n FROM feed GROUP BY team_name, age_group, gender) g""")
def d03(spark, sf):
    return quality.duplicate_counts(A.feed(spark, sf), quality.NAME_KEY)




@query("d04_quality_score", f"""
SELECT count(*) AS total_rows, {DUP} AS duplicates, round(least(100, count(state)::DOUBLE / count(*) * 30 + (1 - least({DUP}::DOUBLE / count(*), 0.2)) * 25
  + least(count(DISTINCT state) / 50.0, 1) * 20 + least(count(DISTINCT age_group) / 9.0, 1) * 15 + least(count(DISTINCT gender) / 2.0, 1) * 10), 6)::DOUBLE AS data_quality_score FROM feed""")
def d04(spark, sf):
    return rounded(quality.quality_score(A.feed(spark, sf)), "data_quality_score")


@query("d05_quality_checks", """
SELECT TRUE AS has_data, TRUE AS has_required_columns, TRUE AS no_empty_columns, count(state)::DOUBLE / count(*) >= 0.8 AS good_state_completeness,
       (SELECT sum(n - 1)::DOUBLE FROM (SELECT count(*) AS n FROM feed GROUP BY team_name, age_group, gender) g) / count(*) < 0.05 AS low_duplicate_rate,
       count(DISTINCT state) >= 3 AS multiple_states,
       count(state)::DOUBLE / count(*) >= 0.8 AND (SELECT sum(n - 1)::DOUBLE FROM (SELECT count(*) AS n FROM feed GROUP BY team_name, age_group, gender) g) / count(*) < 0.05
       AND count(DISTINCT state) >= 3 AS overall_valid FROM feed""")
def d05(spark, sf):
    return quality.quality_checks(A.feed(spark, sf))


@query("d06_trends", """
SELECT (SELECT age_group FROM feed GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS most_common_age_group,
       (SELECT round(stddev_samp(n) / avg(n), 6) FROM (SELECT count(*) AS n FROM feed GROUP BY age_group) a) AS age_group_balance,
       (SELECT round(stddev_samp(n) / avg(n), 6) FROM (SELECT count(*) AS n FROM feed GROUP BY gender) a) AS gender_balance,
       (SELECT round(max(n)::DOUBLE / (SELECT count(*) FROM feed), 6) FROM (SELECT count(*) AS n FROM feed WHERE state IS NOT NULL GROUP BY state) a) AS state_concentration,
       (SELECT round(count(DISTINCT state) / 50::DOUBLE, 6) FROM feed) AS geographic_diversity, (SELECT count(DISTINCT provider) FROM feed) AS provider_diversity,
       (SELECT provider FROM feed GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS dominant_provider""")
def d06(spark, sf):
    return rounded(quality.trends(A.feed(spark, sf)), "age_group_balance", "gender_balance", "state_concentration", "geographic_diversity")


_STATES = inlist(US_STATES)
_TS = "'[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]+)?Z?'"


def _rules_sql(source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS rule, count(*) FILTER (coalesce({cond}, FALSE)) AS failures FROM {source}" for name, cond in rules.items())


MIGRATED = {"mig": """
SELECT * REPLACE (CASE WHEN age_u IS NOT NULL AND gender IS NOT NULL AND trim(team_name) <> '' THEN team_id END AS team_id) FROM migrated"""}
MASTER_RULES = {
    "team_id_format": "team_id IS NULL OR NOT regexp_full_match(team_id, '[a-f0-9]{12}')", "team_name_missing": "team_name IS NULL",
    "age_group_format": "age_group IS NULL OR NOT regexp_full_match(age_group, 'U(1[0-8]|[0-9])')", "age_range": "age_u IS NULL OR age_u NOT BETWEEN 10 AND 18",
    "gender_code": "gender IS NULL OR gender NOT IN ('M', 'F')", "state_format": "state IS NULL OR NOT regexp_full_match(state, '[A-Z]{2}')",
    "state_unknown": f"state IS NULL OR state NOT IN {_STATES}", "provider_missing": "provider IS NULL", "source_url_missing": "source_url IS NULL",
    "created_at_format": "FALSE", "age_mismatch": "age_u IS NULL OR age_group <> 'U' || age_u",
}


@query("d07_schema_rules_master", with_ctes(_rules_sql("mig", MASTER_RULES), MIGRATED))
def d07(spark, sf):
    return quality.rule_failures(_migrated(spark, sf), quality.master_rules())


@query("d07_rejected_rows", with_ctes(
    "SELECT custkey, copy, array_to_string(list_filter([" + ", ".join(f"CASE WHEN coalesce({c}, FALSE) THEN '{n}' END" for n, c in MASTER_RULES.items())
    + "], lambda x: x IS NOT NULL), ',') AS broken FROM mig WHERE " + " OR ".join(f"coalesce({c}, FALSE)" for c in MASTER_RULES.values()), MIGRATED))
def d07_rejected(spark, sf):
    rows = quality.rejected_rows(_migrated(spark, sf), quality.master_rules())
    return rows.select("custkey", "copy", joined("broken_rules").alias("broken"))


@query("d07_validation_report", with_ctes("""
SELECT *, round(greatest(0, 100 - total_issues * 100.0::DOUBLE / total_rows), 6) AS data_quality_score,
  CASE WHEN duplicate_ids > 0 OR invalid_states > total_rows * 0.01 THEN 'failed' WHEN total_issues = 0 THEN 'passed' WHEN total_issues < total_rows * 0.05 THEN 'warnings' ELSE 'failed' END AS overall_status
FROM (SELECT *, duplicates + invalid_states + invalid_genders + invalid_ages + invalid_age_groups + inconsistent_ages AS total_issues FROM (
  SELECT count(*) AS total_rows, count(*) FILTER (state NOT IN """ + _STATES + """) AS invalid_states, count(*) FILTER (gender IS NULL) AS invalid_genders,
    count(*) FILTER (age_u NOT BETWEEN 10 AND 18) AS invalid_ages, count(*) FILTER (NOT regexp_full_match(age_group, 'U(1[0-8]|[0-9])')) AS invalid_age_groups,
    count(*) FILTER (age_u IS NULL OR age_group <> 'U' || age_u) AS inconsistent_ages,
    (SELECT coalesce(sum(n) FILTER (n > 1), 0) FROM (SELECT count(*) AS n FROM mig GROUP BY team_name, state, age_u, gender) g)::BIGINT AS duplicates,
    (SELECT coalesce(sum(n) FILTER (n > 1), 0) FROM (SELECT count(*) AS n FROM mig GROUP BY team_id) g)::BIGINT AS duplicate_ids FROM mig) a) b""", MIGRATED))
def d07_report(spark, sf):
    return rounded(quality.validation_report(_migrated(spark, sf)), "data_quality_score")


GAME_RULES = {
    **{f"{c}_missing": f"{c} IS NULL" for c in ("provider", "team_id_source", "team_id_master", "team_name", "opponent_name", "source_url")},
    "age_group_format": "NOT regexp_full_match(age_group, 'U(1[0-8]|[0-9])')", "gender_code": "gender NOT IN ('M', 'F')",
    "state_format": "NOT regexp_full_match(state, '[A-Z]{2}')", "state_unknown": f"state NOT IN {_STATES}",
    "game_date_format": "NOT regexp_full_match(game_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')", "home_away_code": "home_away NOT IN ('H', 'A')",
    "goals_for_negative": "try_cast(goals_for AS INTEGER) < 0", "goals_against_negative": "try_cast(goals_against AS INTEGER) < 0",
    "result_code": "result NOT IN ('W', 'L', 'D', 'U')", "scraped_at_format": f"NOT regexp_full_match(scraped_at, {_TS})",
}


@query("d07_schema_rules_games", with_ctes(_rules_sql("game_raw", GAME_RULES)))
def d07_games(spark, sf):
    return quality.rule_failures(A.game_raw(spark, sf), quality.game_rules())


CLUBS = {"clubs": """
SELECT club_name, state, min(scraped_at) AS first_seen_at, max(scraped_at) AS last_seen_at,
       coalesce(arg_min(city, scraped_at) FILTER (city <> ''), '') AS city, min(source_url) AS source_url
FROM game_raw WHERE club_name IS NOT NULL GROUP BY 1, 2"""}


@query("d07_schema_rules_clubs", with_ctes(_rules_sql("clubs", {
    "provider_missing": "FALSE", "club_name_missing": "club_name IS NULL", "source_url_missing": "source_url IS NULL",
    "state_format": "NOT regexp_full_match(state, '[A-Z]{2}')", "state_unknown": f"state NOT IN {_STATES}",
    "first_seen_format": f"NOT regexp_full_match(first_seen_at, {_TS})", "last_seen_format": f"NOT regexp_full_match(last_seen_at, {_TS})"}), CLUBS))
def d07_clubs(spark, sf):
    return quality.rule_failures(identity.club_lookup(A.game_raw(spark, sf), "feed"), quality.club_rules())


def _map_text(col):
    return joined(F.transform(F.map_entries(col), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))))


def _breakdown(c: str) -> str:
    return f"(SELECT string_agg({c} || ':' || n, ',' ORDER BY {c}) FROM (SELECT {c}, count(*) AS n FROM master m WHERE m.state = s.state GROUP BY 1) x)"


@query("d08_state_summary", f"""
SELECT state, count(*) AS teams, {_breakdown('provider')} AS provider_breakdown, {_breakdown('age_group')} AS age_breakdown, {_breakdown('gender')} AS gender_breakdown,
       least(count(*), 10) AS top_teams, 'build_20011102' AS last_build FROM master s GROUP BY state""")
def d08(spark, sf):
    s = quality.state_summary(_master(spark, sf), "build_20011102")
    return s.select("state", "teams", *[_map_text(F.col(c)).alias(c) for c in ("provider_breakdown", "age_breakdown", "gender_breakdown")], "top_teams", "last_build")


@query("d08_state_statistics", """
SELECT count(*) AS total_states, round(avg(n), 6) AS avg_teams_per_state, (SELECT state FROM master GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS max_teams_state,
       (SELECT state FROM master GROUP BY 1 ORDER BY count(*), 1 LIMIT 1) AS min_teams_state, (SELECT count(DISTINCT provider) FROM master) AS total_providers
FROM (SELECT state, count(*) AS n FROM master GROUP BY 1) s""")
def d08_stats(spark, sf):
    return rounded(quality.state_statistics(quality.state_summary(_master(spark, sf))), "avg_teams_per_state")


@query("d09_coverage_report", """
SELECT count(*) AS total_states, sum(n)::BIGINT AS total_teams, round(avg(n), 6) AS avg_teams_per_state, min(n) AS min_teams, max(n) AS max_teams,
       list_sort(list(n))[count(*) // 2 + 1] AS median_teams FROM (SELECT state, count(*) AS n FROM master GROUP BY 1) s""")
def d09(spark, sf):
    return rounded(quality.coverage_report(quality.state_summary(_master(spark, sf))), "avg_teams_per_state")


@query("d09_coverage_outliers", """
SELECT state, n AS teams, CASE WHEN n < m * 0.5 THEN 'low' ELSE 'high' END AS coverage
FROM (SELECT state, count(*) AS n, avg(count(*)) OVER () AS m FROM feed_us GROUP BY 1) s WHERE n < m * 0.5 OR n > m * 1.5""")
def d09_outliers(spark, sf):
    return quality.coverage_outliers(quality.state_summary(clean.normalize_states(A.feed(spark, sf))))


@query("d09_provider_coverage", "SELECT provider, count(DISTINCT state) AS states FROM master GROUP BY 1")
def d09_provider(spark, sf):
    return quality.provider_coverage(quality.state_summary(_master(spark, sf)))


@query("d09_single_state", "SELECT state, count(*) AS teams FROM master WHERE state = 'CA' GROUP BY 1")
def d09_state(spark, sf):
    return quality.state_coverage(quality.state_summary(_master(spark, sf)), "ca").select("state", "teams")


@query("d10_age_gender_cube", """
SELECT coalesce(state, 'USA') AS state, coalesce(gender, 'Total') AS gender, coalesce(age_group, 'Total') AS age_group, count(*) AS teams
FROM master GROUP BY GROUPING SETS ((state, gender, age_group), (state), (gender, age_group), ())""")
def d10(spark, sf):
    return quality.age_gender_cube(_master(spark, sf))


SCORE = """(0.25 * (trim(coalesce(team_name, '')) <> '')::INTEGER + 0.20 * (team_id IS NOT NULL)::INTEGER + 0.15 * (provider_team_id IS NOT NULL)::INTEGER
 + 0.10 * (age_group IS NOT NULL)::INTEGER + 0.10 * (age_u IS NOT NULL)::INTEGER + 0.10 * (gender IS NOT NULL)::INTEGER + 0.10 * (coalesce(state, '') <> '')::INTEGER
 + 0.05 * (coalesce(club_name, '') <> '')::INTEGER + 0.05 * (source_url IS NOT NULL)::INTEGER) / 1.1"""


@query("d11_completeness", with_ctes(f"SELECT custkey, copy, round({SCORE}, 6)::DOUBLE AS score FROM mig", MIGRATED))
def d11(spark, sf):
    m = _migrated(spark, sf)
    return m.select("custkey", "copy", F.round(delta.completeness(m.columns), 6).alias("score"))


@query("d12_merge_summary", f"""
SELECT count(*) AS total_teams, count(DISTINCT team_id) AS unique_team_ids, count(DISTINCT state) AS states_covered, count(*) FILTER (feeds > 1) AS multi_provider_teams,
       round(count(*) FILTER (feeds > 1) * 100.0::DOUBLE / count(*), 6) AS multi_provider_pct, round(max(best), 6)::DOUBLE AS max_completeness, round(min(best), 6)::DOUBLE AS min_completeness
FROM (SELECT team_id, any_value(state) AS state, count(DISTINCT provider) AS feeds, max({SCORE}) AS best FROM master GROUP BY 1) t""")
def d12(spark, sf):
    merged = delta.resolve_conflicts(_master(spark, sf))
    s = delta.merge_summary(merged).select("total_teams", "unique_team_ids", "states_covered", "multi_provider_teams", "multi_provider_pct",
                                           "max_completeness", "min_completeness")
    return rounded(s, "multi_provider_pct", "max_completeness", "min_completeness")


@query("d13_incremental_summary", "SELECT dimension, value, teams FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS dimension, {c} AS value, count(*) AS teams, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rn FROM master GROUP BY {c}"
    for c in ("state", "age_group", "gender")) + ") d WHERE rn <= 5")
def d13(spark, sf):
    return delta.top_counts(_master(spark, sf), ["state", "age_group", "gender"])


@query("d25_activity_metrics", """
SELECT count(*) AS total_teams, count(*) FILTER (last_seen_active_date >= '2001-07-08') AS active_teams, count(*) FILTER (last_seen_active_date < '2001-07-08') AS inactive_teams,
       0 AS teams_without_activity_date, round(count(*) FILTER (last_seen_active_date >= '2001-07-08') * 100.0::DOUBLE / count(*), 6) AS active_percentage,
       round(count(*) FILTER (last_seen_active_date < '2001-07-08') * 100.0::DOUBLE / count(*), 6) AS inactive_percentage FROM feed""")
def d25(spark, sf):
    m = quality.activity_metrics(A.feed(spark, sf), F.lit(AS_OF).cast("date"))
    return rounded(m, "active_percentage", "inactive_percentage")


@query("d33_game_statistics", """
SELECT count(*) AS games, count(DISTINCT team_id_master) AS teams, strftime(min(date), '%Y-%m-%d') AS first_date, strftime(max(date), '%Y-%m-%d') AS last_date,
       count(DISTINCT state) AS states, count(DISTINCT gender) AS genders, count(DISTINCT age_group) AS age_groups FROM game_norm""")
def d33(spark, sf):
    return quality.game_statistics(A.game_norm(spark, sf)).withColumns({"first_date": day_text("first_date"), "last_date": day_text("last_date")})


# ---------------------------------------------------------------- builds: one per month of orders

BUILDS = {
    "build_rows": """
SELECT strftime(o_orderdate, '%Y%m') || '01_0900' AS ts, date_trunc('month', o_orderdate)::DATE AS day, count(DISTINCT o_custkey) AS teams_total, count(DISTINCT o_custkey % 51) AS states_total,
       count(*) FILTER (o_orderstatus = 'O') AS added, count(*) FILTER (o_orderstatus = 'F') AS removed, count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority LIKE '1%') AS renamed,
       round(avg(o_totalprice) / 5000, 1) AS data_quality, sum(o_orderkey % 7)::BIGINT AS duration_seconds,
       CASE WHEN month(any_value(o_orderdate)) % 3 = 0 THEN 'full' ELSE 'incremental' END AS build_type FROM orders GROUP BY 1, 2""",
}


def builds_sql(body: str) -> str:
    return with_ctes(body, BUILDS)


def _builds(spark, sf):
    n = F.count_if
    return A.table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("ym")).agg(
        F.countDistinct("o_custkey").alias("teams_total"), F.countDistinct(F.col("o_custkey") % 51).alias("states_total"),
        n(F.col("o_orderstatus") == "O").alias("added"), n(F.col("o_orderstatus") == "F").alias("removed"),
        n((F.col("o_orderstatus") == "P") & F.startswith("o_orderpriority", F.lit("1"))).alias("renamed"),
        F.round(F.avg("o_totalprice") / 5000, 1).alias("data_quality"), F.sum(F.col("o_orderkey") % 7).alias("duration_seconds"),
    ).select(
        F.concat("ym", F.lit("01_0900")).alias("timestamp"), "*", F.col("states_total").alias("states_covered"),
        F.when(F.substring("ym", 5, 2).cast("int") % 3 == 0, "full").otherwise("incremental").alias("build_type")).drop("ym")


def _metrics(spark, sf):
    return _builds(spark, sf).select(
        F.concat(F.lit("build_"), "timestamp").alias("build_id"), F.col("teams_total").alias("team_count"), "states_covered",
        F.col("added").alias("new_teams"), F.col("duration_seconds").alias("build_duration_seconds"), F.col("data_quality").alias("data_quality_score"))




@query("d14_delta_trend", builds_sql("""
SELECT count(*) AS total_builds, sum(added)::BIGINT AS total_added, sum(removed)::BIGINT AS total_removed, sum(renamed)::BIGINT AS total_renamed, (sum(added) - sum(removed))::BIGINT AS net_growth,
       round((arg_max(teams_total, ts) - arg_min(teams_total, ts)) * 100.0::DOUBLE / arg_min(teams_total, ts), 6) AS growth_rate_percent,
       round(sum(added)::DOUBLE / count(*), 6) AS avg_added_per_build, round(sum(removed)::DOUBLE / count(*), 6) AS avg_removed_per_build FROM build_rows"""))
def d14(spark, sf):
    return rounded(delta.delta_trend(_builds(spark, sf)), "growth_rate_percent", "avg_added_per_build", "avg_removed_per_build")


@query("d15_compare_metrics", builds_sql("""
SELECT 'build_' || a.ts AS build1, 'build_' || b.ts AS build2, b.teams_total - a.teams_total AS team_count_change, b.states_total - a.states_total AS states_change,
       b.added AS new_teams, b.duration_seconds - a.duration_seconds AS build_duration_change, round(b.data_quality - a.data_quality, 4) AS data_quality_change
FROM build_rows a, build_rows b WHERE a.ts = (SELECT min(ts) FROM build_rows) AND b.ts = (SELECT max(ts) FROM build_rows)"""))
def d15(spark, sf):
    m = stage(_metrics(spark, sf), "metrics")
    ends = m.agg(F.min("build_id"), F.max("build_id")).first()
    return rounded(registry.compare_metrics(m, F.lit(ends[0]), F.lit(ends[1])), "data_quality_change", digits=4)


@query("d15_metrics_summary", builds_sql("""
SELECT count(*) AS total_builds, 'build_' || max(ts) AS latest_build, 'build_' || min(ts) AS earliest_build, """ + ", ".join(
    f"min({c}) AS min_{n}, max({c}) AS max_{n}, round(avg({c}), 6) AS avg_{n}, arg_max({c}, ts) AS latest_{n}"
    for c, n in (("teams_total", "teams"), ("states_total", "states"), ("duration_seconds", "duration"))) + " FROM build_rows"))
def d15_summary(spark, sf):
    return rounded(registry.metrics_summary(_metrics(spark, sf)), "avg_teams", "avg_states", "avg_duration")


@query("d16_metadata_summary", builds_sql("""
SELECT count(*) AS total_builds, max(ts) AS latest_timestamp, """ + ", ".join(
    f"arg_max({c}, ts) AS latest_{n}, min({c}) AS min_{n}, max({c}) AS max_{n}, round(avg({c}), 6) AS avg_{n}"
    for c, n in (("teams_total", "teams"), ("states_total", "states"), ("data_quality", "quality")))
    + ", arg_max(teams_total, ts) - arg_min(teams_total, ts) AS team_growth FROM build_rows"))
def d16(spark, sf):
    return rounded(registry.metadata_summary(_builds(spark, sf)), "avg_teams", "avg_states", "avg_quality")


@query("d16_history_summary", builds_sql("""
SELECT count(*) AS total_builds, arg_max(teams_total, ts) AS latest_teams, arg_max(states_total, ts) AS latest_states, sum(added)::BIGINT AS total_added, sum(removed)::BIGINT AS total_removed,
       sum(renamed)::BIGINT AS total_renamed, max(ts) AS latest_timestamp, round(sum(duration_seconds)::DOUBLE / count(*), 6) AS avg_duration, count(DISTINCT build_type) AS build_types FROM build_rows"""))
def d16_history(spark, sf):
    return rounded(registry.history_summary(_builds(spark, sf)), "avg_duration")


FILES = {"slice_files": """
SELECT o_orderstatus || '_' || substr(o_orderpriority, 1, 1) AS slice_key, 'build_' || strftime(o_orderdate, '%Y%m%d') || '_0900' AS build_id, o_orderdate::DATE AS d FROM orders"""}


def _latest(spark, sf):
    o = A.table(spark, sf, "orders").select(
        F.concat_ws("_", "o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias("slice_key"),
        F.concat(F.lit("build_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_0900")).alias("build_id"))
    return registry.latest_builds(o)


@query("d17_latest_builds", with_ctes("SELECT slice_key, max(build_id) AS latest_build FROM slice_files GROUP BY 1", FILES))
def d17(spark, sf):
    return _latest(spark, sf).select("slice_key", "latest_build")


@query("d17_registry_health", with_ctes("""
SELECT count(*) AS total_slices, count(*) FILTER (DATE '2001-08-08' - d > 7) AS stale_count, round(count(*) FILTER (DATE '2001-08-08' - d <= 7) * 100.0::DOUBLE / count(*), 6) AS registry_health
FROM (SELECT slice_key, max(d) AS d FROM slice_files GROUP BY 1) s""", FILES))
def d17_health(spark, sf):
    return rounded(registry.registry_health(_latest(spark, sf), F.lit("2001-08-08").cast("date")), "registry_health")


@query("d17_stale_slices", with_ctes("""
SELECT slice_key FROM (SELECT slice_key, max(d) AS d FROM slice_files GROUP BY 1) s WHERE DATE '2001-08-08' - d > 7""", FILES))
def d17_stale(spark, sf):
    return registry.stale_slices(_latest(spark, sf), F.lit("2001-08-08").cast("date")).select("slice_key")


@query("d18_build_search", builds_sql("SELECT ts AS timestamp, teams_total, added FROM build_rows WHERE build_type = 'full' AND states_total = 51"))
def d18(spark, sf):
    return registry.search_builds(_builds(spark, sf), {"build_type": "full", "states_total": 51}).select("timestamp", "teams_total", "added")


@query("d18_build_lookup", builds_sql("SELECT ts AS timestamp, teams_total FROM build_rows WHERE ts = '19970301_0900'"))
def d18_lookup(spark, sf):
    return registry.build_at(_builds(spark, sf), "19970301_0900").select("timestamp", "teams_total")


@query("d18_last_builds", builds_sql("SELECT ts AS timestamp, teams_total FROM build_rows ORDER BY ts DESC LIMIT 10"))
def d18_last(spark, sf):
    return registry.last_builds(_builds(spark, sf)).select("timestamp", "teams_total")


@query("d19_retention_split", builds_sql("SELECT ts AS timestamp, row_number() OVER (ORDER BY ts DESC) <= 20 AS retained FROM build_rows"))
def d19(spark, sf):
    return registry.retention_split(_builds(spark, sf)).select("timestamp", "retained")


# ---------------------------------------------------------------- D20-D24: identities

@query("d20_club_lookup", with_ctes("SELECT * FROM clubs", CLUBS))
def d20(spark, sf):
    return identity.club_lookup(A.game_raw(spark, sf), "feed").select("club_name", "state", "first_seen_at", "last_seen_at", "city", "source_url")


SIGHTINGS = {
    "seen": """
SELECT team_id, team_name, provider, provider_team_id, club_name, last_seen_active_date || '-' || lpad(custkey::VARCHAR, 9, '0') AS seen_at, custkey, copy FROM master""",
    "known_before": """
SELECT team_id, list_sort(list(DISTINCT team_name)) AS aliases, list_sort(list(DISTINCT club_name) FILTER (club_name IS NOT NULL)) AS clubs, arg_min(team_name, seen_at) AS canonical_name
FROM seen WHERE copy = 0 AND custkey % 2 = 0 GROUP BY 1""",
    "known_all": """
SELECT team_id, list_sort(list(DISTINCT team_name)) AS aliases, list_sort(list(DISTINCT club_name) FILTER (club_name IS NOT NULL)) AS clubs FROM seen GROUP BY 1""",
    "feed_ids": """
SELECT team_id, string_agg(provider || ':' || coalesce(pid, 'none'), ',' ORDER BY provider) AS provider_ids, count(*) AS n FROM (
  SELECT team_id, provider, arg_max(coalesce(provider_team_id, 'none'), seen_at) AS pid FROM seen GROUP BY 1, 2) f GROUP BY 1""",
}


def _sightings(spark, sf):
    return _master(spark, sf).select(
        "team_id", "team_name", "provider", F.coalesce("provider_team_id", F.lit("none")).alias("provider_team_id"), "club_name", "state", "gender", "age_group",
        F.concat("last_seen_active_date", F.lit("-"), F.lpad(F.col("custkey").cast("string"), 9, "0")).alias("seen_at"), "custkey", "copy")


def _identities(spark, sf):
    return identity.observe_identities(_sightings(spark, sf))


@query("d21_identity_map", with_ctes("""
SELECT k.team_id, array_to_string(aliases, '|') AS aliases, coalesce(array_to_string(clubs, '|'), '') AS club_history, provider_ids
FROM known_all k JOIN feed_ids f USING (team_id)""", SIGHTINGS))
def d21(spark, sf):
    i = _identities(spark, sf)
    return i.select("team_id", joined("aliases", "|").alias("aliases"), joined("club_history", "|").alias("club_history"),
                    _map_text(F.col("provider_ids")).alias("provider_ids"))


@query("d21_identity_upsert", with_ctes("""
SELECT a.team_id, array_to_string(a.aliases, '|') AS aliases, coalesce(array_to_string(a.clubs, '|'), '') AS club_history, b.team_id IS NULL AS is_new
FROM known_all a LEFT JOIN known_before b USING (team_id)""", SIGHTINGS))
def d21_upsert(spark, sf):
    s = _sightings(spark, sf)
    before = identity.observe_identities(s.where("copy = 0 AND custkey % 2 = 0"))
    merged = identity.upsert_identities(before, s)
    return merged.select("team_id", joined("aliases", "|").alias("aliases"), joined("club_history", "|").alias("club_history"), "is_new")


@query("d22_identity_summary", with_ctes("""
SELECT count(*) AS total_teams, sum(n)::BIGINT AS total_providers, sum(len(aliases))::BIGINT AS total_aliases, sum(coalesce(len(clubs), 0))::BIGINT AS total_clubs
FROM known_all JOIN feed_ids USING (team_id)""", SIGHTINGS))
def d22(spark, sf):
    return identity.identity_summary(_identities(spark, sf))


# ---------------------------------------------------------------- D26-D32, D34

@query("d26_team_record", """
SELECT team_id_master, count(*) AS games, count(*) FILTER (gf > ga) AS wins, count(*) FILTER (gf < ga) AS losses, count(*) FILTER (gf = ga) AS draws,
       round(count(*) FILTER (gf > ga) * 100.0::DOUBLE / count(*), 6) AS win_pct, sum(gf) AS gf_total, sum(ga) AS ga_total, sum(gf - ga) AS gd_total,
       round(avg(gf), 6) AS gf_avg, round(avg(ga), 6) AS ga_avg, round(avg(gf - ga), 6) AS gd_avg, count(*) FILTER (abs(gf - ga) >= 7) AS one_sided_games FROM game_norm GROUP BY 1""")
def d26(spark, sf):
    return rounded(reports.team_record(A.game_norm(spark, sf)), "win_pct", "gf_avg", "ga_avg", "gd_avg")


@query("d26_game_log", """
SELECT strftime(date, '%Y-%m-%d') AS date, opponent, gf, ga, gf - ga AS goal_diff, result FROM game_norm WHERE team_id_master = '1' ORDER BY date DESC""")
def d26_log(spark, sf):
    return reports.game_log(A.game_norm(spark, sf), "1").withColumn("date", day_text("date"))


RECORDS = {"opp_records": """
SELECT team AS opponent, count(*) AS games, count(*) FILTER (result = 'W') AS wins, count(*) FILTER (result = 'L') AS losses, count(*) FILTER (result = 'D') AS ties,
       count(*) FILTER (result = 'W')::DOUBLE / count(*) AS win_rate, avg(gf) AS gf_avg, avg(ga) AS ga_avg FROM game_norm GROUP BY 1"""}


@query("d27_scouting_table", with_ctes("""
SELECT opponent, games, wins, losses, ties, round(win_rate, 6) AS win_rate, round(gf_avg, 6) AS gf_avg, round(ga_avg, 6) AS ga_avg, games < 5 OR win_rate < 0.3 AS weak
FROM opp_records WHERE opponent IN (SELECT opponent FROM game_norm WHERE team = 'Supplier#000000001')""", RECORDS))
def d27(spark, sf):
    s = reports.scouting(A.game_norm(spark, sf), "Supplier#000000001").drop("goal_diff")
    return rounded(s, "win_rate", "gf_avg", "ga_avg")


@query("d27_scouting_all", with_ctes("""
SELECT team, count(*) AS opponents, count(*) FILTER (games < 5 OR win_rate < 0.3) AS weak_opponents, round(avg(games), 6) AS avg_opponent_games, round(avg(win_rate), 6) AS avg_opponent_win_rate
FROM (SELECT DISTINCT team, opponent FROM game_norm) g JOIN opp_records USING (opponent) GROUP BY 1""", RECORDS))
def d27_all(spark, sf):
    return rounded(reports.scouting_all(A.game_norm(spark, sf)), "avg_opponent_games", "avg_opponent_win_rate")


def _ranking(spark, sf):
    return R.rank_teams(A.game_norm(spark, sf), R.run_spec(A.as_of(spark, sf)), A.aliases(spark, sf))


SCORES = ("powerscore", "sao_norm", "sad_norm", "sos_norm")


@query("d28_score_distribution", " UNION ALL ".join(f"""
SELECT '{c}' AS metric, round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, count(*) AS teams,
       count(DISTINCT round({c}, 6)) AS distinct_values, round(count(*) FILTER (round({c}, 6) = (SELECT max(round({c}, 6)) FROM ranking WHERE scenario = 'baseline'))::DOUBLE / count(*), 6) AS share_at_max
FROM ranking WHERE scenario = 'baseline'""" for c in SCORES))
def d28(spark, sf):
    d = reports.score_distribution(stage(_ranking(spark, sf), "ranking"), SCORES).drop("at_max")
    return rounded(d, "min", "max", "mean", "std", "share_at_max")


PROBS = (0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)


@query("d28_score_percentiles", " UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS prob, round(quantile_cont(sos_norm, {p}), 6) AS value FROM ranking WHERE scenario = 'baseline'" for p in PROBS))
def d28_percentiles(spark, sf):
    return rounded(reports.score_percentiles(_ranking(spark, sf), "sos_norm", PROBS), "value")


@query("d29_score_by_state", """
SELECT state, count(*) AS teams, round(min(powerscore_adj), 6) AS min_score, round(max(powerscore_adj), 6) AS max_score, round(avg(powerscore_adj), 6) AS mean_score
FROM ranking WHERE scenario = 'baseline' GROUP BY 1""")
def d29(spark, sf):
    return rounded(reports.score_by_state(_ranking(spark, sf)), "min_score", "max_score", "mean_score")


@query("d30_contributions", """
SELECT team_id_master, rank, round(0.2 * sao_norm, 6) AS off_part, round(0.2 * sad_norm, 6) AS def_part, round(0.6 * sos_norm, 6) AS sos_part, round(powerscore, 6) AS total
FROM ranking WHERE scenario = 'baseline'""")
def d30(spark, sf):
    return rounded(reports.contributions(_ranking(spark, sf), BASELINE), "off_part", "def_part", "sos_part", "total")


@query("d31_standing", """
SELECT team_id_master, rank, round((1 - rank::DOUBLE / n) * 100, 6) AS percentile,
       CASE WHEN powerscore_adj >= q[3] THEN 'top1' WHEN powerscore_adj >= q[2] THEN 'top5' WHEN powerscore_adj >= q[1] THEN 'top10' ELSE 'rest' END AS tier,
       round(powerscore_adj - lead(powerscore_adj) OVER (ORDER BY rank), 6) AS gap_to_next
FROM ranking, (SELECT count(*) AS n, quantile_cont(powerscore_adj, [0.90, 0.95, 0.99]) AS q FROM ranking WHERE scenario = 'baseline') t WHERE scenario = 'baseline'""")
def d31(spark, sf):
    return rounded(reports.standing(_ranking(spark, sf)), "percentile", "gap_to_next")


@query("d32_state_rank_check", """
SELECT state, count(*) AS teams, bool_and(rank = rank_state) AS is_copy, TRUE AS is_dense FROM ranking WHERE scenario = 'baseline' GROUP BY 1""")
def d32(spark, sf):
    return reports.state_rank_check(R.state_view(_ranking(spark, sf)))


@query("d34_build_totals", """
SELECT 'build_' || strftime(date, '%Y%m') AS build_id, count(DISTINCT state || gender || age_group) AS total_slices,
       count(DISTINCT CASE WHEN ok THEN state || gender || age_group END) AS successful_slices, sum(teams)::BIGINT AS total_teams_processed, sum(games)::BIGINT AS total_games_scraped
FROM (SELECT date_trunc('month', date) AS date, state, gender, age_group, count(DISTINCT team_id_master) AS teams, count(*) AS games, count(*) >= 3 AS ok FROM game_norm GROUP BY 1, 2, 3, 4) s GROUP BY 1""")
def d34(spark, sf):
    results = A.game_norm(spark, sf).groupBy(
        F.concat(F.lit("build_"), F.date_format("date", "yyyyMM")).alias("build_id"), "state", "gender", "age_group"
    ).agg(F.countDistinct("team_id_master").alias("teams_processed"), F.count("*").alias("games_scraped")).withColumn(
        "success", F.col("games_scraped") >= 3)
    return quality.build_totals(results)
