"""Linking, membership, change-detection and integrity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom import adapters as A
from rankloom.catalog.base import query, rounded
from rankloom.catalog.sql import lst, scored_sql, tokens, with_ctes
from rankloom.operators import clean, delta, digests, integrity, link, reports
from rankloom.plans import ranking as R
from rankloom.storage import scratch_path, stage

# The master index of the game queries: some suppliers are missing, some are known by their feed id only.
MASTER_SQL = f"""
SELECT CASE WHEN s_suppkey % 8 = 1 THEN 'other-' || s_suppkey ELSE s_suppkey::VARCHAR END AS team_id_master,
       CASE WHEN s_suppkey % 8 < 6 THEN 'S' || s_suppkey END AS provider_team_id, s_name AS team_name,
       CASE WHEN s_suppkey % 4 <> 0 THEN 'Club ' || (s_nationkey % 7) END AS club_name, {lst(A.STATES_BY_NATION)}[s_nationkey + 1] AS state,
       CASE WHEN s_suppkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, 'U' || (10 + s_suppkey % 9) AS age_group
FROM supplier WHERE s_acctbal > 1000
UNION ALL SELECT 'twin-' || s_suppkey, 'S' || s_suppkey, 'Twin of ' || s_name, NULL, 'AZ', 'M', 'U10' FROM supplier WHERE s_acctbal > 1000 AND s_suppkey % 8 < 3"""
IDENT_SQL = "SELECT s_suppkey::VARCHAR AS team_id, ['Alpha ' || s_nationkey, 'Zeta ' || (s_suppkey % 5)] AS club_history FROM supplier WHERE s_suppkey % 6 = 0"
LINKED_SQL = """
SELECT g.*, p.team_id_master AS p_id, f.provider_team_id AS f_id, coalesce(p.team_name, f.team_name) AS team_name_master,
       coalesce(p.club_name, f.club_name) AS club_name_master, coalesce(p.state, f.state) AS state_master,
       CASE WHEN p.team_id_master IS NOT NULL THEN 'primary' WHEN f.provider_team_id IS NOT NULL THEN 'fallback' ELSE 'unlinked' END AS link_status
FROM game_raw g LEFT JOIN msx p ON g.team_id_master = p.team_id_master
LEFT JOIN (SELECT DISTINCT ON (provider_team_id) * FROM msx WHERE provider_team_id IS NOT NULL ORDER BY provider_team_id, team_id_master) f
  ON p.team_id_master IS NULL AND g.team_id_source = f.provider_team_id"""
EXTRA = {"msx": MASTER_SQL, "idents": IDENT_SQL, "linked": LINKED_SQL}


def sql(body: str) -> str:
    return with_ctes(body, EXTRA)


def _master(spark, sf):
    sk = F.col("s_suppkey")
    text = sk.cast("string")
    rows = A.table(spark, sf, "supplier").where("s_acctbal > 1000")
    # Some feed ids stand for two teams.
    twins = rows.where(sk % 8 < 3).select(
        F.concat(F.lit("twin-"), text).alias("team_id_master"), F.concat(F.lit("S"), text).alias("provider_team_id"),
        F.concat(F.lit("Twin of "), "s_name").alias("team_name"), F.lit(None).cast("string").alias("club_name"), F.lit("AZ").alias("state"),
        F.lit("M").alias("gender"), F.lit("U10").alias("age_group"))
    return rows.select(
        F.when(sk % 8 == 1, F.concat(F.lit("other-"), text)).otherwise(text).alias("team_id_master"),
        F.when(sk % 8 < 6, F.concat(F.lit("S"), text)).alias("provider_team_id"), F.col("s_name").alias("team_name"),
        F.when(sk % 4 != 0, F.concat(F.lit("Club "), (F.col("s_nationkey") % 7).cast("string"))).alias("club_name"),
        A.pick(A.STATES_BY_NATION, F.col("s_nationkey")).alias("state"),
        F.when(sk % 2 == 0, "M").otherwise("F").alias("gender"),
        F.concat(F.lit("U"), (10 + sk % 9).cast("string")).alias("age_group")).unionByName(twins)


def _identities(spark, sf):
    sk = F.col("s_suppkey")
    clubs = F.array(F.concat(F.lit("Alpha "), F.col("s_nationkey").cast("string")), F.concat(F.lit("Zeta "), (sk % 5).cast("string")))
    return A.table(spark, sf, "supplier").where(sk % 6 == 0).select(sk.cast("string").alias("team_id"), clubs.alias("club_history"))


def _linked(spark, sf):
    return link.link_games(A.game_raw(spark, sf), _master(spark, sf))


@query("c01_primary_link", sql("""
SELECT team_id_master, p_id IS NOT NULL AS linked_primary, CASE WHEN p_id IS NOT NULL THEN team_name_master END AS team_name_master, count(*) AS games FROM linked GROUP BY 1, 2, 3"""))
def c01(spark, sf):
    g = link.link_primary(A.game_raw(spark, sf), _master(spark, sf))
    return g.groupBy("team_id_master", "linked_primary", "team_name_master").agg(F.count("*").alias("games"))


@query("c02_fallback_link", sql("""
SELECT team_id_master, link_status, team_name_master, club_name_master, state_master, count(*) AS games FROM linked GROUP BY 1, 2, 3, 4, 5"""))
def c02(spark, sf):
    return _linked(spark, sf).groupBy("team_id_master", "link_status", "team_name_master", "club_name_master", "state_master").agg(
        F.count("*").alias("games"))


@query("c03_club_backfill", sql("""
SELECT team_id_master, coalesce(club_name, club_history[-1]) AS club_name, count(*) AS games FROM game_raw LEFT JOIN idents ON team_id = team_id_master GROUP BY 1, 2"""))
def c03(spark, sf):
    g = link.backfill_club(A.game_raw(spark, sf), _identities(spark, sf))
    return g.groupBy("team_id_master", "club_name").agg(F.count("*").alias("games"))


@query("c04_link_coverage", sql("""
SELECT count(*) AS total, count(*) FILTER (link_status <> 'unlinked') AS linked, round(count(*) FILTER (link_status <> 'unlinked') * 100.0::DOUBLE / count(*), 6) AS linked_pct FROM linked"""))
def c04(spark, sf):
    return rounded(link.link_coverage(_linked(spark, sf)), "linked_pct")


@query("c05_text_key_merge", """
SELECT s_name, count(*) AS games FROM lineitem JOIN supplier ON l_suppkey::VARCHAR = s_suppkey::VARCHAR GROUP BY 1""")
def c05(spark, sf):
    left = A.table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("int").alias("team_id_master"))
    right = A.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("team_id_master"), "s_name")
    return link.text_key_join(left, right, ["team_id_master"]).groupBy("s_name").agg(F.count("*").alias("games"))


@query("c06_opponent_strength_lookup", """
SELECT g.team_id_master, count(*) AS games, count(o.off_raw) AS known, round(sum(o.off_raw), 4) AS opp_off
FROM game_norm g LEFT JOIN (SELECT * FROM raw WHERE scenario = 'baseline') o ON g.opponent_id_master = o.team_id_master GROUP BY 1""")
def c06(spark, sf):
    games = A.game_norm(spark, sf)
    spec = R.run_spec(A.as_of(spark, sf))
    raw = stage(R.team_raw(R.select_games(games, spec), spec), "raw")
    g = link.strength_by_opponent(games.select("team_id_master", "opponent_id_master"), raw, ["off_raw"])
    return g.groupBy("team_id_master").agg(
        F.count("*").alias("games"), F.count("opp_off_raw").alias("known"), F.round(F.sum("opp_off_raw"), 4).alias("opp_off"))


@query("c07_alias_strength_map", "SELECT known_id, round(strength, 6) AS strength FROM lookup WHERE scenario = 'baseline'")
def c07(spark, sf):
    scored = R.rate_teams(A.game_norm(spark, sf), R.run_spec(A.as_of(spark, sf)), A.aliases(spark, sf))
    strengths = scored.select("scenario", "team_id_master", (0.5 * F.col("sao_shrunk") + 0.5 * F.col("sad_shrunk")).alias("strength"))
    found = R.alias_strengths(strengths, A.aliases(spark, sf), R.run_spec(A.as_of(spark, sf)))
    return rounded(found.select("known_id", "strength"), "strength")


# ---------------------------------------------------------------- two builds of the index

# Old and new build from the cleaned feed: some teams only in one, some renamed.
VERSIONS = {
    "old_build": "SELECT * FROM master WHERE custkey % 10 <> 1",
    "new_build": """
SELECT * EXCLUDE (team_name), CASE WHEN custkey % 10 = 3 THEN team_name || ' Gold' WHEN custkey % 10 = 7 THEN upper(team_name) || ' ' ELSE team_name END AS team_name
FROM master WHERE custkey % 10 <> 2""",
}


def versions(body: str) -> str:
    return with_ctes(body, VERSIONS)


def _builds(spark, sf):
    m = clean.migrate_master(A.feed(spark, sf), "2001-11-05T00:00:00").where("team_id IS NOT NULL")
    k = F.col("custkey") % 10
    name = F.when(k == 3, F.concat("team_name", F.lit(" Gold"))).when(k == 7, F.concat(F.upper("team_name"), F.lit(" "))).otherwise(F.col("team_name"))
    return m.where(k != 2).withColumn("team_name", name), m.where(k != 1)


KEY = "o.team_name IS NOT DISTINCT FROM n.team_name AND o.age_group IS NOT DISTINCT FROM n.age_group AND o.gender IS NOT DISTINCT FROM n.gender AND o.state IS NOT DISTINCT FROM n.state"


@query("c08_new_teams", versions(f"SELECT custkey, copy, team_name FROM new_build n WHERE NOT EXISTS (SELECT 1 FROM old_build o WHERE {KEY})"))
def c08(spark, sf):
    new, old = _builds(spark, sf)
    return delta.new_teams(new, old).select("custkey", "copy", "team_name")


@query("c08_new_teams_loose_keys", versions(
    "SELECT custkey, copy, team_name FROM new_build n WHERE NOT EXISTS (SELECT 1 FROM old_build o WHERE "
    + KEY.replace("o.team_name", "lower(trim(o.team_name))").replace("n.team_name", "lower(trim(n.team_name))") + ")"))
def c08_loose(spark, sf):
    new, old = _builds(spark, sf)
    return delta.new_teams(new, old, normalize_keys=True).select("custkey", "copy", "team_name")


@query("c09_new_teams_by_provider", versions(f"""
SELECT p.provider, coalesce(added, 0) AS added, 0 AS removed, 0 AS renamed FROM (SELECT DISTINCT provider FROM new_build) p LEFT JOIN (
  SELECT provider, count(*) AS added FROM new_build n WHERE NOT EXISTS (SELECT 1 FROM old_build o WHERE o.provider = n.provider AND {KEY}) GROUP BY 1) a USING (provider)"""))
def c09(spark, sf):
    return delta.new_teams_by_provider(*_builds(spark, sf))


CELLS = "o.age_group = n.age_group AND o.gender = n.gender AND o.state = n.state"


@query("c10_build_diff", versions(f"""
SELECT 'added' AS change, custkey, copy FROM new_build n WHERE NOT EXISTS (SELECT 1 FROM old_build o WHERE {CELLS})
UNION ALL SELECT 'removed', custkey, copy FROM old_build n WHERE NOT EXISTS (SELECT 1 FROM new_build o WHERE {CELLS})"""))
def c10(spark, sf):
    d = delta.compare_builds(*_builds(spark, sf))
    parts = [rows.select(F.lit(kind).alias("change"), "custkey", "copy") for kind, rows in d.items()]
    return parts[0].unionAll(parts[1])


@query("c10_build_diff_by_team", versions(f"""
SELECT 'added' AS change, custkey, copy FROM new_build n WHERE NOT EXISTS (SELECT 1 FROM old_build o WHERE {KEY})
UNION ALL SELECT 'removed', custkey, copy FROM old_build n WHERE NOT EXISTS (SELECT 1 FROM new_build o WHERE {KEY})"""))
def c10_team(spark, sf):
    d = delta.compare_builds(*_builds(spark, sf), delta.TEAM_KEY)
    parts = [rows.select(F.lit(kind).alias("change"), "custkey", "copy") for kind, rows in d.items()]
    return parts[0].unionAll(parts[1])


def jaccard_sql(a: str, b: str) -> str:
    return (f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0 ELSE len(list_intersect({a}, {b}))::DOUBLE / "
            f"len(list_distinct(list_concat({a}, {b}))) END")


def trigrams(expr: str) -> str:
    name = f"(' ' || array_to_string({tokens(expr)}, ' ') || ' ')"
    return f"CASE WHEN length({name}) > 2 THEN list_transform(range(1, length({name}) - 1), lambda i: substr({name}, i, 3)) ELSE [] END"


def renamed_sql(cut, least: float) -> str:
    return with_ctes(f"""
SELECT old_name AS old_team_name, n.team_name AS new_team_name, n.age_group, n.gender, n.state, round(score * 100, 6) AS similarity_score,
       n.rank AS new_rank, first_rank AS old_rank
FROM new_build n JOIN (
  SELECT *, row_number() OVER (PARTITION BY age_group, gender, state, new_name ORDER BY score DESC, old_name) AS rn FROM (
    SELECT n.age_group, n.gender, n.state, n.team_name AS new_name, o.team_name AS old_name, {jaccard_sql('n.words', 'o.words')} AS score
    FROM (SELECT DISTINCT age_group, gender, state, team_name, list_distinct({cut('team_name')}) AS words FROM new_build) n
    JOIN (SELECT DISTINCT age_group, gender, state, team_name, list_distinct({cut('team_name')}) AS words FROM old_build) o USING (age_group, gender, state)
    JOIN (SELECT age_group, gender, state FROM (SELECT age_group, gender, state, count(*) AS c FROM new_build GROUP BY 1, 2, 3) a
          JOIN (SELECT age_group, gender, state, count(*) AS c FROM old_build GROUP BY 1, 2, 3) b USING (age_group, gender, state) WHERE a.c <> b.c) u USING (age_group, gender, state)
  ) p WHERE score > {least}) b ON b.rn = 1 AND b.new_name = n.team_name AND b.age_group = n.age_group AND b.gender = n.gender AND b.state = n.state
JOIN (SELECT age_group, gender, state, team_name, arg_min(rank, rank * 1000000 + points) AS first_rank FROM old_build GROUP BY 1, 2, 3, 4) f
  ON f.team_name = b.old_name AND f.age_group = n.age_group AND f.gender = n.gender AND f.state = n.state""", VERSIONS)


def _renamed(spark, sf, scorer):
    found = delta.renamed_teams(*_builds(spark, sf), scorer=scorer)
    return rounded(found.select("old_team_name", "new_team_name", "age_group", "gender", "state", "similarity_score", "new_rank", "old_rank"),
                   "similarity_score")


@query("c11_renamed_teams", renamed_sql(tokens, 0.7))
def c11(spark, sf):
    return _renamed(spark, sf, "words")


@query("c11_renamed_by_letters", renamed_sql(trigrams, 0.5))
def c11_letters(spark, sf):
    return _renamed(spark, sf, "letters")


@query("c11_renamed_by_score", with_ctes(f"""
SELECT old_name AS old_team_name, n.team_name AS new_team_name, n.age_group, n.gender, n.state, round(score * 100, 6) AS similarity_score,
       n.rank AS new_rank, first_rank AS old_rank
FROM new_build n JOIN (
  SELECT *, row_number() OVER (PARTITION BY age_group, gender, state, a ORDER BY round(score, 9) DESC, old_name) AS rn FROM (
    SELECT age_group, gender, state, a, b AS old_name, score FROM ({scored_sql("SELECT * FROM side_pairs WHERE a <> b AND NOT settled")}) s
    UNION ALL SELECT age_group, gender, state, a, b, 1.0 FROM side_pairs WHERE a = b) p WHERE round(score, 9) > 0.7) b
  ON b.rn = 1 AND b.a = n.team_name AND b.age_group = n.age_group AND b.gender = n.gender AND b.state = n.state
JOIN (SELECT age_group, gender, state, team_name, arg_min(rank, rank * 1000000 + points) AS first_rank FROM old_build GROUP BY 1, 2, 3, 4) f
  ON f.team_name = b.old_name AND f.age_group = n.age_group AND f.gender = n.gender AND f.state = n.state""", {**VERSIONS, "side_pairs": """
SELECT *, bool_or(a = b) OVER (PARTITION BY age_group, gender, state, a) AS settled FROM (
  SELECT n.age_group, n.gender, n.state, n.team_name AS a, o.team_name AS b
  FROM (SELECT DISTINCT age_group, gender, state, team_name FROM new_build WHERE team_name <> '') n
  JOIN (SELECT DISTINCT age_group, gender, state, team_name FROM old_build WHERE team_name <> '') o USING (age_group, gender, state)
  JOIN (SELECT age_group, gender, state FROM (SELECT age_group, gender, state, count(*) AS c FROM new_build GROUP BY 1, 2, 3) a
        JOIN (SELECT age_group, gender, state, count(*) AS c FROM old_build GROUP BY 1, 2, 3) b USING (age_group, gender, state) WHERE a.c <> b.c) u USING (age_group, gender, state)) p"""}))
def c11_score(spark, sf):
    return _renamed(spark, sf, "weighted")


@query("c14_baseline_merge", versions("""
SELECT custkey, copy, team_id FROM old_build UNION ALL
SELECT custkey, copy, team_id FROM (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY custkey, copy) AS rn FROM new_build
  WHERE team_id NOT IN (SELECT team_id FROM old_build)) n WHERE rn = 1"""))
def c14(spark, sf):
    return delta.merge_with_baseline(*_builds(spark, sf), prefer=("custkey", "copy")).select("custkey", "copy", "team_id")


@query("c12_ranking_alignment", with_ctes("""
SELECT b.state, b.gender, b.age_group, b.team_id_master, b.rank AS rank_base, t.rank AS rank_test
FROM (SELECT * FROM ranking WHERE scenario = 'baseline') b JOIN (SELECT * FROM ranking WHERE scenario = 'sweep_max_games') t
USING (state, gender, age_group, team_id_master)"""))
def c12(spark, sf):
    from rankloom.config import scenarios
    from rankloom.plans import tuning as T
    wanted = {k: v for k, v in scenarios().items() if k in ("baseline", "sweep_max_games")}
    ranking = stage(T.sweep(A.game_norm(spark, sf), A.as_of(spark, sf), wanted, A.aliases(spark, sf)), "sweep")
    return T.align(ranking.where("scenario = 'baseline'"), ranking.where("scenario = 'sweep_max_games'"))


# ---------------------------------------------------------------- integrity

HASHES = {
    "stored_orders": "SELECT *, o_orderdate::DATE AS d, o_totalprice AS price FROM orders WHERE o_orderkey % 33 <> 1",
    "current_orders": "SELECT *, o_orderdate::DATE AS d, CASE WHEN o_orderkey % 20 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 33 <> 2",
    "status_rows": """
SELECT coalesce(s.o_orderstatus, c.o_orderstatus) AS slice_key, coalesce(s.o_orderkey, c.o_orderkey) AS k,
       CASE WHEN c.o_orderkey IS NULL THEN 'deleted' WHEN s.o_orderkey IS NULL THEN 'new' WHEN s.price <> c.price THEN 'modified' ELSE 'unchanged' END AS status
FROM stored_orders s FULL JOIN current_orders c ON s.o_orderkey = c.o_orderkey AND s.o_orderstatus = c.o_orderstatus""",
    "slice_report": """
SELECT slice_key, count(*) FILTER (status = 'modified') AS modified, count(*) FILTER (status = 'deleted') AS deleted, count(*) FILTER (status = 'new') AS new,
       count(*) FILTER (status <> 'new') AS total_stored, count(*) FILTER (status <> 'deleted') AS total_current,
       round(count(*) FILTER (status = 'unchanged') * 100.0::DOUBLE / count(*), 2) AS integrity_score,
       count(*) FILTER (status = 'modified') > 0.05 * count(*) FILTER (status <> 'new') OR count(*) FILTER (status = 'deleted') > 0
       OR count(*) FILTER (status = 'unchanged') * 100.0 / count(*) < 95 AS needs_refresh
FROM status_rows GROUP BY 1""",
}


def _order_games(spark, sf, current: bool):
    """Orders as games of their status slice, in the stored or the current version."""
    key = F.col("o_orderkey")
    price = F.when(key % 20 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")) if current else F.col("o_totalprice")
    return A.table(spark, sf, "orders").where(key % 33 != (2 if current else 1)).select(
        F.col("o_orderstatus").alias("slice_key"), key.cast("string").alias("team_id_source"),
        F.col("o_custkey").cast("string").alias("opponent_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("game_date"),
        price.alias("goals_for"), F.lit(None).cast("double").alias("goals_against"), F.lit("H").alias("home_away"))


def _diff(spark, sf):
    hashes = [integrity.hash_games(_order_games(spark, sf, c), ["slice_key"]) for c in (False, True)]
    return integrity.diff_hashes(hashes[0], hashes[1], ["slice_key"])


@query("c13_game_integrity_diff", with_ctes("""
SELECT slice_key, 'game_' || k || '_' || strftime(o_orderdate, '%Y-%m-%d') AS game_id, status FROM status_rows JOIN orders ON o_orderkey = k""", HASHES))
def c13(spark, sf):
    return _diff(spark, sf)


@query("c13_digest_diff", with_ctes("""
SELECT slice_key, 'game_' || k || '_' || strftime(o_orderdate, '%Y-%m-%d') AS game_id, status FROM status_rows JOIN orders ON o_orderkey = k""", HASHES))
def c13_digests(spark, sf):
    folder = scratch_path(spark, "hash-store")
    stored, current = (integrity.hash_games(_order_games(spark, sf, c), ["slice_key"]) for c in (False, True))
    digests.write_store(stored, folder, ["slice_key"])
    return digests.diff_store(current, folder, ["slice_key"])


@query("c13_game_hash", """
SELECT 'game_' || team_id_source || '_' || game_date AS game_id, max(sha256('team_id_source:' || team_id_source || '|opponent_id:' || coalesce(opponent_id, 'NULL') || '|game_date:' || game_date
  || '|goals_for:' || coalesce(goals_for, 'NULL') || '|goals_against:' || coalesce(goals_against, 'NULL') || '|home_away:' || home_away)) AS game_hash
FROM game_raw GROUP BY 1""")
def c13_hash(spark, sf):
    return integrity.hash_games(A.game_raw(spark, sf))


@query("c13_integrity_report", with_ctes("SELECT * FROM slice_report", HASHES))
def c13_report(spark, sf):
    return integrity.integrity_report(_diff(spark, sf), ["slice_key"])


@query("d35_integrity_rollup", with_ctes("""
SELECT count(*) AS total_slices, count(*) FILTER (needs_refresh) AS slices_needing_refresh, round(avg(integrity_score), 2) AS overall_score FROM slice_report""", HASHES))
def d35(spark, sf):
    return integrity.integrity_rollup(integrity.integrity_report(_diff(spark, sf), ["slice_key"]))


# ---------------------------------------------------------------- progress

PROGRESS = {"progress": "SELECT team_id_master, max(date) AS last_scraped FROM game_norm WHERE age_group IN ('U10', 'U12', 'U14') GROUP BY 1"}


def _progress(spark, sf):
    return A.game_norm(spark, sf).where(F.col("age_group").isin("U10", "U12", "U14")).groupBy("team_id_master").agg(
        F.max("date").alias("last_scraped"))


@query("c15_resume_filter", with_ctes("SELECT team_id_master FROM msx WHERE team_id_master NOT IN (SELECT team_id_master FROM progress)", {**EXTRA, **PROGRESS}))
def c15(spark, sf):
    return link.remaining_teams(_master(spark, sf), _progress(spark, sf)).select("team_id_master")


@query("c16_freshness_filter", with_ctes("""
SELECT m.team_id_master FROM msx m LEFT JOIN progress p USING (team_id_master) WHERE NOT coalesce((SELECT d FROM as_of) - last_scraped < 7, FALSE)""", {**EXTRA, **PROGRESS}))
def c16(spark, sf):
    as_of = F.lit(A.as_of(spark, sf)).cast("date")
    return link.stale_teams(_master(spark, sf), _progress(spark, sf), as_of).select("team_id_master")


# ---------------------------------------------------------------- opponents

@query("c17_opponent_presence", """
SELECT m.team_id_master, m.opponent_id_master, games_vs, opp_gf IS NOT NULL AS present, opp_gf - opp_ga AS opp_gd
FROM (SELECT team_id_master, opponent_id_master, count(*) AS games_vs FROM game_norm WHERE opponent_id_master IS NOT NULL GROUP BY 1, 2) m
LEFT JOIN (SELECT team_id_master AS id, sum(gf) AS opp_gf, sum(ga) AS opp_ga FROM game_norm GROUP BY 1) o ON id = m.opponent_id_master""")
def c17(spark, sf):
    return reports.opponent_presence(A.game_norm(spark, sf)).select("team_id_master", "opponent_id_master", "games_vs", "present", "opp_gd")


@query("c18_ranked_opponents", """
SELECT m.team_id_master, m.opponent_id_master, r.rank AS opp_rank, round(powerscore_adj, 6) AS opp_score
FROM (SELECT DISTINCT team_id_master, opponent_id_master FROM game_norm) m JOIN ranking r ON r.team_id_master = m.opponent_id_master AND scenario = 'baseline'""")
def c18(spark, sf):
    games = A.game_norm(spark, sf)
    ranking = R.rank_teams(games, R.run_spec(A.as_of(spark, sf)), A.aliases(spark, sf))
    return rounded(reports.ranked_opponents(games, ranking), "opp_score")


@query("c19_two_hop_network", """
SELECT count(*) AS network_teams, (SELECT count(DISTINCT team_id_master) FROM game_norm) AS total_teams,
       round(count(*)::DOUBLE / (SELECT count(DISTINCT team_id_master) FROM game_norm), 6) AS connectivity_ratio FROM (
  SELECT opponent_id_master AS n FROM game_norm WHERE team_id_master = '3' AND opponent_id_master IS NOT NULL
  UNION SELECT b.opponent_id_master FROM game_norm a JOIN game_norm b ON a.opponent_id_master = b.team_id_master WHERE a.team_id_master = '3' AND b.opponent_id_master IS NOT NULL
  UNION SELECT '3') x""")
def c19(spark, sf):
    return rounded(reports.two_hop(A.game_norm(spark, sf), "3"), "connectivity_ratio")


@query("c19_all_teams", with_ctes("""
SELECT t AS team_id_master, count(*) AS network_teams FROM (
  SELECT t, o AS n FROM met_once UNION SELECT a.t, b.o FROM met_once a JOIN met_once b ON a.o = b.t UNION SELECT team_id_master, team_id_master FROM game_norm) x GROUP BY 1""",
    {"met_once": "SELECT DISTINCT team_id_master AS t, opponent_id_master AS o FROM game_norm WHERE opponent_id_master IS NOT NULL"}))
def c19_all(spark, sf):
    return reports.two_hop_all(A.game_norm(spark, sf))


@query("c20_id_overlap", sql("""
SELECT (SELECT count(DISTINCT team_id_master) FROM game_norm) AS team_ids, (SELECT count(DISTINCT opponent_id_master) FROM game_norm) AS opponent_ids,
       (SELECT count(DISTINCT team_id_master) FROM msx) AS master_ids,
       (SELECT count(DISTINCT team_id_master) FROM game_norm WHERE team_id_master IN (SELECT opponent_id_master FROM game_norm)) AS team_and_opponent,
       (SELECT count(DISTINCT team_id_master) FROM game_norm WHERE team_id_master IN (SELECT team_id_master FROM msx)) AS team_and_master,
       (SELECT count(DISTINCT opponent_id_master) FROM game_norm WHERE opponent_id_master IN (SELECT team_id_master FROM msx)) AS opponent_and_master"""))
def c20(spark, sf):
    return link.id_overlap(A.game_norm(spark, sf), _master(spark, sf))


@query("c21_head_to_head", """
SELECT team_id_master, count(*) AS games, count(*) FILTER (gf > ga) AS wins, count(*) FILTER (gf < ga) AS losses, count(*) FILTER (gf = ga) AS draws,
       sum(gf) AS gf_total, sum(ga) AS ga_total, sum(gf - ga) AS gd_total FROM game_norm WHERE team_id_master IN ('1', '2') GROUP BY 1""")
def c21(spark, sf):
    return reports.head_to_head(A.game_norm(spark, sf), "1", "2").select(
        "team_id_master", "games", "wins", "losses", "draws", "gf_total", "ga_total", "gd_total")


@query("c22_alias_resolution", """
SELECT o.opponent_id_master, coalesce(canonical_id, clean) AS resolved_id, canonical_id IS NOT NULL AS alias_found, coalesce(n, 0) AS games_as_team
FROM (SELECT DISTINCT opponent_id_master, regexp_replace(trim(opponent_id_master), '\\.0$', '') AS clean FROM game_norm WHERE opponent_id_master IS NOT NULL) o
LEFT JOIN alias ON alias_id = clean LEFT JOIN (SELECT team_id_master, count(*) AS n FROM game_norm GROUP BY 1) t ON t.team_id_master = coalesce(canonical_id, clean)""")
def c22(spark, sf):
    return reports.alias_resolution(A.game_norm(spark, sf), A.aliases(spark, sf))
