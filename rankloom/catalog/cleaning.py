"""Projection, filter, cleaning and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom import adapters as A
from rankloom.catalog.base import day_text, joined, query, rounded
from rankloom.catalog.sql import AGE_CASE, GENDER_CASE, inlist, lst, tokens
from rankloom.functions import games as fgames
from rankloom.functions import ids, text
from rankloom.operators import clean, delta, windows
from rankloom.schemas import NON_US, REGION_TO_STATE, REQUIRED_GAME, US_STATES

GAME_COLS = "team_id_master, opponent_id_master, team, opponent, club, state, gender, age_group"
AS_OF = "2001-11-05"


@query("b01_schema_mapping", """
SELECT team_id_master, opponent_id AS opponent_id_master, team_name AS team, opponent_name AS opponent, club_name AS club,
       game_date AS date, goals_for AS gf, goals_against AS ga FROM game_raw""")
def b01(spark, sf):
    g = clean.rename_game_columns(A.game_raw(spark, sf))
    return g.select("team_id_master", "opponent_id_master", "team", "opponent", "club", "date", "gf", "ga")


@query("b02_required_columns", "SELECT state, count(*) AS games FROM game_raw GROUP BY 1")
def b02(spark, sf):
    g = clean.require_columns(clean.rename_game_columns(A.game_raw(spark, sf)), REQUIRED_GAME)
    return g.groupBy("state").agg(F.count("*").alias("games"))


@query("b03_coerce_and_drop", "SELECT team_id_master, strftime(date, '%Y-%m-%d') AS date, gf, ga FROM game_clean")
def b03(spark, sf):
    return clean.normalize_games(A.game_raw(spark, sf)).select("team_id_master", day_text("date"), "gf", "ga")


@query("b04_slice_filter", """
SELECT team_id_master, strftime(date, '%Y-%m-%d') AS date, gf, ga FROM game_norm
WHERE state = (SELECT min(state) FROM game_norm) AND gender IN ('M', 'F') AND age_group IN ('U10', 'U11', 'U12', 'U13', 'U14', 'U15')""")
def b04(spark, sf):
    games = A.game_norm(spark, sf)
    first = games.agg(F.min("state")).first()[0]
    return clean.slice_filter(games, first, ["M", "F"], [f"U{a}" for a in range(10, 16)]).select("team_id_master", day_text("date"), "gf", "ga")


@query("b04_national_filter", """
SELECT state, count(*) AS games FROM game_norm WHERE gender IN ('F') AND age_group IN ('U11', 'U12') GROUP BY 1""")
def b04_national(spark, sf):
    return clean.slice_filter(A.game_norm(spark, sf), None, ["F"], ["U11", "U12"]).groupBy("state").agg(F.count("*").alias("games"))


@query("b05_time_window", """
SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS games FROM game_norm WHERE date >= (SELECT d FROM as_of) - 365 GROUP BY 1""")
def b05(spark, sf):
    from rankloom.plans.ranking import within_window
    g = within_window(A.game_norm(spark, sf), F.lit(A.as_of(spark, sf)).cast("date"), 365)
    return g.groupBy("date").agg(F.count("*").alias("games")).select(day_text("date"), "games")


@query("b06_link_quality", """
SELECT round(avg(CASE WHEN team_id_master IS NULL OR team_id_master = '' THEN 1.0 ELSE 0 END), 6)::DOUBLE AS missing_team,
       round(avg(CASE WHEN opponent_id_master IS NULL OR opponent_id_master = '' THEN 1.0 ELSE 0 END), 6)::DOUBLE AS missing_opponent,
       round(avg(CASE WHEN opponent_id_master IN (SELECT team_id_master FROM game_norm) THEN 1.0 ELSE 0 END), 6)::DOUBLE AS overlap FROM game_norm""")
def b06(spark, sf):
    return rounded(clean.link_quality(A.game_norm(spark, sf)), "missing_team", "missing_opponent", "overlap")


@query("b07_state_normalization", "SELECT custkey, copy, state FROM feed_us")
def b07(spark, sf):
    return clean.normalize_states(A.feed(spark, sf)).select("custkey", "copy", "state")


@query("b08_valid_states", f"SELECT DISTINCT state FROM feed WHERE state IS NOT NULL AND state NOT IN {inlist(NON_US)}")
def b08(spark, sf):
    return clean.valid_states(A.feed(spark, sf))


@query("b08_state_statistics", f"""
SELECT state, count(*) AS teams, CASE {' '.join(f"WHEN state = '{k}' THEN '{v}'" for k, v in REGION_TO_STATE.items())} END AS maps_to,
       state IN {inlist(NON_US)} AS non_us FROM feed WHERE state IS NOT NULL GROUP BY 1""")
def b08_stats(spark, sf):
    return clean.state_statistics(A.feed(spark, sf))


@query("b08_top_states", "SELECT state, count(*) AS teams FROM feed WHERE state IS NOT NULL GROUP BY 1 ORDER BY teams DESC, state LIMIT 10")
def b08_top(spark, sf):
    return clean.top_states(A.feed(spark, sf))


@query("b09_gender_normalization", f"SELECT gender AS raw, {GENDER_CASE} AS gender, count(*) AS teams FROM feed GROUP BY 1, 2")
def b09(spark, sf):
    return A.feed(spark, sf).groupBy(F.col("gender").alias("raw")).agg(F.count("*").alias("teams")).withColumn(
        "gender", ids.gender_code(F.col("raw")))


@query("b10_age_extraction", f"SELECT custkey, copy, age_group, {AGE_CASE} AS age_u FROM feed")
def b10(spark, sf):
    return A.feed(spark, sf).select("custkey", "copy", "age_group", ids.age_number(F.col("age_group")).alias("age_u"))


VALID = f"trim(team_name) <> '' AND length(trim(state)) = 2 AND {AGE_CASE} IS NOT NULL AND {GENDER_CASE} IS NOT NULL"


@query("b11_team_id", f"""
SELECT custkey, copy, CASE WHEN {VALID} THEN substr(sha1(lower(trim(team_name)) || '|' || upper(trim(state)) || '|' || {AGE_CASE} || '|' || {GENDER_CASE}), 1, 12) END AS team_id
FROM feed""")
def b11(spark, sf):
    return clean.with_identity(A.feed(spark, sf)).select("custkey", "copy", "team_id")


@query("b11_team_id_rejects", f"""
SELECT custkey, copy, CASE WHEN {AGE_CASE} IS NULL THEN 'age' WHEN {GENDER_CASE} IS NULL THEN 'gender'
  WHEN coalesce(trim(team_name), '') = '' THEN 'name' WHEN coalesce(trim(state), '') = '' THEN 'state_empty' ELSE 'state_length' END AS reason
FROM feed WHERE NOT coalesce({VALID}, FALSE)""")
def b11_rejects(spark, sf):
    return clean.split_rejects(A.feed(spark, sf))[1].select("custkey", "copy", "reason")


@query("b12_master_migration", """
SELECT custkey, copy, CASE WHEN age_u IS NOT NULL AND gender IS NOT NULL AND trim(team_name) <> '' THEN team_id END AS team_id,
       provider_team_id, team_name, age_group, age_u, gender, state, provider, club_name, source_url, '2001-11-05T00:00:00' AS created_at, rank, points
FROM migrated""")
def b12(spark, sf):
    m = clean.migrate_master(A.feed(spark, sf), "2001-11-05T00:00:00")
    return m.select("custkey", "copy", *clean.MASTER_COLUMNS, "rank", "points")


@query("b13_index_normalization", "SELECT team_name, age_group, gender, state, rank, points, source, provider, url FROM feed_us ORDER BY state, age_group, gender, rank")
def b13(spark, sf):
    return clean.normalize_index(A.feed(spark, sf))


@query("b14_active_teams", """
SELECT custkey, copy, last_seen_active_date FROM feed
WHERE coalesce(try_strptime(last_seen_active_date, '%Y-%m-%d')::DATE >= DATE '2001-11-05' - 120, TRUE)""")
def b14(spark, sf):
    return clean.active_teams(A.feed(spark, sf), F.lit(AS_OF).cast("date")).select("custkey", "copy", "last_seen_active_date")


@query("b15_recent_games", """
SELECT team_id_master, strftime(date, '%Y-%m-%d') AS date, count(*) AS games FROM (
  SELECT *, count(*) OVER (PARTITION BY team_id_master) AS n FROM game_norm WHERE date >= (SELECT d FROM as_of) - INTERVAL 12 MONTH) g
WHERE n >= 10 GROUP BY 1, 2""")
def b15(spark, sf):
    as_of = F.lit(A.as_of(spark, sf)).cast("date")
    g = clean.recent_team_games(A.game_norm(spark, sf).select("team_id_master", "date"), as_of, 12, 10, date_col="date")
    return g.groupBy("team_id_master", "date").agg(F.count("*").alias("games")).withColumn("date", day_text("date"))


@query("b16_last_activity", """
SELECT custkey, copy, coalesce(CASE WHEN custkey % 3 > 0 THEN last_seen_active_date END,
       CASE WHEN rank % 2 = 0 THEN '2001-01-01' END, '2000-12-31') AS last_activity FROM feed""")
def b16(spark, sf):
    f = A.feed(spark, sf).select(
        "custkey", "copy",
        F.when(F.col("custkey") % 3 > 0, F.col("last_seen_active_date")).otherwise("unknown").alias("last_seen_active_date"),
        F.when(F.col("rank") % 2 == 0, "2001-01-01").alias("last_active_date"),
        F.lit("2000-12-31T08:00:00").alias("last_game_date"))
    return f.select("custkey", "copy", F.date_format(clean.last_activity_date(f.columns), "yyyy-MM-dd").alias("last_activity"))


@query("b17_canonical_id", """
SELECT opponent_id_master, coalesce(canonical_id, clean) AS resolved, games FROM (
  SELECT opponent_id_master, regexp_replace(trim(opponent_id_master), '\\.0$', '') AS clean, count(*) AS games FROM game_norm GROUP BY 1, 2) g
LEFT JOIN alias ON alias_id = clean""")
def b17(spark, sf):
    counts = A.game_norm(spark, sf).groupBy("opponent_id_master").agg(F.count("*").alias("games"))
    return ids.resolve_alias(counts.withColumn("resolved", F.col("opponent_id_master")), "resolved", A.aliases(spark, sf))


@query("b18_result_code", """
SELECT result, count(*) AS games FROM (SELECT CASE WHEN try_cast(goals_for AS INTEGER) IS NULL OR try_cast(goals_against AS INTEGER) IS NULL THEN 'U'
  WHEN try_cast(goals_for AS INTEGER) > try_cast(goals_against AS INTEGER) THEN 'W'
  WHEN try_cast(goals_for AS INTEGER) < try_cast(goals_against AS INTEGER) THEN 'L' ELSE 'D' END AS result FROM game_raw) g GROUP BY 1""")
def b18(spark, sf):
    g = A.game_raw(spark, sf).select(F.col("goals_for").try_cast("int").alias("goals_for"), F.col("goals_against").try_cast("int").alias("goals_against"))
    return clean.with_result(g).groupBy("result").agg(F.count("*").alias("games"))


@query("b19_result_text", """
SELECT txt, try_cast(regexp_extract(upper(trim(txt)), '([0-9]+)\\s*[-:]\\s*([0-9]+)', 1) AS INTEGER) AS goals_for,
       try_cast(regexp_extract(upper(trim(txt)), '([0-9]+)\\s*[-:]\\s*([0-9]+)', 2) AS INTEGER) AS goals_against,
       CASE WHEN contains(upper(txt), '(H)') THEN 'H' WHEN contains(upper(txt), '(A)') THEN 'A' ELSE 'H' END AS home_away,
       CASE WHEN substr(upper(trim(txt)), 1, 1) IN ('W', 'L', 'D') THEN substr(upper(trim(txt)), 1, 1) ELSE 'U' END AS result, count(*) AS games
FROM (SELECT CASE WHEN gf = 3 THEN 'forfeit' ELSE ' ' || lower(result) || ' ' || gf::INTEGER || CASE WHEN ga = 2 THEN ' : ' ELSE '-' END || ga::INTEGER
      || CASE WHEN home_away = 'H' THEN ' (h)' WHEN ga = 1 THEN '' ELSE ' (a)' END END AS txt FROM game_norm) g GROUP BY txt""")
def b19(spark, sf):
    num = lambda c: F.col(c).cast("int").cast("string")
    txt = F.when(F.col("gf") == 3, "forfeit").otherwise(F.concat(
        F.lit(" "), F.lower("result"), F.lit(" "), num("gf"), F.when(F.col("ga") == 2, " : ").otherwise("-"), num("ga"),
        F.when(F.col("home_away") == "H", " (h)").when(F.col("ga") == 1, "").otherwise(" (a)")))
    g = A.game_norm(spark, sf).select(txt.alias("txt")).groupBy("txt").agg(F.count("*").alias("games"))
    return g.select("txt", fgames.parse_result_text(F.col("txt")).alias("r"), "games").select("txt", "r.*", "games")


@query("b20_flexible_date", """
SELECT txt, CASE WHEN k < 4 THEN strftime(d, '%Y-%m-%d') END AS parsed FROM (
  SELECT o_orderkey % 5 AS k, o_orderdate::DATE AS d, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN 2 THEN strftime(o_orderdate, '%m/%d/%y') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT10:30:00') ELSE 'week ' || o_orderkey END AS txt
  FROM orders) o""")
def b20(spark, sf):
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 5
    fmt = lambda p: F.date_format(day, p)
    txt = F.when(k == 0, fmt("yyyy-MM-dd")).when(k == 1, fmt("MM/dd/yyyy")).when(k == 2, fmt("MM/dd/yy")).when(
        k == 3, fmt("yyyy-MM-dd'T10:30:00'")).otherwise(F.concat(F.lit("week "), F.col("o_orderkey").cast("string")))
    parsed = fgames.flexible_date(F.col("txt"))
    return A.table(spark, sf, "orders").select(txt.alias("txt")).select("txt", F.date_format(parsed, "yyyy-MM-dd").alias("parsed"))


@query("b21_opponent_from_title", """
SELECT title, opponent_name, count(*) AS games FROM (
  SELECT CASE WHEN gf = 5 THEN team || ' v ' || opponent WHEN home_away = 'H' THEN team || ' vs. ' || opponent ELSE opponent || ' vs. ' || team END AS title,
         CASE WHEN gf = 5 AND ga = 0 THEN 'Unknown' ELSE opponent END AS opponent_name FROM game_norm) g GROUP BY 1, 2""")
def b21(spark, sf):
    vs = lambda a, b: F.concat(F.col(a), F.lit(" vs. "), F.col(b))
    title = F.when(F.col("gf") == 5, F.concat("team", F.lit(" v "), "opponent")).when(
        F.col("home_away") == "H", vs("team", "opponent")).otherwise(vs("opponent", "team"))
    fallback = F.when(~((F.col("gf") == 5) & (F.col("ga") == 0)), F.col("opponent"))
    g = A.game_norm(spark, sf).select(title.alias("title"), "team", fallback.alias("fallback"))
    return g.select("title", fgames.opponent_from_title(F.col("title"), F.col("team"), F.col("fallback")).alias("opponent_name")).groupBy(
        "title", "opponent_name").agg(F.count("*").alias("games"))


@query("b22_game_record_cleaning", """
SELECT team_id_source, team_name, opponent_name, CASE WHEN regexp_full_match(game_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN game_date END AS game_date,
       try_cast(goals_for AS INTEGER) AS goals_for, try_cast(goals_against AS INTEGER) AS goals_against, trim(venue) AS venue, count(*) AS games
FROM game_raw GROUP BY ALL""")
def b22(spark, sf):
    g = clean.clean_game_records(A.game_raw(spark, sf).withColumn("venue", F.concat(F.lit(" "), "venue", F.lit(" "))))
    cols = ["team_id_source", "team_name", "opponent_name", "game_date", "goals_for", "goals_against", "venue"]
    return g.groupBy(*cols).agg(F.count("*").alias("games"))


@query("b23_completeness_check", """
SELECT array_to_string(list_filter([CASE WHEN opponent_id IS NULL THEN 'opponent_id' END, CASE WHEN club_name IS NULL THEN 'club_name' END,
       CASE WHEN goals_for IS NULL THEN 'goals_for' END], lambda x: x IS NOT NULL), ',') AS missing, count(*) AS games
FROM game_raw WHERE opponent_id IS NULL OR club_name IS NULL OR goals_for IS NULL GROUP BY 1""")
def b23(spark, sf):
    rejected = clean.split_complete(A.game_raw(spark, sf), ["opponent_id", "club_name", "goals_for"])[1]
    return rejected.groupBy(joined("missing").alias("missing")).agg(F.count("*").alias("games"))


@query("b24_points_and_state", f"""
SELECT doc_id, coalesce(try_cast(regexp_extract(text, '([0-9]+)', 1) AS BIGINT), 0) AS points,
       coalesce(list_filter(regexp_extract_all(upper(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda w: w IN {inlist(US_STATES)})[1], '') AS state FROM documents""")
def b24(spark, sf):
    docs = A.table(spark, sf, "documents")
    return docs.select("doc_id", text.first_number(F.col("text")).alias("points"), text.first_state(F.col("text")).alias("state"))


@query("b25_feed_row_cleaning", f"""
SELECT trim(team_name) AS team_name, age_group, gender, source, points, CASE WHEN state IN {inlist(US_STATES)} THEN state ELSE '' END AS state, rank, url
FROM feed WHERE coalesce(team_name, '') <> ''""")
def b25(spark, sf):
    return clean.clean_feed_rows(A.feed(spark, sf))


@query("b26_slice_grid", f"""
SELECT k.*, coalesce(games, 0) AS games FROM (SELECT state, gender, 'U' || a AS age_group FROM (SELECT unnest({lst(A.STATES_BY_NATION)}) AS state) s,
  (SELECT unnest(['M', 'F']) AS gender) g, (SELECT unnest(range(10, 19)) AS a) a) k
LEFT JOIN (SELECT state, gender, age_group, count(*) AS games FROM game_norm GROUP BY 1, 2, 3) n USING (state, gender, age_group)""")
def b26(spark, sf):
    grid = clean.slice_grid(spark, A.STATES_BY_NATION, ["M", "F"], [f"U{a}" for a in range(10, 19)])
    counts = A.game_norm(spark, sf).groupBy("state", "gender", "age_group").agg(F.count("*").alias("games"))
    return grid.join(counts, ["state", "gender", "age_group"], "left").fillna(0, ["games"])


@query("b27_name_normalization", f"""
SELECT 'doc' || doc_id AS id, array_to_string({tokens('text')}, ' ') AS name FROM documents
UNION ALL SELECT 'team' || custkey || '-' || copy, coalesce(array_to_string({tokens('team_name')}, ' '), '') FROM feed""")
def b27(spark, sf):
    docs = A.table(spark, sf, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("raw"))
    teams = A.feed(spark, sf).select(F.concat(F.lit("team"), F.col("custkey").cast("string"), F.lit("-"), F.col("copy").cast("string")), "team_name")
    return docs.union(teams).select("id", text.normalized_name(F.col("raw")).alias("name"))


@query("b28_name_and_year", f"""
SELECT custkey, copy, nullif(regexp_extract(raw, '\\b((?:19|20)[0-9]{{2}})\\b', 1), '') AS year,
       array_to_string({tokens("regexp_replace(raw, '\\b(?:19|20)[0-9]{2}\\b', '', 'g')")}, ' ') AS name
FROM (SELECT custkey, copy, coalesce(team_name, '') || CASE WHEN custkey % 3 = 0 THEN ' ' || (1990 + custkey % 40) || ' Boys' WHEN custkey % 3 = 1 THEN ' 12010' ELSE '' END AS raw FROM feed) f""")
def b28(spark, sf):
    ck = F.col("custkey")
    tail = F.when(ck % 3 == 0, F.concat(F.lit(" "), (1990 + ck % 40).cast("string"), F.lit(" Boys"))).when(ck % 3 == 1, " 12010").otherwise("")
    f = A.feed(spark, sf).select("custkey", "copy", F.concat(F.coalesce("team_name", F.lit("")), tail).alias("raw"))
    return f.select("custkey", "copy", text.name_year(F.col("raw")).alias("year"), text.name_without_year(F.col("raw")).alias("name"))


# Word ends in any script, without look-arounds: a number between two other characters, twice, since neighbours share one.
_ID = "'(^|[^\\p{L}\\p{M}\\p{N}_])[0-9]{6,}($|[^\\p{L}\\p{M}\\p{N}_])', '\\1[ID_REDACTED]\\2', 'g')"
_REDACT = (
    f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, 'https?://[^\\s]+', '[URL_REDACTED]', 'g'), "
    f"'[A-Za-z\\s]+(?:SC|FC|United|Academy|Club|Soccer|Futbol)', '[TEAM_NAME_REDACTED]', 'g'), {_ID}, {_ID}, "
    "'[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\\.[0-9]+)?Z?', '[TIMESTAMP_REDACTED]', 'g')"
)


@query("b29_text_redaction", f"""
SELECT doc_id, md5(safe) AS whole, md5(CASE WHEN length(safe) > 500 THEN substr(safe, 1, 450) || '... and more failures' ELSE safe END) AS short FROM (
  SELECT doc_id, {_REDACT} AS safe FROM (
    SELECT doc_id, text || ' seen 2001-02-03T04:05:06Z at https://x.example.com/' || doc_id || ' by Mesa United 1234567 7654321' AS text FROM documents) d) r""")
def b29(spark, sf):
    body = F.concat("text", F.lit(" seen 2001-02-03T04:05:06Z at https://x.example.com/"), F.col("doc_id").cast("string"), F.lit(" by Mesa United 1234567 7654321"))
    safe = A.table(spark, sf, "documents").select("doc_id", text.redact(body).alias("safe"))
    return safe.select("doc_id", F.md5("safe").alias("whole"), F.md5(text.shortened(F.col("safe"))).alias("short"))


@query("b30_team_search", "SELECT custkey, copy, team_name FROM feed WHERE regexp_matches(team_name, '(?i)district 1.*squad [0-9]*7$')")
def b30(spark, sf):
    f = A.feed(spark, sf).select("custkey", "copy", "team_name", "team_id")
    return f.where(text.matches_team(F.col("team_name"), F.col("team_id"), "district 1.*squad [0-9]*7$")).select("custkey", "copy", "team_name")


@query("b31_missing_opponent_class", """
SELECT p_partkey, CASE WHEN regexp_matches(lower(n), 'utah|california|nevada|las vegas|irvine') THEN 'other_state'
  WHEN regexp_matches(lower(n), '2015|2017|u9|u11|15b|17b') THEN 'other_age' WHEN regexp_matches(lower(n), 'girls|15g|17g') THEN 'other_gender' ELSE 'unknown' END AS reason
FROM (SELECT p_partkey, p_name || ' ' || ['Utah', 'U9', 'Girls', '2017 California', '17G', 'Reds'][p_partkey % 6 + 1] AS n FROM part) p""")
def b31(spark, sf):
    tail = A.pick(("Utah", "U9", "Girls", "2017 California", "17G", "Reds"), F.col("p_partkey") % 6)
    p = A.table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit(" "), tail).alias("n"))
    return p.select("p_partkey", text.missing_reason(F.col("n")).alias("reason"))


# ---------------------------------------------------------------- sorts, limits, set operations

@query("set_multi_key_sort", "SELECT team_id_master, strftime(date, '%Y-%m-%d') AS date, gf, ga FROM game_norm ORDER BY date DESC, team_id_master")
def set_sort(spark, sf):
    return A.game_norm(spark, sf).orderBy(F.desc("date"), "team_id_master").select("team_id_master", day_text("date"), "gf", "ga")


@query("set_top_k", "SELECT team_id_master, count(*) AS games FROM game_norm GROUP BY 1 ORDER BY games DESC, team_id_master LIMIT 5")
def set_topk(spark, sf):
    return A.game_norm(spark, sf).groupBy("team_id_master").agg(F.count("*").alias("games")).orderBy(F.desc("games"), "team_id_master").limit(5)


@query("set_union_ragged", """
SELECT provider, count(*) AS rows, count(club_name) AS clubs, count(points) AS points FROM (
  SELECT provider, club_name, NULL AS points FROM feed WHERE copy = 0 UNION ALL SELECT provider, NULL, points FROM feed WHERE copy = 1) u GROUP BY 1""")
def set_union(spark, sf):
    f = A.feed(spark, sf)
    u = f.where("copy = 0").select("provider", "club_name").unionByName(f.where("copy = 1").select("provider", "points"), allowMissingColumns=True)
    return u.groupBy("provider").agg(F.count("*").alias("rows"), F.count("club_name").alias("clubs"), F.count("points").alias("points"))


@query("set_intersect_subtract", """
SELECT 'both' AS kind, count(*) AS ids FROM (SELECT team_id_master FROM game_norm INTERSECT SELECT opponent_id_master FROM game_norm) a
UNION ALL SELECT 'opponent_only', count(*) FROM (SELECT opponent_id_master FROM game_norm WHERE opponent_id_master IS NOT NULL EXCEPT SELECT team_id_master FROM game_norm) b""")
def set_intersect(spark, sf):
    g = A.game_norm(spark, sf)
    teams, opponents = g.select("team_id_master"), g.select("opponent_id_master").dropna()
    both = teams.intersect(opponents).agg(F.count("*").alias("ids")).select(F.lit("both").alias("kind"), "ids")
    return both.unionAll(opponents.subtract(teams).agg(F.count("*")).select(F.lit("opponent_only"), "*"))


@query("set_distinct", "SELECT DISTINCT state, gender, age_group FROM game_norm")
def set_distinct(spark, sf):
    return A.game_norm(spark, sf).select("state", "gender", "age_group").distinct()


# ---------------------------------------------------------------- E9-E11: selection per key

@query("e09_best_row_per_team", """
SELECT team_id, custkey, copy, provider, array_to_string(providers, ',') AS providers FROM (
  SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY round(score, 9) DESC, pref DESC, source_url) AS rn,
         list_sort(list(DISTINCT provider) OVER (PARTITION BY team_id)) AS providers FROM (
    SELECT *, (0.25 * (trim(coalesce(team_name, '')) <> '')::INTEGER + 0.20 * (team_id IS NOT NULL)::INTEGER + 0.15 * (provider_team_id IS NOT NULL)::INTEGER
       + 0.10 * (age_group IS NOT NULL)::INTEGER + 0.10 * (age_u IS NOT NULL)::INTEGER + 0.10 * (gender IS NOT NULL)::INTEGER + 0.10 * (state <> '')::INTEGER
       + 0.05 * (coalesce(club_name, '') <> '')::INTEGER + 0.05 * (source_url IS NOT NULL)::INTEGER) / 1.1 AS score,
       CASE provider WHEN 'GotSport' THEN 3 WHEN 'Modular11' THEN 2 WHEN 'AthleteOne' THEN 1 ELSE 0 END AS pref FROM master) m) r WHERE rn = 1""")
def e09(spark, sf):
    m = clean.migrate_master(A.feed(spark, sf), "2001-11-05T00:00:00").where("team_id IS NOT NULL")
    best = delta.resolve_conflicts(m, ("source_url",))
    return best.select("team_id", "custkey", "copy", "provider", joined("providers").alias("providers"))


@query("e10_dedupe_feed", """
SELECT team_name, age_group, gender, state, source, rank, points, count(*) AS n FROM (SELECT DISTINCT team_name, age_group, gender, state, source, rank, points FROM feed) f GROUP BY ALL""")
def e10(spark, sf):
    return delta.dedupe_feed(A.feed(spark, sf)).groupBy(*delta.FEED_KEY).agg(F.count("*").alias("n"))


@query("e11_dedupe_prefer_id", "SELECT team_name, age_group, gender, state, min(team_id) AS team_id FROM feed GROUP BY 1, 2, 3, 4")
def e11(spark, sf):
    return delta.dedupe_prefer_id(A.feed(spark, sf)).select("team_name", "age_group", "gender", "state", "team_id")


@query("e11_best_row_generic", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) o WHERE rn = 1""")
def e11_generic(spark, sf):
    o = A.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.best_row(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")])


