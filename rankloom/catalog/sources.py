"""Reader, parser and writer queries. What they read is written by Spark from the given tables first."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom import adapters as A
from rankloom.catalog.base import day_text, query
from rankloom.catalog.links import VERSIONS, _builds, _master as _game_master
from rankloom.catalog.links import sql as link_sql
from rankloom.catalog.sql import with_ctes
from rankloom.catalog.summaries import BUILDS, _builds as _build_entries, _master, _sightings, SIGHTINGS
from rankloom.operators import clean, delta, identity, integrity, link, quality
from rankloom.plans import ranking as R
from rankloom.schemas import GAME_COLUMNS
from rankloom.sources import files, payloads, sinks, store
from rankloom.storage import scratch_path



def _slice_key():
    return F.concat_ws("_", "state", "gender", "age_group").alias("slice_key")



def _new(spark, name):
    return scratch_path(spark, name)


# ---------------------------------------------------------------- A1-A10, A25: readers

@query("a01_game_csv_scan", "SELECT team_id_master, opponent_id AS opponent_id_master, club_name AS club, strftime(date, '%Y-%m-%d') AS date, gf, ga FROM game_clean")
def a01(spark, sf):
    root = _new(spark, "build")
    sinks.write_csv(A.game_raw(spark, sf).select(*GAME_COLUMNS), f"{root}/games_all.csv")
    return files.read_build_games(spark, root).select("team_id_master", "opponent_id_master", "club", day_text("date"), "gf", "ga")


def _write_builds(spark, sf):
    """Two builds: all games, then the ones after 1998 again."""
    root = _new(spark, "builds")
    raw = A.game_raw(spark, sf).select(*GAME_COLUMNS, _slice_key())
    sinks.write_partitioned(raw, f"{root}/build_20011101_0900/games_feed", ["slice_key"], "csv", compression="gzip")
    sinks.write_partitioned(raw.where("scraped_at >= '1999'"), f"{root}/build_20011102_0900/games_feed", ["slice_key"], "csv", compression="gzip")
    return root


STATES = list(A.STATES_BY_NATION)
AGES = [f"U{a}" for a in range(10, 19)]


@query("a02_latest_build_scan", """
SELECT 'build_20011102_0900' AS build_id, state || '_' || gender || '_' || age_group AS slice_key, count(*) AS games, sum(gf) AS gf FROM (
  SELECT DISTINCT team_id_master, opponent_id, date, gf, ga, state, gender, age_group FROM game_clean WHERE scraped_at >= '1999') g GROUP BY 2""")
def a02(spark, sf):
    games = files.consolidate_builds(spark, _write_builds(spark, sf), STATES, ["M", "F"], AGES)
    return games.groupBy("build_id", "slice_key").agg(F.count("*").alias("games"), F.sum("gf").alias("gf"))


@query("a02_all_builds_scan", """
SELECT team_id_master, count(*) AS games, sum(gf) AS gf, sum(ga) AS ga FROM (
  SELECT DISTINCT team_id_master, opponent_id, date, gf, ga FROM game_clean) g GROUP BY 1""")
def a02_all(spark, sf):
    games = files.consolidate_builds(spark, _write_builds(spark, sf), STATES, ["M", "F"], AGES, refresh=True)
    return games.groupBy("team_id_master").agg(F.count("*").alias("games"), F.sum("gf").alias("gf"), F.sum("ga").alias("ga"))


def _write_normalized(spark, sf):
    root = _new(spark, "games")
    games = clean.normalize_games(A.game_raw(spark, sf))
    sinks.write_partitioned(games.where("date < '1999-01-01'"), f"{root}/normalized/version=20011101_0900", sinks.SLICE)
    sinks.write_partitioned(games, f"{root}/normalized/version=20011102_0900", sinks.SLICE)
    return root


@query("a03_latest_normalized", """
SELECT team_id_master, state, count(*) AS games FROM game_clean WHERE state IN (SELECT min(state) FROM game_clean) GROUP BY 1, 2""")
def a03(spark, sf):
    root = _write_normalized(spark, sf)
    first = A.game_norm(spark, sf).agg(F.min("state")).first()[0]
    games = files.read_latest_normalized(spark, f"{root}/normalized", first)
    return games.groupBy("team_id_master", "state").agg(F.count("*").alias("games"))


@query("a04_game_loader", """
SELECT team_id_master, count(*) AS games, sum(gf) AS gf FROM game_clean WHERE gender = 'M' AND age_group IN ('U10', 'U12', 'U14') GROUP BY 1""")
def a04(spark, sf):
    games = files.load_games(spark, _write_normalized(spark, sf), "ALL", ["M"], ["U10", "U12", "U14"], national=True)
    return games.groupBy("team_id_master").agg(F.count("*").alias("games"), F.sum("gf").alias("gf"))


@query("a05_feed_discovery", """
SELECT CASE WHEN provider = 'AthleteOne' THEN 'Unknown' ELSE provider END AS provider, count(*) AS teams, count(nullif(trim(team_name), '')) AS named,
       count(CASE WHEN provider = 'Modular11' THEN club_name END) AS clubs FROM feed GROUP BY 1""")
def a05(spark, sf):
    folder = _new(spark, "feeds")
    rows = A.feed(spark, sf).select("team_name", "age_group", "gender", "state", "rank", "points", "provider", "club_name")
    for provider, name in (("GotSport", "gotsport_rankings.csv"), ("Modular11", "modular11_teams.csv"), ("AthleteOne", "league.csv")):
        part = rows.where(F.col("provider") == provider).drop("provider")
        # Only one feed knows clubs: the layouts differ.
        sinks.write_csv(part if provider == "Modular11" else part.drop("club_name"), f"{folder}/{name}")
    feeds = files.read_feeds(spark, folder)
    return feeds.groupBy("provider").agg(F.count("*").alias("teams"), F.count("team_name").alias("named"), F.count("club_name").alias("clubs"))


TEAM_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in ("team_id", "team_name", "state", "gender", "age_group", "provider", "source_url")])


def _write_snapshots(spark, sf):
    root = _new(spark, "snapshots")
    m = _master(spark, sf).select(*TEAM_TEXT.fieldNames())
    sinks.write_csv(m.where("gender = 'M'"), f"{root}/master_20011101")
    sinks.write_csv(m.where("gender = 'F'"), f"{root}/master_20011103_incremental")
    sinks.write_csv(m, f"{root}/master_migrated_20011102")
    return root


@query("a06_latest_snapshot", "SELECT 'latest' AS kind, count(*) AS teams FROM master UNION ALL SELECT 'baseline', count(*) FROM master")
def a06(spark, sf):
    root = _write_snapshots(spark, sf)
    parts = [files.read_csv(spark, files.latest_snapshot(spark, root, baseline=b), TEAM_TEXT).agg(F.count("*").alias("teams")).select(
        F.lit(k).alias("kind"), "teams") for k, b in (("latest", False), ("baseline", True))]
    return parts[0].unionAll(parts[1])


@query("a07_baseline_sample", """
SELECT team_id, team_name, source_url FROM master ORDER BY team_name, state, gender, age_group, provider, source_url LIMIT 100""")
def a07(spark, sf):
    path = files.latest_snapshot(spark, _write_snapshots(spark, sf))
    return files.read_baseline(spark, path, TEAM_TEXT, sample=True, sample_rows=100).select("team_id", "team_name", "source_url")


@query("a08_identity_map_scan", with_ctes("""
SELECT team_id, list_sort(list(DISTINCT team_name))[1] AS first_alias, count(DISTINCT team_name) AS aliases, count(DISTINCT provider) AS feeds FROM seen GROUP BY 1""", SIGHTINGS))
def a08(spark, sf):
    path = _new(spark, "identities")
    ids = identity.observe_identities(_sightings(spark, sf))
    entry = F.struct(*[c for c in ids.columns if c != "team_id"])
    ids.select(F.to_json(F.create_map("team_id", entry)).alias("value")).write.text(path)
    found = files.read_identity_map(spark, path)
    return found.select("team_id", F.get("aliases", F.lit(0)).alias("first_alias"), F.size("aliases").alias("aliases"), F.size("provider_ids").alias("feeds"))


@query("a09_registry_scan", with_ctes("SELECT ts AS timestamp, teams_total, states_total, data_quality, 'GotSport' AS provider FROM build_rows", BUILDS))
def a09(spark, sf):
    path = _new(spark, "registry")
    entry = F.struct("timestamp", "teams_total", "states_total", "data_quality", F.array(F.lit("GotSport")).alias("providers"))
    # One JSON list per year: at most twelve monthly builds each.
    docs = _build_entries(spark, sf).groupBy(F.substring("timestamp", 1, 4).alias("year")).agg(F.to_json(F.collect_list(entry)).alias("value"))
    docs.write.partitionBy("year").text(path)
    r = files.read_registry(spark, f"{path}/*")
    return r.select("timestamp", "teams_total", "states_total", "data_quality", F.get("providers", F.lit(0)).alias("provider"))


@query("a10_hash_store_scan", """
SELECT state || '_' || gender AS slice_key, count(*) AS games, count(DISTINCT game_id) AS ids FROM (
  SELECT DISTINCT state, gender, 'game_' || team_id_source || '_' || game_date AS game_id FROM game_raw) g GROUP BY 1""")
def a10(spark, sf):
    path = _new(spark, "hashes")
    raw = A.game_raw(spark, sf).withColumns({"slice_key": F.concat_ws("_", "state", "gender"), "month": F.substring("game_date", 1, 7)})
    hashed = integrity.hash_games(raw, ["slice_key", "team_id_source", "month"])
    # One document per team and month, so no document grows with the table.
    docs = hashed.groupBy("slice_key", "team_id_source", "month").agg(
        F.map_from_entries(F.collect_list(F.struct("game_id", "game_hash"))).alias("games"), F.count("*").cast("int").alias("total_games"))
    docs.select("slice_key", F.lit("build_1").alias("build_id"), "total_games", "games").write.json(path)
    found = files.read_hash_store(spark, path)
    return found.groupBy("slice_key").agg(F.count("*").alias("games"), F.countDistinct("game_id").alias("ids"))


@query("a25_master_slice_scan", """
SELECT team_id AS team_id_master, regexp_replace(provider_team_id, '\\.0$', '') AS team_id_source, team_name FROM master
WHERE state = 'CA' AND gender = 'M' AND age_group = 'U11' AND provider_team_id IS NOT NULL""")
def a25(spark, sf):
    complete, _ = files.read_master_slice(files.master_slices(_master(spark, sf)), "CA", "M", "U11")
    return complete.select("team_id_master", "team_id_source", "team_name")


# ---------------------------------------------------------------- A11-A14: parsers

TEAM_COLS = ["provider", "team_id_source", "team_id_master", "team_name", "club_name", "age_group", "gender", "state"]


def _matches(spark, sf, layout):
    """Each game as a match document: goals may be missing, some dates too, some list neither side."""
    g = A.game_norm(spark, sf)
    own = F.col("team_id_master").cast("long")
    odd = F.length("opponent_id_master") == 1
    side = lambda i, n: F.struct(i.cast("long").alias("team_id"), n.alias("full_name"))
    us = side(F.when(~F.coalesce(odd, F.lit(False)), own), F.col("team"))
    them = side(F.regexp_extract("opponent", "([0-9]+)$", 1).cast("long") + 1000000, F.col("opponent"))
    home = F.col("home_away") == "H"
    gf, ga = F.when(F.col("gf") != 4, F.col("gf").cast("int")), F.col("ga").cast("int")
    hg, ag = F.when(home, gf).otherwise(ga), F.when(home, ga).otherwise(gf)
    stamp = F.when(F.col("ga") != 5, F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T10:00:00Z")))
    title = F.when(F.col("gf") == 1, F.lit("Final")).when(home, F.concat("team", F.lit(" vs. "), "opponent")).otherwise(F.concat("opponent", F.lit(" vs. "), "team"))
    common = [F.when(home, us).otherwise(them).alias("homeTeam"), F.when(home, them).otherwise(us).alias("awayTeam"),
              F.col("competition").alias("competition_name"), F.struct(F.lit("Field 1").alias("name"), F.lit("Mesa").alias("city")).alias("venue")]
    extra = ([title.alias("title"), stamp.alias("match_date"), hg.alias("home_score"), ag.alias("away_score")] if layout == "history"
             else [stamp.alias("matchTime"), hg.alias("homeScore"), ag.alias("awayScore")])
    # The same documents bare, as a list, and wrapped with their numbers as text; and cut short, for the reject side.
    kind = (F.col("gf") + F.col("ga")).cast("int") % 3
    number = lambda c: F.regexp_replace(c, r'"(team_id|home_score|away_score|homeScore|awayScore)":([0-9]+)', r'"$1":"$2"')
    plain = F.to_json(F.struct(*common, *extra))
    payload = F.when(kind == 0, plain).when(kind == 1, F.concat(F.lit("["), plain, F.lit("]"))).otherwise(
        F.concat(F.lit('{"matches": ['), number(plain), F.lit("]}")))
    broken = F.when((F.col("ga") == 3) & ~home, F.substring(plain, 1, 40))
    return g.select(
        F.lit("feed").alias("provider"), F.concat("team_id_master", F.lit(".0")).alias("team_id_source"), "team_id_master", F.col("team").alias("team_name"),
        F.col("club").alias("club_name"), "age_group", "gender", "state", F.explode(F.array_compact(F.array(payload, broken))).alias("payload"))


def _match_sql(history: bool) -> str:
    city = "''" if history else "'Mesa'"
    return f"""
SELECT team_id_source, opponent_name, opponent_id, game_date, home_away, goals_for, goals_against, result, competition, venue, city, count(*) AS games FROM (
  SELECT team_id_master || '.0' AS team_id_source, opponent AS opponent_name, (regexp_extract(opponent, '([0-9]+)$', 1)::BIGINT + 1000000)::VARCHAR AS opponent_id,
         strftime(date, '%Y-%m-%d') AS game_date, home_away, CASE WHEN gf <> 4 THEN gf::INTEGER END AS goals_for, ga::INTEGER AS goals_against,
         CASE WHEN gf = 4 THEN 'U' WHEN gf > ga THEN 'W' WHEN gf < ga THEN 'L' ELSE 'D' END AS result, competition, 'Field 1' AS venue, {city} AS city
  FROM game_norm WHERE ga <> 5 AND coalesce(length(opponent_id_master), 0) <> 1 AND date >= (SELECT d FROM as_of) - 365) g GROUP BY ALL"""


def _parsed(spark, sf, layout):
    since = F.date_sub(F.lit(A.as_of(spark, sf)).cast("date"), 365)
    g = payloads.parse_matches(_matches(spark, sf, layout), since, layout)
    cols = ["team_id_source", "opponent_name", "opponent_id", "game_date", "home_away", "goals_for", "goals_against", "result", "competition", "venue", "city"]
    return g.groupBy(*cols).agg(F.count("*").alias("games"))


@query("a11_match_history_payload", _match_sql(True))
def a11(spark, sf):
    return _parsed(spark, sf, "history")


@query("a11_match_payload", _match_sql(False))
def a11_match(spark, sf):
    return _parsed(spark, sf, "match")


@query("a11_rejected_payloads", """
SELECT team_id_master, count(*) AS payloads FROM game_norm WHERE ga = 3 AND home_away = 'A' GROUP BY 1""")
def a11_rejected(spark, sf):
    _, rejected = payloads.read_payloads(_matches(spark, sf, "history"), payloads.MATCH_LISTS)
    return rejected.groupBy("team_id_master").agg(F.count("*").alias("payloads"))


def _pages(spark, sf, blank=True):
    """Customers in lists of at most 100: the team entries of one ranking page, some without a name."""
    ck = F.col("c_custkey")
    name = F.concat(F.col("c_mktsegment"), F.lit(" & Ko "), ck.cast("string"))
    entry = F.struct(ck.alias("ck"), (F.when(ck % 9 == 0, " ").otherwise(name) if blank else name).alias("team_name"),
                     ck.cast("string").alias("team_id"), F.concat(F.floor(F.abs("c_acctbal")).cast("string"), F.lit(" pts")).alias("points"),
                     A.pick(A.STATES_BY_NATION, F.col("c_nationkey")).alias("team_association"))
    page = F.expr("c_custkey div 100")
    return A.table(spark, sf, "customer").groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(entry)).alias("teams")).select(
        "page", (10 + F.col("page") % 9).alias("age"), F.when(F.col("page") % 2 == 0, "m").otherwise("f").alias("gender"),
        F.concat(F.lit("https://feed.example.com/page/"), F.col("page").cast("string")).alias("url"), "teams")


def _page_sql(rank: str, extra: str, where: str) -> str:
    return f"""
SELECT {rank} AS rank, team_name, {extra} state, 'U' || (10 + page % 9) AS age_group, CASE WHEN page % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
       'https://feed.example.com/page/' || page AS url FROM (
  SELECT c_custkey // 100 AS page, row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) AS pos, c_custkey, floor(abs(c_acctbal))::BIGINT AS pts,
         c_mktsegment || ' & Ko ' || c_custkey AS team_name, {A_STATES}[c_nationkey + 1] AS state FROM customer) c WHERE {where}"""


A_STATES = "[" + ", ".join(f"'{s}'" for s in A.STATES_BY_NATION) + "]"


@query("a12_ranking_payload", _page_sql("pos", "c_custkey::VARCHAR AS team_id, pts AS points,", "c_custkey % 9 <> 0"))
def a12(spark, sf):
    pages = _pages(spark, sf)
    teams = F.transform("teams", lambda t: t.dropFields("ck"))
    wrapped = F.to_json(F.struct(teams.alias("team_ranking_data")))
    return payloads.parse_ranking_payload(pages.select(
        "age", "gender", "url", F.when(F.col("page") % 3 == 0, F.to_json(teams)).otherwise(wrapped).alias("payload")))


@query("a13_ranking_page", _page_sql("CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE pos END",
                                     "CASE WHEN c_custkey > 0 THEN c_custkey ELSE pts END AS points,", "TRUE"))
def a13(spark, sf):
    # Even teams show a rank in front of the name; the number in the name is the first one in the row either way.
    row = lambda t: F.concat(
        F.lit("<tr class='r'>\n <td>"), F.when(t["ck"] % 2 == 0, F.concat(t["team_id"], F.lit(" "))).otherwise(""), F.lit("<a href='/t/"), t["team_id"],
        F.lit("'>"), F.replace(t["team_name"], F.lit("&"), F.lit("&amp;")), F.lit("</a></td><td> "), t["points"], F.lit(" </td><td><b>"),
        t["team_association"], F.lit("</b></td></tr>"))
    html = F.concat(F.lit("<html><body><table><tr><td>x</td><td>y</td></tr></table><table id=\"rankingsTable\"><tr><th>Team</th></tr>"),
                    F.array_join(F.transform("teams", row), "\n"), F.lit("</table></body></html>"))
    return payloads.parse_ranking_pages(_pages(spark, sf, blank=False).select("age", "gender", "url", html.alias("html")))


@query("a14_page_game_entry", """
SELECT team_id_source, opponent_name, game_date, home_away, goals_for, goals_against, result, competition, count(*) AS games FROM (
  SELECT 'S' || team_id_master AS team_id_source, opponent || ' 2015' AS opponent_name, strftime(date, '%Y-%m-%d') AS game_date, home_away,
         CASE WHEN home_away = 'H' THEN gf ELSE ga END::INTEGER AS goals_for, CASE WHEN home_away = 'H' THEN ga ELSE gf END::INTEGER AS goals_against,
         CASE WHEN gf = ga THEN 'D' WHEN (home_away = 'H') = (gf > ga) THEN 'W' ELSE 'L' END AS result, competition
  FROM game_norm WHERE ga <> 5 AND date >= (SELECT d FROM as_of) - 365) g GROUP BY ALL""")
def a14(spark, sf):
    g = A.game_norm(spark, sf)
    home = F.col("home_away") == "H"
    num = lambda c: F.col(c).cast("int").cast("string")
    day = F.date_format("date", "EEEE, MMMM d, yyyy")
    day = F.when(F.col("ga") == 5, "no date").otherwise(day)
    g = g.withColumns({c: F.concat(c, F.lit(" 2015")) for c in ("team", "opponent")})
    line = F.when(home, F.concat("team", F.lit("\n"), num("gf"), F.lit(" - "), num("ga"), F.lit("\n"), "opponent")).otherwise(
        F.concat("opponent", F.lit("\n"), num("ga"), F.lit(" - "), num("gf"), F.lit("\n"), "team"))
    entry = F.concat(day, F.lit("\n"), line, F.lit("\n"), "competition")
    rows = g.select(F.lit("feed").alias("provider"), F.concat(F.lit("S"), "team_id_master").alias("team_id_source"), "team_id_master", F.col("team").alias("team_name"),
                    "age_group", "gender", "state", entry.alias("entry"))
    since = F.date_sub(F.lit(A.as_of(spark, sf)).cast("date"), 365)
    parsed = payloads.parse_game_entries(rows, since)
    cols = ["team_id_source", "opponent_name", "game_date", "home_away", "goals_for", "goals_against", "result", "competition"]
    return parsed.groupBy(*cols).agg(F.count("*").alias("games"))


# ---------------------------------------------------------------- A15-A24: writers, read back

@query("a15_normalized_sink", """
SELECT count(*) AS games, count(DISTINCT team_id_master) AS teams, count(DISTINCT state) AS states, count(DISTINCT gender) AS genders,
       count(DISTINCT age_group) AS age_groups, strftime(min(date), '%Y-%m-%d') AS first_date, strftime(max(date), '%Y-%m-%d') AS last_date,
       round(avg((club_name IS NULL)::INT), 6) AS missing_club, sum(gf) AS gf FROM game_clean""")
def a15(spark, sf):
    root = _new(spark, "normalized")
    stats = sinks.write_normalized(clean.normalize_games(A.game_raw(spark, sf)), root, "20011105_0900")
    total = spark.read.parquet(root).agg(F.sum("gf")).scalar()
    return stats.select("games", "teams", "states", "genders", "age_groups", day_text("first_date"), day_text("last_date"),
                        F.round("missing_club", 6).alias("missing_club")).withColumn("gf", total)


@query("a16_master_sinks", "SELECT state, count(*) AS teams, (SELECT count(*) FROM master) AS national FROM master GROUP BY 1")
def a16(spark, sf):
    root = _new(spark, "master")
    sinks.write_master(_master(spark, sf).select(*TEAM_TEXT.fieldNames()), root, "b1")
    states = spark.read.option("header", True).csv(f"{root}/states/build=b1")
    national = spark.read.option("header", True).csv(f"{root}/national/build=b1").agg(F.count("*")).scalar()
    return states.groupBy("state").agg(F.count("*").alias("teams")).withColumn("national", national)


@query("a17_master_slice_sink", "SELECT state || '_' || gender || '_' || age_group AS slice_key, count(*) AS teams FROM master GROUP BY 1")
def a17(spark, sf):
    path = _new(spark, "slices")
    sinks.write_slices(files.master_slices(_master(spark, sf)), path)
    rows = spark.read.option("header", True).csv(path)
    return rows.groupBy(_slice_key()).agg(F.count("*").alias("teams"))


@query("a18_ranking_outputs", "SELECT state, team_id_master, rank, rank_state, status FROM ranking WHERE scenario = 'baseline'")
def a18(spark, sf):
    root = _new(spark, "ranking")
    sinks.write_ranking(R.rank_teams(A.game_norm(spark, sf), R.run_spec(A.as_of(spark, sf)), A.aliases(spark, sf)), root)
    rows = spark.read.option("header", True).csv(f"{root}/states")
    return rows.select("state", "team_id_master", F.col("rank").cast("long").alias("rank"), F.col("rank_state").cast("long").alias("rank_state"), "status")


@query("a19_unlinked_quarantine", link_sql("SELECT team_id_master, count(*) AS games FROM linked WHERE link_status = 'unlinked' GROUP BY 1"))
def a19(spark, sf):
    linked = link.link_games(A.game_raw(spark, sf), _game_master(spark, sf))
    return sinks.write_unlinked(linked, _new(spark, "unlinked")).groupBy("team_id_master").agg(F.count("*").alias("games"))


@query("a20_delta_sinks", with_ctes("""
SELECT 'added' AS change_type, count(*) AS teams FROM new_build n WHERE NOT EXISTS (SELECT 1 FROM old_build o WHERE o.age_group = n.age_group AND o.gender = n.gender AND o.state = n.state)
UNION ALL SELECT 'removed', count(*) FROM old_build n WHERE NOT EXISTS (SELECT 1 FROM new_build o WHERE o.age_group = n.age_group AND o.gender = n.gender AND o.state = n.state)""", VERSIONS))
def a20(spark, sf):
    root = _new(spark, "deltas")
    changes = {k: v.select("team_id", "team_name") for k, v in delta.compare_builds(*_builds(spark, sf)).items()}
    written = sinks.write_deltas(changes, root)
    return sinks.count_deltas(sinks.read_deltas(spark, root, written, "team_id string, team_name string"), list(changes))


@query("a21_incremental_append", """
SELECT team_id_master, count(*) AS games, min(scraped_at) AS first_scraped FROM (
  SELECT team_id_master, opponent_id, date, gf, ga, max(CASE WHEN home_away = 'H' THEN '2001-12-01' ELSE scraped_at END) AS scraped_at FROM game_clean GROUP BY 1, 2, 3, 4, 5) g GROUP BY 1""")
def a21(spark, sf):
    games = clean.normalize_games(A.game_raw(spark, sf))
    again = games.where("home_away = 'H'").withColumn("scraped_at", F.lit("2001-12-01"))
    games_store = store.GameStore(spark, _new(spark, "store"), games.schema, files.GAME_DEDUPE, "date", "scraped_at", "quarter")
    for rows in (games, again):
        games_store.append(rows)
    return games_store.read().groupBy("team_id_master").agg(F.count("*").alias("games"), F.min("scraped_at").alias("first_scraped"))


@query("a21_club_append", with_ctes("""
SELECT club_name, state, max(scraped_at) AS last_seen_at FROM game_raw WHERE club_name IS NOT NULL GROUP BY 1, 2"""))
def a21_clubs(spark, sf):
    raw = A.game_raw(spark, sf)
    old, new = (identity.club_lookup(raw.where(c), "feed") for c in ("home_away = 'H'", "home_away = 'A'"))
    return files.append_clubs(old, new).select("club_name", "state", "last_seen_at")


@query("a22_history_export", with_ctes("SELECT ts AS timestamp, teams_total::VARCHAR AS teams_total, added::VARCHAR AS added FROM build_rows", BUILDS))
def a22(spark, sf):
    path = _new(spark, "history")
    sinks.export_history(_build_entries(spark, sf).withColumn("providers", F.array(F.lit("GotSport"))), path)
    return spark.read.option("header", True).csv(path).select("timestamp", "teams_total", "added")


@query("a23_slice_summary", """
SELECT 'feed_' || state || '_' || gender || '_' || age_group AS slice_key, count(DISTINCT team_id_master) AS teams_processed, count(*) AS games_written, count(DISTINCT club_name) AS clubs_found
FROM game_raw GROUP BY 1""")
def a23(spark, sf):
    path = _new(spark, "summaries")
    sinks.write_slice_summaries(quality.slice_summary(A.game_raw(spark, sf), "feed", "build_1"), path)
    return spark.read.schema("slice_key string, teams_processed long, games_written long, clubs_found long").json(path).select(
        "slice_key", "teams_processed", "games_written", "clubs_found")


@query("a24_new_team_sink", with_ctes("""
SELECT team_id, rtrim(team_name) AS team_name FROM new_build n WHERE NOT EXISTS (SELECT 1 FROM old_build o WHERE o.team_name IS NOT DISTINCT FROM n.team_name
  AND o.age_group = n.age_group AND o.gender = n.gender AND o.state = n.state)""", VERSIONS))
def a24(spark, sf):
    root = _new(spark, "new_teams")
    new, old = _builds(spark, sf)
    fresh = delta.new_teams(new, old).select("team_id", F.rtrim("team_name").alias("team_name"))
    sinks.write_new_teams(fresh, root, "b1")
    return spark.read.option("header", True).csv(root).select("team_id", "team_name")


@query("feed_registration", "SELECT 'S' || s_suppkey AS team_id_source, s_name AS team_name, 'U' || (10 + s_suppkey % 9) AS age_group FROM supplier")
def feed_registration(spark, sf):
    raw = A.table(spark, sf, "supplier")
    files.register_feed("supplier feed", raw.schema, {
        "team_id_source": "concat('S', s_suppkey)", "team_name": "s_name", "age_group": lambda: F.concat(F.lit("U"), (10 + F.col("s_suppkey") % 9).cast("string"))})
    return files.feed("supplier feed").apply(raw)


@query("feed_provider", """
SELECT way, 'S' || o_custkey AS team_id_source, count(*) AS games, strftime(max(o_orderdate), '%Y-%m') AS last_month, round(sum(o_totalprice), 2) AS total
FROM orders, (SELECT unnest(['read', 'stream']) AS way) w WHERE o_orderdate >= DATE '1997-01-01' GROUP BY 1, 2""")
def feed_provider(spark, sf):
    # Orders as published by a provider, month by month; read at once and as a stream, both from the same date on.
    folder = _new(spark, "provider")
    orders = A.table(spark, sf, "orders").withColumn("day", F.trunc("o_orderdate", "month").cast("date")).drop("o_orderdate")
    sinks.write_partitioned(orders, f"{folder}/out", ["day"])
    found = files.register_feed("orders provider", orders.drop("day").schema, {
        "team_id_source": "concat('S', o_custkey)", "month": lambda: F.date_format("day", "yyyy-MM"), "price": "cast(o_totalprice as double)"})
    found.stream(spark, f"{folder}/out", "1997-01-01").writeStream.format("parquet").option("checkpointLocation", f"{folder}/offsets").option(
        "path", f"{folder}/games").trigger(availableNow=True).start().awaitTermination()
    ways = {"read": found.read(spark, f"{folder}/out", "1997-01-01"), "stream": spark.read.parquet(f"{folder}/games")}
    rows = [df.withColumn("way", F.lit(way)) for way, df in ways.items()]
    return rows[0].unionByName(rows[1]).groupBy("way", "team_id_source").agg(
        F.count("*").alias("games"), F.max("month").alias("last_month"), F.round(F.sum("price"), 2).alias("total"))
