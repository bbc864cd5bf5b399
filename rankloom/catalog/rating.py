"""Window, rating-layer, graph and tuning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom import adapters as A
from rankloom.catalog.base import day_text, query, r6, rounded
from rankloom.catalog.sql import CTES, with_ctes
from rankloom.config import BASELINE, scenarios
from rankloom.operators import clean, graph, ordering, windows
from rankloom.plans import ranking as R
from rankloom.plans import tuning as T
from rankloom.storage import stage

BASE = "WHERE scenario = 'baseline'"


def _spec(spark, sf, configs=BASELINE, pools=()):
    return R.run_spec(A.as_of(spark, sf), configs, pools)


def _selected(spark, sf):
    spec = _spec(spark, sf)
    return spec, stage(R.select_games(A.game_norm(spark, sf), spec), "selected")


def _raw(spark, sf):
    spec, selected = _selected(spark, sf)
    raw = stage(R.team_raw(selected, spec), "raw")
    return spec, selected, raw, stage(R.league_stats(raw, spec), "league")


def _layers(spark, sf):
    spec, selected, raw, league = _raw(spark, sf)
    contributions = R.game_contributions(selected, R.strength_lookup(raw, league, spec), spec)
    return spec, selected, raw, league, R.team_layers(contributions, spec)


def _scored(spark, sf):
    spec = _spec(spark, sf)
    return R.rate_teams(A.game_norm(spark, sf), spec, A.aliases(spark, sf))


def _ranking(spark, sf, **kw):
    return R.rank_teams(A.game_norm(spark, sf), _spec(spark, sf), A.aliases(spark, sf), **kw)


# ---------------------------------------------------------------- E: windows

@query("e01_recent_games", """
SELECT team_id_master, opponent_id_master, strftime(date, '%Y-%m-%d') AS date, gf, ga, game_index FROM (
  SELECT *, row_number() OVER (PARTITION BY team_id_master ORDER BY date DESC, opponent_id_master NULLS LAST, gf, ga) - 1 AS game_index
  FROM game_norm) g WHERE game_index < 30""")
def e01(spark, sf):
    cols = ["team_id_master", "opponent_id_master", "date", "gf", "ga"]
    return windows.recent_games(A.game_norm(spark, sf).select(*cols), ["team_id_master"], 30).withColumn("date", day_text("date"))


@query("e02_game_index_days_since", """
SELECT team_id_master, game_index, days_since, count(*) AS n FROM (
  SELECT team_id_master, game_index, (SELECT d FROM as_of) - date AS days_since FROM (
    SELECT *, row_number() OVER (PARTITION BY team_id_master ORDER BY date DESC, opponent_id_master NULLS LAST, gf, ga) - 1 AS game_index
    FROM game_norm) g WHERE game_index < 30) h GROUP BY 1, 2, 3""")
def e02(spark, sf):
    as_of = F.lit(A.as_of(spark, sf)).cast("date")
    g = windows.recent_games(A.game_norm(spark, sf), ["team_id_master"], 30)
    return windows.with_days_since(g, as_of).groupBy("team_id_master", "game_index", "days_since").agg(F.count("*").alias("n"))


@query("e03_outlier_guard", f"""
SELECT team_id_master, game_index, {r6('gf ga')} FROM selected {BASE}""")
def e03(spark, sf):
    g = R.within_window(A.game_norm(spark, sf), F.lit(A.as_of(spark, sf)).cast("date"), 365)
    kept = windows.guard_outliers(windows.recent_games(g, ["team_id_master"], 30), ["team_id_master"], 2.5)
    return rounded(kept.select("team_id_master", "game_index", "gf", "ga"), "gf", "ga")


@query("e04_clip_by_group", """
SELECT team_id_master, round(sum(v), 4) AS clipped_sum, round(max(v), 6) AS clipped_max, count(*) AS n FROM (
  SELECT team_id_master, CASE WHEN s > 0 THEN greatest(m - 1.5 * s, least(m + 1.5 * s, gf)) ELSE gf END AS v
  FROM (SELECT *, avg(gf) OVER t AS m, stddev_samp(gf) OVER t AS s FROM game_norm WINDOW t AS (PARTITION BY team_id_master)) g) h
GROUP BY 1""")
def e04(spark, sf):
    g = windows.clip_by_group(A.game_norm(spark, sf).select("team_id_master", "gf"), ["team_id_master"], ["gf"], 1.5)
    return g.groupBy("team_id_master").agg(
        F.round(F.sum("gf"), 4).alias("clipped_sum"), F.round(F.max("gf"), 6).alias("clipped_max"), F.count("*").alias("n"))


@query("e05_tapered_weights", f"SELECT team_id_master, game_index, n, {r6('weight')} FROM selected {BASE}")
def e05(spark, sf):
    return rounded(_selected(spark, sf)[1].select("team_id_master", "game_index", "n", "weight"), "weight")


@query("e06_decay_weights", """
SELECT team_id_master, game_index, round(w / sum(w) OVER (PARTITION BY team_id_master), 6) AS weight
FROM (SELECT team_id_master, game_index, exp(-0.08 * game_index) AS w FROM selected WHERE scenario = 'baseline') s""")
def e06(spark, sf):
    selected = _selected(spark, sf)[1].select("team_id_master", "game_index")
    return rounded(windows.decay_weights(selected, ["team_id_master"], 0.08), "weight")


@query("e07_national_rank", f"SELECT team_id_master, rank, {r6('powerscore_adj')} FROM ranking {BASE}")
def e07(spark, sf):
    # Positions by range: what a frame too large for one sort uses.
    ranked = ordering.global_positions(_scored(spark, sf), [], R.rank_order(), "rank")
    return rounded(ranked.select("team_id_master", "rank", "powerscore_adj"), "powerscore_adj")


@query("e08_state_rank", f"SELECT team_id_master, state, rank_state FROM ranking {BASE}")
def e08(spark, sf):
    ranked = ordering.global_positions(_scored(spark, sf), ["state"], R.rank_order(), "rank_state")
    return ranked.select("team_id_master", "state", "rank_state")


@query("e12_last_game_active", """
SELECT team_id_master, strftime(max(date), '%Y-%m-%d') AS last_game_date, (SELECT d FROM as_of) - max(date) <= 180 AS is_active
FROM game_norm GROUP BY 1""")
def e12(spark, sf):
    as_of = F.lit(A.as_of(spark, sf)).cast("date")
    return windows.last_activity(A.game_norm(spark, sf), ["team_id_master"], as_of, 180).withColumn("last_game_date", day_text("last_game_date"))


@query("e13_newest_attributes", """
SELECT team_id_master, team, club, state, gender, age_group FROM (
  SELECT *, row_number() OVER (PARTITION BY team_id_master ORDER BY date DESC, opponent_id_master NULLS LAST, gf, ga) AS rn
  FROM game_norm) g WHERE rn = 1""")
def e13(spark, sf):
    return windows.newest_row(A.game_norm(spark, sf), ["team_id_master"], R.ATTRIBUTES)


# ---------------------------------------------------------------- R: layers

@query("r01_gate_and_window", """
SELECT team_id_master, count(*) AS games, strftime(min(date), '%Y-%m-%d') AS first_date FROM game_norm
WHERE date >= (SELECT d FROM as_of) - 365 AND (SELECT avg(CASE WHEN opponent_id_master IS NULL THEN 1.0 ELSE 0 END) FROM game_norm) <= 0.05
GROUP BY 1""")
def r01(spark, sf):
    games = A.game_norm(spark, sf)
    clean.check_links(games)
    g = R.within_window(games, F.lit(A.as_of(spark, sf)).cast("date"), 365)
    return g.groupBy("team_id_master").agg(F.count("*").alias("games"), F.date_format(F.min("date"), "yyyy-MM-dd").alias("first_date"))


@query("r02_select_and_prepare", f"""
SELECT team_id_master, game_index, goal_diff, n, days_since, {r6('gf ga')} FROM selected {BASE}""")
def r02(spark, sf):
    s = _selected(spark, sf)[1]
    return rounded(s.select("team_id_master", "game_index", "goal_diff", "n", "days_since", "gf", "ga"), "gf", "ga")


@query("r03_weights", f"""
SELECT team_id_master, count(*) AS games, round(sum(weight), 6) AS total, round(max(weight), 6) AS top, round(min(weight), 6) AS low
FROM selected {BASE} GROUP BY 1""")
def r03(spark, sf):
    return _selected(spark, sf)[1].groupBy("team_id_master").agg(
        F.count("*").alias("games"), F.round(F.sum("weight"), 6).alias("total"),
        F.round(F.max("weight"), 6).alias("top"), F.round(F.min("weight"), 6).alias("low"))


@query("r04_raw_metrics", f"SELECT team_id_master, gp_used, {r6('off_raw def_raw')} FROM raw {BASE}")
def r04(spark, sf):
    spec, selected = _selected(spark, sf)
    return rounded(R.team_raw(selected, spec).drop("scenario"), "off_raw", "def_raw")


@query("r05_opponent_adjusted", f"SELECT team_id_master, {r6('sao_raw sad_raw')} FROM layers {BASE}")
def r05(spark, sf):
    return rounded(_layers(spark, sf)[4].select("team_id_master", "sao_raw", "sad_raw"), "sao_raw", "sad_raw")


@query("r06_adaptive_k", f"SELECT team_id_master, {r6('sao_adjusted sad_adjusted')} FROM layers {BASE}")
def r06(spark, sf):
    return rounded(_layers(spark, sf)[4].select("team_id_master", "sao_adjusted", "sad_adjusted"), "sao_adjusted", "sad_adjusted")


@query("r07_performance", f"SELECT team_id_master, {r6('sao_perf sad_perf')} FROM layers {BASE}")
def r07(spark, sf):
    return rounded(_layers(spark, sf)[4].select("team_id_master", "sao_perf", "sad_perf"), "sao_perf", "sad_perf")


@query("r07a_performance_factor", f"""
SELECT team_id_master, game_index, round(CASE WHEN known THEN o * f ELSE o END, 6) AS off_perf FROM factors {BASE}""")
def r07a(spark, sf):
    spec, selected, raw, league = _raw(spark, sf)
    c = R.game_contributions(selected, R.strength_lookup(raw, league, spec), spec)
    return rounded(c.select("team_id_master", "game_index", "off_perf"), "off_perf")


@query("r08_shrinkage", f"SELECT team_id_master, {r6('sao_shrunk sad_shrunk')} FROM shrunk {BASE}")
def r08(spark, sf):
    spec, _, raw, league, layers = _layers(spark, sf)
    s = R.shrink(raw, layers, league, spec)
    return rounded(s.select("team_id_master", "sao_shrunk", "sad_shrunk"), "sao_shrunk", "sad_shrunk")


@query("r09_schedule_strength", f"SELECT team_id_master, {r6('sos_component')} FROM scheduled {BASE}")
def r09(spark, sf):
    spec, selected, raw, league, layers = _layers(spark, sf)
    s = stage(R.shrink(raw, layers, league, spec), "shrunk")
    return rounded(R.schedule_strength(selected, s, spec, A.aliases(spark, sf)).select("team_id_master", "sos_component"), "sos_component")


@query("r10_robust_scale", f"SELECT team_id_master, {r6('sao_norm sad_norm sos_norm')} FROM scaled {BASE}")
def r10(spark, sf):
    s = _scored(spark, sf).select("team_id_master", "sao_norm", "sad_norm", "sos_norm")
    return rounded(s, "sao_norm", "sad_norm", "sos_norm")


@query("r10_robust_scale_by_position", """
WITH g AS (SELECT l_suppkey, l_extendedprice AS v FROM lineitem),
q AS (SELECT l_suppkey, quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM g GROUP BY 1),
h AS (SELECT g.l_suppkey, greatest(lo, least(hi, v)) AS v FROM g JOIN q USING (l_suppkey)),
z AS (SELECT l_suppkey, 1 / (1 + exp(-(v - avg(v) OVER p) / stddev_samp(v) OVER p)) AS s FROM h WINDOW p AS (PARTITION BY l_suppkey))
SELECT l_suppkey, count(*) AS n, round(avg(s), 6) AS mean_scaled, round(max(s), 6) AS max_scaled FROM z GROUP BY 1""")
def r10_positions(spark, sf):
    prices = stage(A.table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice"), "prices")
    scaled = R.robust_scale(prices, ["l_suppkey"], {"l_extendedprice": "s"})
    return scaled.groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.round(F.avg("s"), 6).alias("mean_scaled"), F.round(F.max("s"), 6).alias("max_scaled"))


@query("r10b_range_scale", f"""
SELECT team_id_master, round(CASE WHEN lo = hi THEN 0.5 ELSE 1 / (1 + exp(-6 * ((greatest(lo, least(hi, off_raw)) - lo) / (hi - lo) - 0.5))) END, 6) AS off_scaled
FROM raw, (SELECT quantile_cont(off_raw, 0.05) AS lo, quantile_cont(off_raw, 0.95) AS hi FROM raw {BASE}) q {BASE}""")
def r10b(spark, sf):
    raw = _raw(spark, sf)[2]
    return rounded(R.range_scale(raw, ["scenario"], {"off_raw": "off_scaled"}).select("team_id_master", "off_scaled"), "off_scaled")


@query("r11_power_score", f"SELECT team_id_master, gp_used, {r6('powerscore gp_mult powerscore_adj')} FROM scored {BASE}")
def r11(spark, sf):
    s = _scored(spark, sf).select("team_id_master", "gp_used", "powerscore", "gp_mult", "powerscore_adj")
    return rounded(s, "powerscore", "gp_mult", "powerscore_adj")


@query("r12_status", f"""
SELECT team_id_master, gp_used, is_active, status, strftime(last_game_date, '%Y-%m-%d') AS last_game_date FROM scored {BASE}""")
def r12(spark, sf):
    return _scored(spark, sf).select("team_id_master", "gp_used", "is_active", "status", day_text("last_game_date"))


RANK_COLUMNS = """off_raw def_raw sao_raw sad_raw sao_adjusted sad_adjusted sao_perf sad_perf sao_shrunk sad_shrunk
sos_component sao_norm sad_norm sos_norm powerscore powerscore_adj gp_mult"""


@query("r13_ranking", f"""
SELECT rank, rank AS rank_national, team_id_master, team, club, state, gender, age_group, gp_used, status, {r6(RANK_COLUMNS)} FROM ranking {BASE}""")
def r13(spark, sf):
    ranking = _ranking(spark, sf).drop("scenario", "is_active", "last_game_date", "component_id", "component_size", "degree")
    return rounded(ranking, *RANK_COLUMNS.split())


@query("r13_state_view", f"""
SELECT row_number() OVER (ORDER BY round(powerscore_adj, 9) DESC, round(sao_norm, 9) DESC, round(sad_norm, 9) DESC,
       round(sos_norm, 9) DESC, gp_used DESC, team_id_master) AS rank, team_id_master, {r6('powerscore_adj')}
FROM ranking WHERE scenario = 'baseline' AND state = (SELECT min(state) FROM game_norm)""")
def r13_state(spark, sf):
    first = A.game_norm(spark, sf).agg(F.min("state")).first()[0]
    return rounded(_ranking(spark, sf, state=first).select("rank", "team_id_master", "powerscore_adj"), "powerscore_adj")


def _pool_sql(pool: str) -> str:
    """The whole ranking over the games of one pool alone; every seventh team has no gender."""
    games = f"""SELECT * FROM (SELECT * REPLACE (CASE WHEN team_id_master::BIGINT % 7 <> 0 THEN gender END AS gender) FROM ({CTES['game_norm']}) q) p
WHERE gender IS NOT DISTINCT FROM {pool}"""
    return with_ctes(f"""
SELECT {pool} AS gender, rank, team_id_master, gp_used, strftime(last_game_date, '%Y-%m-%d') AS last_game_date, status,
       {r6('sos_component')}, {r6('powerscore_adj')} FROM ranking WHERE scenario = 'baseline'""", {"game_norm": games})


@query("r13_ranking_by_pool", "\nUNION ALL\n".join(f"SELECT * FROM ({_pool_sql(pool)}) x" for pool in ("'M'", "'F'", "NULL::VARCHAR")))
def r13_pool(spark, sf):
    spec = _spec(spark, sf, pools=("gender",))
    games = A.game_norm(spark, sf)
    games = games.withColumn("gender", F.when(F.col("team_id_master").cast("long") % 7 != 0, F.col("gender")))
    ranking = R.rank_teams(games, spec, A.aliases(spark, sf))
    columns = ["gender", "rank", "team_id_master", "gp_used", day_text("last_game_date"), "status", "sos_component", "powerscore_adj"]
    return rounded(ranking.select(*columns), "sos_component", "powerscore_adj")


@query("r14_run_summary", f"""
SELECT scenario, count(*) AS total_teams, count(*) FILTER (status = 'Active') AS active_teams,
       count(*) FILTER (status <> 'Active') AS provisional_teams FROM scored {BASE} GROUP BY 1""")
def r14(spark, sf):
    return R.run_summary(_scored(spark, sf))


# ---------------------------------------------------------------- G: graph

GRAPH = """
WITH g AS (""" + with_ctes("SELECT team_id_master AS t, opponent_id_master AS o, gf, ga FROM game_norm") + """),
e AS (SELECT t AS team, o AS opponent FROM g WHERE o IS NOT NULL),
s AS (SELECT t AS team, greatest(0, avg(gf - ga) + 2) AS strength FROM g GROUP BY 1),
b AS (SELECT team, coalesce(median(x.strength), (SELECT median(strength) FROM s)) AS baseline_sos FROM (
        SELECT s.team, o.strength FROM s LEFT JOIN (SELECT team, opponent FROM e UNION ALL SELECT opponent, team FROM e WHERE team <> opponent) p
        ON s.team = p.team LEFT JOIN s o ON p.opponent = o.team) x GROUP BY 1),
i1 AS (SELECT s.team, coalesce(0.85 * avg(o.strength) + 0.15 * any_value(s.strength), any_value(s.strength)) AS strength
       FROM s LEFT JOIN (SELECT e.team, s.strength FROM e JOIN s ON e.opponent = s.team) o ON s.team = o.team GROUP BY 1),
i2 AS (SELECT s.team, coalesce(0.85 * avg(o.strength) + 0.15 * any_value(s.strength), any_value(s.strength)) AS strength
       FROM i1 s LEFT JOIN (SELECT e.team, i1.strength FROM e JOIN i1 ON e.opponent = i1.team) o ON s.team = o.team GROUP BY 1),
i3 AS (SELECT s.team, coalesce(0.85 * avg(o.strength) + 0.15 * any_value(s.strength), any_value(s.strength)) AS strength
       FROM i2 s LEFT JOIN (SELECT e.team, i2.strength FROM e JOIN i2 ON e.opponent = i2.team) o ON s.team = o.team GROUP BY 1)
"""


def _strengths(spark, sf):
    games = A.game_norm(spark, sf).select("team_id_master", "opponent_id_master", "gf", "ga")
    return games, stage(graph.goal_strength(games), "strength")


@query("g01_opponent_edges", GRAPH + "SELECT team, opponent, count(*) AS edges, count(*)::DOUBLE AS weight FROM e GROUP BY 1, 2")
def g01(spark, sf):
    return graph.opponent_edges(A.game_norm(spark, sf)).groupBy("team", "opponent").agg(
        F.count("*").alias("edges"), F.sum("weight").alias("weight"))


@query("g02_baseline_schedule", GRAPH + "SELECT team, round(baseline_sos, 6) AS baseline_sos FROM b")
def g02(spark, sf):
    games, strengths = _strengths(spark, sf)
    return rounded(graph.baseline_schedule(games, strengths), "baseline_sos")


@query("g03_iterative_schedule", GRAPH + "SELECT team, round(strength, 6) AS strength FROM i3")
def g03(spark, sf):
    games, strengths = _strengths(spark, sf)
    # Tolerance 0: always the three rounds the SQL unrolls.
    return rounded(graph.iterative_schedule(strengths, graph.opponent_edges(games), tolerance=0.0), "strength")


def component_sql(days: int) -> str:
    games = with_ctes(f"SELECT team_id_master AS a, opponent_id_master AS b FROM game_norm WHERE date >= (SELECT d FROM as_of) - {days}")
    return f"""
WITH RECURSIVE g AS ({games}),
e AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM g WHERE b IS NOT NULL),
x AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
n AS (SELECT a AS node FROM x UNION SELECT a FROM g),
r AS (SELECT node, node AS seen FROM n UNION SELECT r.node, x.b FROM r JOIN x ON r.seen = x.a),
c AS (SELECT node, min(seen) AS component_id, count(*) AS component_size FROM r GROUP BY 1),
d AS (SELECT a AS node, count(*) AS degree FROM (SELECT a FROM e UNION ALL SELECT b FROM e) GROUP BY 1)
"""


def _connectivity(spark, sf, days):
    as_of = F.lit(A.as_of(spark, sf)).cast("date")
    games = R.within_window(A.game_norm(spark, sf), as_of, days)
    return graph.connectivity(games.select("team_id_master", "opponent_id_master"))


COMPONENT_COLUMNS = """
SELECT c.node, component_id, component_size, coalesce(degree, 0) AS degree FROM c LEFT JOIN d USING (node)"""


@query("g04_components", component_sql(365) + COMPONENT_COLUMNS)
def g04(spark, sf):
    return _connectivity(spark, sf, 365)


@query("g04_components_of_a_week", component_sql(7) + COMPONENT_COLUMNS)
def g04_week(spark, sf):
    # A short rating window leaves several components.
    return _connectivity(spark, sf, 7)


@query("g05_connectivity_report", component_sql(7) + """
SELECT count(*) AS total_teams, min(component_size) AS min_component, max(component_size) AS max_component,
       count(*) FILTER (component_size < 50) AS low_connectivity FROM c""")
def g05(spark, sf):
    return graph.connectivity_report(_connectivity(spark, sf, 7))


@query("g06_goal_strength", GRAPH + "SELECT team, round(strength, 6) AS strength FROM s")
def g06(spark, sf):
    return rounded(graph.goal_strength(A.game_norm(spark, sf)), "strength")


@query("g07_combined_schedule", GRAPH + """
SELECT team, round(coalesce(i3.strength, baseline_sos), 6) AS sos FROM b LEFT JOIN i3 USING (team)""")
def g07(spark, sf):
    games, strengths = _strengths(spark, sf)
    iterative = graph.iterative_schedule(strengths, graph.opponent_edges(games), tolerance=0.0)
    return rounded(graph.combined_schedule(iterative, graph.baseline_schedule(games, strengths)), "sos")


# ---------------------------------------------------------------- T: tuning

def _sweep(spark, sf):
    return T.sweep(A.game_norm(spark, sf), A.as_of(spark, sf), scenarios(), A.aliases(spark, sf))


def _pairs(spark, sf):
    ranking = stage(_sweep(spark, sf), "sweep")
    return stage(T.aligned_sweep(ranking), "aligned")


PAIRS = {"pairs": """
SELECT t.scenario, t.team_id_master, t.state, t.gender, t.age_group, b.rank AS rank_base, t.rank AS rank_test,
       t.powerscore_adj - b.powerscore_adj AS powerscore_delta,
       row_number() OVER (PARTITION BY t.scenario ORDER BY b.rank) AS r_base, row_number() OVER (PARTITION BY t.scenario ORDER BY t.rank) AS r_test
FROM ranking t JOIN ranking b ON t.team_id_master = b.team_id_master AND b.scenario = 'baseline'"""}


def tuning_sql(body: str) -> str:
    return with_ctes(body, PAIRS)


@query("t02_scenario_sweep", f"SELECT scenario, rank, team_id_master, gp_used, {r6('powerscore_adj')} FROM ranking")
def t02(spark, sf):
    return rounded(_sweep(spark, sf).select("scenario", "rank", "team_id_master", "gp_used", "powerscore_adj"), "powerscore_adj")


@query("t03_spearman", tuning_sql("SELECT scenario, round(corr(r_base, r_test), 6) AS spearman FROM pairs GROUP BY 1"))
def t03(spark, sf):
    return rounded(T.spearman(T.reranked(_pairs(spark, sf))), "spearman")


@query("t04_kendall", tuning_sql("""
SELECT a.scenario, round(sum(sign(a.r_base - b.r_base) * sign(a.r_test - b.r_test)) / count(*), 6) AS kendall
FROM pairs a JOIN pairs b ON a.scenario = b.scenario AND a.r_base < b.r_base GROUP BY 1"""))
def t04(spark, sf):
    return rounded(T.kendall(stage(T.reranked(_pairs(spark, sf)), "reranked"), block_rows=16), "kendall")


@query("t05_topk_overlap", tuning_sql("SELECT scenario, " + ", ".join(
    f"round(count(*) FILTER (r_base <= {k} AND r_test <= {k}) / least({k}, count(*))::DOUBLE, 6) AS top{k}_overlap" for k in (5, 10, 20))
    + " FROM pairs GROUP BY 1"))
def t05(spark, sf):
    return rounded(T.overlaps(T.reranked(_pairs(spark, sf))), "top5_overlap", "top10_overlap", "top20_overlap")


@query("t06_rank_deltas", tuning_sql("""
SELECT scenario, round(median(abs(rank_test - rank_base)), 6) AS median_rank_delta,
       round(quantile_cont(abs(rank_test - rank_base)::DOUBLE, 0.9), 6) AS p90_rank_delta,
       max(abs(rank_test - rank_base))::DOUBLE AS max_rank_delta, count(*) AS teams_compared FROM pairs GROUP BY 1"""))
def t06(spark, sf):
    return rounded(T.rank_deltas(_pairs(spark, sf)), "median_rank_delta", "p90_rank_delta")


@query("t07_delta_report", tuning_sql("""
SELECT scenario, team_id_master, rank_base, rank_test, rank_test - rank_base AS rank_delta,
       abs(rank_test - rank_base) AS abs_rank_delta, round(powerscore_delta, 6) AS powerscore_delta FROM pairs"""))
def t07(spark, sf):
    report = T.delta_report(stage(_sweep(spark, sf), "sweep"))
    return rounded(report.select("scenario", "team_id_master", "rank_base", "rank_test", "rank_delta", "abs_rank_delta",
                                 "powerscore_delta"), "powerscore_delta")


@query("t08_empty_defaults", """
SELECT 0.0::DOUBLE AS spearman, 0.0::DOUBLE AS kendall, 0.0::DOUBLE AS top5_overlap, 0.0::DOUBLE AS max_rank_delta, 0 AS teams_compared,
       (SELECT count(*) FROM ranking WHERE scenario = 'baseline') AS teams_base""")
def t08(spark, sf):
    # The two sides are ratings of different teams, so nothing aligns.
    base = stage(_ranking(spark, sf).drop("scenario"), "ranking")
    other = base.withColumn("team_id_master", F.concat(F.lit("other-"), "team_id_master"))
    found = T.compare_rankings(base, other).select("spearman", "kendall", "top5_overlap", "max_rank_delta", "teams_compared")
    return found.withColumn("teams_base", base.agg(F.count("*")).scalar())
