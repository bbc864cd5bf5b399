"""SQL building blocks: the test adapters and the rating layers as common table expressions.

``with_ctes(body)`` puts in front of ``body`` every expression it refers to, in order.
"""

from __future__ import annotations

import re

from rankloom.adapters import FEED_GENDERS, FEED_PROVIDERS, FEED_STATES, STATES_BY_NATION
from rankloom.config import as_dict, scenarios
from rankloom.schemas import NAME_STOPWORDS, NON_US, REGION_TO_STATE


def lst(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def inlist(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _scenario_rows() -> str:
    rows = []
    names = list(as_dict(next(iter(scenarios().values()))))
    for name, config in scenarios().items():
        cells = []
        for key, value in as_dict(config).items():
            if isinstance(value, bool):
                cells.append("TRUE" if value else "FALSE")
            elif isinstance(value, float):
                cells.append(f"{value}::DOUBLE")
            else:
                cells.append(str(value))
        rows.append(f"('{name}', {', '.join(cells)})")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS v(scenario, {', '.join(names)})"


REGION_CASE = "CASE " + " ".join(f"WHEN state = '{k}' THEN '{v}'" for k, v in REGION_TO_STATE.items()) + " ELSE state END"
GENDER_CASE = ("CASE WHEN lower(trim(gender)) IN ('m','male','1','1.0') THEN 'M' "
               "WHEN lower(trim(gender)) IN ('f','female','0','0.0') THEN 'F' END")
AGE_RAW = "try_cast(regexp_extract(age_group, '([0-9]+)', 1) AS INTEGER)"
AGE_CASE = f"CASE WHEN {AGE_RAW} BETWEEN 10 AND 18 THEN {AGE_RAW} END"


def tokens(expr: str) -> str:
    plain = f"regexp_replace(lower({expr}), '[^a-z0-9\\s]', '', 'g')"
    words = f"string_split(trim(regexp_replace({plain}, '\\s+', ' ', 'g')), ' ')"
    return f"list_filter({words}, lambda w: w <> '' AND w NOT IN {inlist(NAME_STOPWORDS)})"


def team_id(name: str, state: str, age: str, gender: str) -> str:
    """Id over already cleaned parts."""
    return f"substr(sha1(lower(trim({name})) || '|' || upper(trim({state})) || '|' || {age} || '|' || {gender}), 1, 12)"


CTES: dict[str, str] = {
    "as_of": "SELECT max(l_shipdate)::DATE + 1 AS d FROM lineitem",
    "game_norm": f"""
SELECT l_suppkey::VARCHAR AS team_id_master,
       CASE WHEN l_partkey % 37 = 0 THEN NULL
            WHEN l_partkey % 41 = 0 THEN 'X' || opp WHEN l_partkey % 43 = 0 THEN opp || '.0'
            WHEN l_partkey % 47 = 0 THEN 'A' || opp ELSE opp::VARCHAR END AS opponent_id_master,
       s_name AS team, 'Supplier#' || lpad(opp::VARCHAR, 9, '0') AS opponent,
       CASE WHEN l_suppkey % 6 <> 0 THEN 'Club ' || (s_nationkey % 7) END AS club,
       {lst(STATES_BY_NATION)}[s_nationkey + 1] AS state,
       CASE WHEN l_suppkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       'U' || (10 + l_suppkey % 9) AS age_group,
       ship - ((newest - ship) * (CASE l_suppkey % 10 WHEN 3 THEN 12 WHEN 4 THEN 6 WHEN 5 THEN 4 ELSE 1 END - 1)
               + CASE WHEN l_suppkey % 10 = 6 THEN 200 ELSE 0 END)::INTEGER AS date,
       gf, ga, CASE WHEN l_linestatus = 'O' THEN 'H' ELSE 'A' END AS home_away,
       CASE WHEN gf > ga THEN 'W' WHEN gf < ga THEN 'L' ELSE 'D' END AS result,
       '2001 Cup ' || l_returnflag AS competition
FROM (SELECT *, l_shipdate::DATE AS ship, (SELECT max(l_shipdate)::DATE FROM lineitem) AS newest,
             l_partkey % (SELECT count(*) FROM supplier) AS opp,
             CASE WHEN l_quantity >= 49 THEN 15 ELSE trunc(l_quantity)::INTEGER % 8 END::DOUBLE AS gf,
             ((l_partkey + l_linenumber) % 6)::DOUBLE AS ga
      FROM lineitem) l JOIN supplier ON l_suppkey = s_suppkey
WHERE opp <> l_suppkey""",
    "game_raw": """
SELECT 'feed' AS provider, 'S' || team_id_master AS team_id_source, team_id_master, team AS team_name, club AS club_name,
       opponent AS opponent_name, opponent_id_master AS opponent_id, age_group, gender, state,
       CASE WHEN day(date) = 31 THEN 'not a date' ELSE strftime(date, '%Y-%m-%d') END AS game_date, home_away,
       CASE WHEN gf = 7 THEN NULL WHEN gf = 6 THEN 'n/a' ELSE gf::INTEGER::VARCHAR END AS goals_for,
       ga::INTEGER::VARCHAR AS goals_against, result, competition, 'Field ' || ga::INTEGER AS venue,
       CASE WHEN ga = 5 THEN 'Mesa' ELSE '' END AS city,
       'https://feed.example.com/teams/' || team_id_master AS source_url,
       strftime(date, '%Y-%m-%d') || 'T10:00:00Z' AS scraped_at
FROM game_norm""",
    "game_clean": """
SELECT * EXCLUDE (game_date, goals_for, goals_against), try_strptime(game_date, '%Y-%m-%d')::DATE AS date,
       try_cast(goals_for AS DOUBLE) AS gf, try_cast(goals_against AS DOUBLE) AS ga
FROM game_raw
WHERE try_strptime(game_date, '%Y-%m-%d') IS NOT NULL AND try_cast(goals_for AS DOUBLE) IS NOT NULL
  AND try_cast(goals_against AS DOUBLE) IS NOT NULL""",
    "alias": "SELECT 'A' || s_suppkey AS alias_id, s_suppkey::VARCHAR AS canonical_id FROM supplier WHERE s_suppkey % 2 = 0",
    "feed": f"""
SELECT CASE WHEN c_custkey % 101 = 0 THEN NULL WHEN c_custkey % 103 = 0 THEN '  '
            ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' FC District ' || (c_custkey % 13) || ' Squad ' || (c_custkey // 2) END AS team_name,
       'U' || (8 + (c_custkey // 2) % 12) AS age_group,
       {lst(FEED_GENDERS)}[(c_custkey // 2) % 7 + 1] AS gender,
       {lst(FEED_STATES)}[c_nationkey + 1] AS state,
       CASE WHEN c_custkey % 5 <> 0 THEN c_custkey || '.0' END AS team_id,
       (c_custkey % 500)::INTEGER AS rank, floor(c_acctbal)::BIGINT AS points,
       {lst(FEED_PROVIDERS)}[(c_custkey + copy) % 3 + 1] || ' Rankings' AS source,
       {lst(FEED_PROVIDERS)}[(c_custkey + copy) % 3 + 1] AS provider,
       CASE WHEN c_custkey % 3 = 0 THEN 'Club ' || (c_custkey % 11) END AS club_name,
       'https://feed.example.com/team/' || c_custkey AS url,
       strftime(DATE '2001-11-05' - (c_custkey % 300)::INTEGER, '%Y-%m-%d') AS last_seen_active_date,
       c_custkey AS custkey, copy::INTEGER AS copy
FROM (SELECT *, unnest(CASE WHEN c_custkey % 4 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM customer) c""",
    "feed_us": f"""
SELECT * FROM (SELECT * EXCLUDE (state), {REGION_CASE} AS state FROM feed)
WHERE state NOT IN {inlist(NON_US)} AND length(state) >= 2""",
    "migrated": f"""
SELECT {team_id('team_name', 'state', 'age_u', 'gender')} AS team_id, * FROM (
  SELECT team_id AS provider_team_id, team_name, age_group, {AGE_CASE} AS age_u, {GENDER_CASE} AS gender, state, provider,
         club_name, url AS source_url, rank, points, last_seen_active_date, custkey, copy
  FROM feed WHERE team_name IS NOT NULL AND regexp_full_match(state, '[A-Z]{{2}}')) m""",
    "master": """
SELECT * FROM (SELECT * FROM migrated WHERE age_u IS NOT NULL AND gender IS NOT NULL AND trim(team_name) <> '') m""",
    # ------------------------------------------------------------ rating layers
    "scenario_rows": _scenario_rows(),
    "sel_base": """
SELECT * FROM (
  SELECT team_id_master, opponent_id_master, date, gf, ga, team, club, state, gender, age_group,
         row_number() OVER (PARTITION BY team_id_master ORDER BY date DESC NULLS LAST, opponent_id_master NULLS LAST, gf, ga) - 1 AS game_index
  FROM game_norm WHERE date >= (SELECT d FROM as_of) - 540) s
WHERE game_index < 40""",
    "sel_cut": """
SELECT b.*, r.*, count(*) OVER (PARTITION BY r.scenario, team_id_master) AS n
FROM sel_base b, scenario_rows r
WHERE game_index < r.max_games AND date >= (SELECT d FROM as_of) - r.window_days""",
    "sel_stats": """
SELECT *, greatest(-7, least(7, greatest(-goal_diff_cap, least(goal_diff_cap, gf - ga)))) AS goal_diff,
       avg(gf) OVER t AS gf_mean, stddev_samp(gf) OVER t AS gf_std, avg(ga) OVER t AS ga_mean, stddev_samp(ga) OVER t AS ga_std,
       CASE WHEN n < recent_k THEN 0 WHEN game_index < recent_k THEN recent_share / recent_k
            ELSE (1 - recent_share) / (n - recent_k) END
       * CASE WHEN tail_start < n AND tail_end <= n AND game_index >= tail_start AND game_index < tail_end
              THEN tail_start_weight + (tail_end_weight - tail_start_weight) * (game_index - tail_start) / (tail_end - tail_start - 1)
              ELSE 1 END AS w
FROM sel_cut WINDOW t AS (PARTITION BY scenario, team_id_master)""",
    "selected": """
SELECT * EXCLUDE (gf, ga, w, gf_mean, gf_std, ga_mean, ga_std),
       CASE WHEN gf_std > 0 THEN greatest(gf_mean - outlier_z * gf_std, least(gf_mean + outlier_z * gf_std, gf)) ELSE gf END AS gf,
       CASE WHEN ga_std > 0 THEN greatest(ga_mean - outlier_z * ga_std, least(ga_mean + outlier_z * ga_std, ga)) ELSE ga END AS ga,
       CASE WHEN sum(w) OVER t > 0 THEN w / sum(w) OVER t ELSE 0 END AS weight,
       (SELECT d FROM as_of) - date AS days_since
FROM sel_stats WINDOW t AS (PARTITION BY scenario, team_id_master)""",
    "raw": """
SELECT scenario, team_id_master, sum(weight * gf) AS off_raw, sum(weight * greatest(0, 3 - ga)) + any_value(ridge_ga) AS def_raw,
       count(*) AS gp_used
FROM selected GROUP BY 1, 2""",
    "league": """
SELECT scenario, avg(off_raw) AS mean_off, avg(def_raw) AS mean_def, min(off_raw) AS min_off, max(off_raw) AS max_off,
       min(def_raw) AS min_def, max(def_raw) AS max_def FROM raw GROUP BY 1""",
    "strengths": """
SELECT scenario, team_id_master, gp_used,
       (off_raw - min_off) / greatest(1e-9, max_off - min_off) AS off_scaled,
       (def_raw - min_def) / greatest(1e-9, max_def - min_def) AS def_scaled,
       coalesce(greatest(0.67, least(1.5, off_raw / nullif(mean_off, 0))), 1) AS off_ratio,
       coalesce(greatest(0.67, least(1.5, def_raw / nullif(mean_def, 0))), 1) AS def_ratio
FROM raw JOIN league USING (scenario)""",
    "deltas": """
SELECT s.*, t.off_scaled, t.gp_used AS gp, o.team_id_master IS NOT NULL AS known, o.off_ratio AS o_off, o.def_ratio AS o_def,
       t.off_scaled - o.def_scaled AS expected, s.goal_diff - (t.off_scaled - o.def_scaled) AS delta
FROM selected s JOIN strengths t ON s.scenario = t.scenario AND s.team_id_master = t.team_id_master
LEFT JOIN strengths o ON s.scenario = o.scenario AND s.opponent_id_master = o.team_id_master""",
    "factors": """
SELECT *, (1 + adaptive_alpha * abs(expected)) / (1 + adaptive_beta * ln(greatest(1, gp))) AS k,
       CASE WHEN abs(delta) < performance_threshold THEN 1
            ELSE (1 + performance_k * sign(delta)) * exp(-performance_decay * game_index) END
       * (1 + 0.05 * greatest(-2, least(2, delta))) AS f,
       weight * gf AS o, weight * greatest(0, 3 - ga) AS df
FROM deltas""",
    "layers": """
SELECT scenario, team_id_master,
       sum(CASE WHEN known THEN o * o_def ELSE o END) AS sao_raw, sum(CASE WHEN known THEN df * o_off ELSE df END) AS sad_raw,
       sum(CASE WHEN known THEN o * k ELSE o END) AS sao_adjusted, sum(CASE WHEN known THEN df * k ELSE df END) AS sad_adjusted,
       sum(CASE WHEN known THEN o * f ELSE o END) AS sao_perf,
       sum(CASE WHEN known THEN weight * greatest(0, 3 - ga * (2 - f)) ELSE df END) AS sad_perf
FROM factors GROUP BY 1, 2""",
    "shrunk": """
SELECT r.*, y.* EXCLUDE (scenario, team_id_master), (gp_used * sao_perf + shrink_tau * mean_off) / (gp_used + shrink_tau) AS sao_shrunk,
       (gp_used * sad_perf + shrink_tau * mean_def) / (gp_used + shrink_tau) AS sad_shrunk
FROM raw r JOIN layers y USING (scenario, team_id_master) JOIN league USING (scenario)
JOIN (SELECT scenario, shrink_tau FROM scenario_rows) q USING (scenario)""",
    "lookup": """
SELECT scenario, team_id_master AS known_id, 0.5 * sao_shrunk + 0.5 * sad_shrunk AS strength FROM shrunk
UNION ALL
SELECT scenario, alias_id, 0.5 * sao_shrunk + 0.5 * sad_shrunk FROM shrunk JOIN alias ON canonical_id = team_id_master
WHERE alias_id NOT IN (SELECT team_id_master FROM shrunk)""",
    "met": """
SELECT DISTINCT scenario, team_id_master, coalesce(canonical_id, clean) AS known_id
FROM (SELECT scenario, team_id_master, regexp_replace(trim(opponent_id_master), '\\.0$', '') AS clean FROM selected) s
LEFT JOIN alias ON alias_id = clean WHERE clean IS NOT NULL AND clean <> ''""",
    "sos": """
SELECT scenario, team_id_master, avg(coalesce(strength, 0.35)) AS sos_component
FROM met LEFT JOIN lookup USING (scenario, known_id) WHERE known_id <> team_id_master GROUP BY 1, 2""",
    "scheduled": """
SELECT s.*, coalesce(sos_component, 0.35) AS sos_component FROM shrunk s LEFT JOIN sos USING (scenario, team_id_master)""",
    "held": """
SELECT s.*, greatest(quantile_cont(sao_shrunk, 0.01) OVER p, least(quantile_cont(sao_shrunk, 0.99) OVER p, sao_shrunk)) AS sao_h,
       greatest(quantile_cont(sad_shrunk, 0.01) OVER p, least(quantile_cont(sad_shrunk, 0.99) OVER p, sad_shrunk)) AS sad_h,
       greatest(quantile_cont(sos_component, 0.01) OVER p, least(quantile_cont(sos_component, 0.99) OVER p, sos_component)) AS sos_h
FROM scheduled s WINDOW p AS (PARTITION BY scenario)""",
    "scaled": """
SELECT * EXCLUDE (sao_h, sad_h, sos_h),
       1 / (1 + exp(-(sao_h - avg(sao_h) OVER p) / coalesce(nullif(stddev_samp(sao_h) OVER p, 0), 1))) AS sao_norm,
       1 / (1 + exp(-(sad_h - avg(sad_h) OVER p) / coalesce(nullif(stddev_samp(sad_h) OVER p, 0), 1))) AS sad_norm,
       1 / (1 + exp(-(sos_h - avg(sos_h) OVER p) / coalesce(nullif(stddev_samp(sos_h) OVER p, 0), 1))) AS sos_norm
FROM held WINDOW p AS (PARTITION BY scenario)""",
    "scored": """
SELECT *, powerscore * gp_mult * CASE WHEN gp_used < 8 THEN 0.85 WHEN gp_used < 15 THEN 0.95 ELSE 1 END AS powerscore_adj,
       (SELECT d FROM as_of) - last_game_date <= inactive_days AS is_active,
       CASE WHEN gp_used >= min_games AND (SELECT d FROM as_of) - last_game_date <= inactive_days
            THEN 'Active' ELSE 'Provisional' END AS status
FROM (SELECT s.*, off_weight * sao_norm + def_weight * sad_norm + sos_weight * sos_norm AS powerscore,
             pow(least(gp_used, 20) / 20.0, provisional_alpha) AS gp_mult, inactive_days, min_games,
             n.date AS last_game_date, team, club, state, gender, age_group
      FROM scaled s JOIN scenario_rows USING (scenario)
      JOIN (SELECT scenario, team_id_master, date, team, club, state, gender, age_group FROM selected WHERE game_index = 0) n
        USING (scenario, team_id_master)) q""",
    "ranking": """
SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY round(powerscore_adj, 9) DESC, round(sao_norm, 9) DESC,
       round(sad_norm, 9) DESC, round(sos_norm, 9) DESC, gp_used DESC, team_id_master) AS rank,
       row_number() OVER (PARTITION BY scenario, state ORDER BY round(powerscore_adj, 9) DESC, round(sao_norm, 9) DESC,
       round(sad_norm, 9) DESC, round(sos_norm, 9) DESC, gp_used DESC, team_id_master) AS rank_state
FROM scored""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind a WITH clause of everything it needs, directly or not."""
    known = {**CTES, **(extra or {})}
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in set(re.findall(r"\b[a-z_0-9]+\b", text)) & known.keys() - needed:
            needed.add(name)
            todo.append(known[name])
    parts = [f"{name} AS ({known[name].strip()})" for name in known if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


# ---------------------------------------------------------------- weighted score of two names

def ratio_sql(x: str, y: str) -> str:
    """2 * common subsequence / total length of two texts of at most 63 letters, the subsequence found bit by bit."""
    every = f"((1::HUGEINT << length({x})) - 1)"
    masks = (f"list_transform(string_split({y}, ''), lambda ch: list_sum(list_transform(range(0, length({x})), "
             f"lambda i: CASE WHEN {x}[i + 1] = ch THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END)))")
    row = f"list_reduce({masks}, lambda s, m: ((s + (s & m)) | (s - (s & m))) & {every}, {every})"
    return (f"(CASE WHEN length({x}) + length({y}) = 0 THEN 1.0::DOUBLE WHEN length({x}) = 0 OR length({y}) = 0 THEN 0.0::DOUBLE "
            f"ELSE 2.0::DOUBLE * (length({x}) - bit_count({row})) / (length({x}) + length({y})) END)")


def partial_sql(x: str, y: str) -> str:
    """Best ratio of the shorter text with a window of the longer, which is longer by at least one letter."""
    short, long = (f"(CASE WHEN (length({x}) < length({y})) = {side} THEN {x} ELSE {y} END)" for side in ("TRUE", "FALSE"))
    window = f"substring({long}, greatest(p, 0)::INT + 1, (p + length({short}) - greatest(p, 0))::INT)"
    return (f"list_max(list_transform(list_distinct(list_transform(range(1 - length({short}), length({long})), lambda p: {window})), "
            f"lambda w: {ratio_sql(short, 'w')}))")


def scored_sql(pairs: str) -> str:
    """``pairs`` (with a and b) and their weighted score; a and b are not equal and not empty."""
    split = lambda c: f"list_sort(list_filter(string_split(regexp_replace({c}, '\\s+', ' ', 'g'), ' '), lambda w: w <> ''))"
    text = lambda c: f"array_to_string({c}, ' ')"
    near = "greatest(length(a), length(b)) < 1.5 * least(length(a), length(b))"
    return f"""
SELECT * EXCLUDE (wa, wb, both_w, only_a, only_b, sa, sb, shared, with_a, with_b), CASE WHEN {near} THEN greatest({ratio_sql('a', 'b')}, 0.95 * greatest(
    {ratio_sql('sa', 'sb')}, {ratio_sql('with_a', 'with_b')}, CASE WHEN shared <> '' THEN {ratio_sql('shared', 'with_a')} ELSE 0 END,
    CASE WHEN shared <> '' THEN {ratio_sql('shared', 'with_b')} ELSE 0 END, CASE WHEN shared <> '' AND (len(only_a) = 0 OR len(only_b) = 0) THEN 1 ELSE 0 END))
  ELSE greatest({ratio_sql('a', 'b')}, CASE WHEN greatest(length(a), length(b)) <= 8 * least(length(a), length(b)) THEN 0.9 ELSE 0.6 END
    * greatest({partial_sql('a', 'b')}, 0.95 * CASE WHEN shared <> '' THEN 1 ELSE {partial_sql('sa', 'sb')} END)) END::DOUBLE AS score
FROM (SELECT *, {text('wa')} AS sa, {text('wb')} AS sb, {text('both_w')} AS shared, {text('list_concat(both_w, only_a)')} AS with_a, {text('list_concat(both_w, only_b)')} AS with_b
  FROM (SELECT *, list_sort(list_distinct(list_intersect(wa, wb))) AS both_w, list_sort(list_distinct(list_filter(wa, lambda w: NOT list_contains(wb, w)))) AS only_a,
      list_sort(list_distinct(list_filter(wb, lambda w: NOT list_contains(wa, w)))) AS only_b
    FROM (SELECT *, {split('a')} AS wa, {split('b')} AS wb FROM ({pairs}) p1) p2) p3) p4"""
