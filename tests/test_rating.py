"""The rating layers against a plain-Python restatement, and their invariants."""

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankloom.config import BASELINE, as_dict, override, scenarios
from rankloom.operators import ordering
from rankloom.plans import ranking as R
from rankloom.plans import tuning as T
from rankloom.schemas import GAME_NORM
from rankloom.storage import stage

AS_OF = dt.date(2025, 10, 1)


def random_games(seed, teams=25, games=600):
    rng = random.Random(seed)
    rows = []
    for _ in range(games):
        # A third of all games belong to one team.
        t = 0 if rng.random() < 0.33 else rng.randrange(teams)
        o = rng.choice([rng.randrange(teams), rng.randrange(teams), None, 900 + rng.randrange(3), f"{rng.randrange(teams)}.0", f"A{rng.randrange(teams)}"])
        if str(o) == str(t):
            continue
        rows.append((str(t), None if o is None else str(o), f"team {t}", "opp", f"club {t % 3}", ["AZ", "CA", "TX"][t % 3], "M" if t % 2 else "F",
                     f"U{10 + t % 4}", AS_OF - dt.timedelta(days=rng.randrange(1, 60 * (1 + t % 9))),
                     float(rng.choice([0, 1, 2, 3, 4, 15])), float(rng.randrange(6))))
    return rows


def restated(rows, cfg, aliases):
    """Layer by layer over lists, straight from the formulas."""
    clip = lambda x, a, b: min(max(x, a), b)
    by_team = {}
    for r in rows:
        if (AS_OF - r[8]).days <= cfg.window_days:
            by_team.setdefault(r[0], []).append(r)
    teams = {}
    for t, games in by_team.items():
        games = sorted(games, key=lambda r: (-r[8].toordinal(), r[1] is None, r[1] or "", r[9], r[10]))[: cfg.max_games]
        gd = [clip(clip(r[9] - r[10], -cfg.goal_diff_cap, cfg.goal_diff_cap), -7, 7) for r in games]

        def guard(v):
            if len(v) < 2 or statistics.stdev(v) == 0:
                return v
            m, s = statistics.mean(v), statistics.stdev(v)
            return [clip(x, m - cfg.outlier_z * s, m + cfg.outlier_z * s) for x in v]

        gf, ga, n = guard([r[9] for r in games]), guard([r[10] for r in games]), len(games)
        w = [0.0] * n
        if n >= cfg.recent_k:
            for i in range(n):
                w[i] = cfg.recent_share / cfg.recent_k if i < cfg.recent_k else (1 - cfg.recent_share) / (n - cfg.recent_k)
            if cfg.tail_start < n and cfg.tail_end <= n:
                fade = np.linspace(cfg.tail_start_weight, cfg.tail_end_weight, cfg.tail_end - cfg.tail_start)
                for i in range(cfg.tail_start, cfg.tail_end):
                    w[i] *= fade[i - cfg.tail_start]
        total = sum(w)
        w = [x / total if total > 0 else 0.0 for x in w]
        teams[t] = {"opp": [r[1] for r in games], "gd": gd, "gf": gf, "ga": ga, "w": w, "n": n, "last": games[0][8],
                    "off": sum(a * b for a, b in zip(w, gf)),
                    "def": sum(a * max(0, 3 - b) for a, b in zip(w, ga)) + cfg.ridge_ga}
    offs, defs = [x["off"] for x in teams.values()], [x["def"] for x in teams.values()]
    mo, md = statistics.mean(offs), statistics.mean(defs)
    on = {t: (x["off"] - min(offs)) / max(1e-9, max(offs) - min(offs)) for t, x in teams.items()}
    dn = {t: (x["def"] - min(defs)) / max(1e-9, max(defs) - min(defs)) for t, x in teams.items()}
    for t, x in teams.items():
        sao = sad = 0.0
        for i, o in enumerate(x["opp"]):
            if o in teams:
                d = x["gd"][i] - (on[t] - dn[o])
                f = 1.0 if abs(d) < cfg.performance_threshold else (1 + cfg.performance_k * math.copysign(1, d)) * math.exp(-cfg.performance_decay * i)
                f *= 1 + 0.05 * clip(d, -2, 2)
                sao += x["w"][i] * x["gf"][i] * f
                sad += x["w"][i] * max(0, 3 - x["ga"][i] * (2 - f))
            else:
                sao += x["w"][i] * x["gf"][i]
                sad += x["w"][i] * max(0, 3 - x["ga"][i])
        x["sao"] = (x["n"] * sao + cfg.shrink_tau * mo) / (x["n"] + cfg.shrink_tau)
        x["sad"] = (x["n"] * sad + cfg.shrink_tau * md) / (x["n"] + cfg.shrink_tau)
    known = {t: 0.5 * x["sao"] + 0.5 * x["sad"] for t, x in teams.items()}
    for t, x in teams.items():
        ids = {o[:-2] if o.endswith(".0") else o for o in x["opp"] if o is not None}
        ids = {aliases.get(o, o) for o in ids} - {t}
        x["sos"] = statistics.mean([known.get(o, cfg.unranked_base) for o in ids]) if ids else cfg.unranked_base

    def scale(values):
        lo, hi = np.percentile(values, [1, 99])
        held = np.clip(values, lo, hi)
        sd = np.std(held, ddof=1) if len(held) > 1 else 0
        return 1 / (1 + np.exp(-(held - held.mean()) / (sd or 1.0)))

    names = list(teams)
    cols = {c: dict(zip(names, scale([teams[t][c] for t in names]))) for c in ("sao", "sad", "sos")}
    out = {}
    for t, x in teams.items():
        p = cfg.off_weight * cols["sao"][t] + cfg.def_weight * cols["sad"][t] + cfg.sos_weight * cols["sos"][t]
        adj = 0.85 if x["n"] < 8 else 0.95 if x["n"] < 15 else 1.0
        out[t] = p * (min(x["n"], 20) / 20) ** cfg.provisional_alpha * (adj if cfg.stepwise_floor else 1)
    return out


@pytest.mark.parametrize("seed,name", [(1, "baseline"), (2, "sweep_conservative"), (3, "sweep_aggressive")])
def test_scores_match_the_restatement(spark, seed, name):
    rows, cfg = random_games(seed), scenarios()[name]
    aliases = {f"A{i}": str(i) for i in range(0, 25, 2)}
    games = spark.createDataFrame(rows, GAME_NORM)
    found = R.rate_teams(games, R.run_spec(AS_OF.isoformat(), cfg), spark.createDataFrame(list(aliases.items()), "alias_id string, canonical_id string"))
    got = {r["team_id_master"]: r["powerscore_adj"] for r in found.collect()}
    expected = restated(rows, cfg, aliases)
    assert got.keys() == expected.keys()
    for t in expected:
        assert got[t] == pytest.approx(expected[t], abs=1e-9)


def test_row_order_does_not_matter_and_scores_are_shares(spark):
    rows = random_games(5)
    spec = R.run_spec(AS_OF.isoformat())
    results = []
    for order in (rows, rows[::-1]):
        ranking = R.rank_teams(spark.createDataFrame(order, GAME_NORM).repartition(5), spec).orderBy("rank").collect()
        assert all(0 < r["powerscore"] < 1 for r in ranking)
        assert [r["rank"] for r in ranking] == list(range(1, len(ranking) + 1))
        results.append([r["team_id_master"] for r in ranking])
    assert results[0] == results[1]
    selected = R.select_games(spark.createDataFrame(rows, GAME_NORM), spec)
    sums = [r["s"] for r in selected.groupBy("team_id_master").agg(F.round(F.sum("weight"), 9).alias("s")).collect()]
    assert set(sums) <= {0.0, 1.0}


@pytest.mark.parametrize("games,score", [(9, 0.15093458848123580), (14, 0.29283100928692644)])
def test_one_team_slice_gives_the_published_score(spark, games, score):
    rows = [("t", None, "t", "o", None, "CO", "M", "U10", AS_OF - dt.timedelta(days=i), 2.0, 1.0) for i in range(games)]
    cfg = override(BASELINE, {"stepwise_floor": False})
    row = R.rank_teams(spark.createDataFrame(rows, GAME_NORM), R.run_spec(AS_OF.isoformat(), cfg)).first()
    assert row["powerscore"] == pytest.approx(0.5) and row["powerscore_adj"] == pytest.approx(score, abs=1e-12)


def test_pools_equal_separate_runs(spark):
    rows = random_games(7)
    games = spark.createDataFrame(rows, GAME_NORM)
    pooled = R.rank_teams(games, R.run_spec(AS_OF.isoformat(), pool_cols=("gender",)))
    got = {(r["gender"], r["team_id_master"]): (r["rank"], round(r["powerscore_adj"], 9)) for r in pooled.collect()}
    for gender in ("M", "F"):
        alone = R.rank_teams(games.where(F.col("gender") == gender), R.run_spec(AS_OF.isoformat())).collect()
        assert {t: v for (g, t), v in got.items() if g == gender} == {r["team_id_master"]: (r["rank"], round(r["powerscore_adj"], 9)) for r in alone}


def test_scenarios_that_agree_share_layers(spark, monkeypatch):
    changed = {f"changed_{name}": {name: not value if isinstance(value, bool) else max(1, value // 3) if isinstance(value, int) else value * 1.3}
               for name, value in as_dict(BASELINE).items()}
    configs = {name: override(BASELINE, c) for name, c in {"baseline": {}, **changed, "again": {}}.items()}
    games = stage(spark.createDataFrame(random_games(11, 12, 250), GAME_NORM), "games")
    aliases = spark.createDataFrame([("A2", "2"), ("A4", "4")], "alias_id string, canonical_id string")
    spec = R.run_spec(AS_OF.isoformat(), configs, ("gender",))

    def rated():
        rows = R.rank_teams(games, spec, aliases).collect()
        return {(r["scenario"], r["gender"], r["team_id_master"]): [r[c] for c in (
            "rank", "team", "club", "state", "age_group", "gp_used", "status", "last_game_date")] + [pytest.approx(r[c], abs=1e-9) for c in R.METRICS]
            for r in rows}, len(rows)

    assert len(R.run_spec(AS_OF.isoformat(), scenarios()).shared(R.SELECTION).configs) == 7
    assert len(spec.shared(R.SELECTION).configs) == len(R.SELECTION) + 1
    found, size = rated()
    monkeypatch.setattr(R.RunSpec, "shared", lambda self, names: self)
    monkeypatch.setattr(R.RunSpec, "spread", lambda self, df, names: df)
    alone, _ = rated()
    assert size == len(found) and found.keys() == alone.keys() and {s for s, _, _ in found} == set(configs)
    plain = {k: [getattr(v, "expected", v) for v in row] for k, row in found.items()}
    assert all(plain[k] == alone[k] for k in alone)


def test_option_fill_short_history_spreads_weight(spark):
    rows = [("t", None, "t", "o", None, "CO", "M", "U10", AS_OF - dt.timedelta(days=i), 2.0, 1.0) for i in range(4)]
    cfg = override(BASELINE, {"fill_short_history": True})
    weights = [r["weight"] for r in R.select_games(spark.createDataFrame(rows, GAME_NORM), R.run_spec(AS_OF.isoformat(), cfg)).collect()]
    assert weights == pytest.approx([0.25] * 4)


# ---------------------------------------------------------------- ordering

@pytest.fixture(scope="module")
def hot_rows():
    rng = random.Random(11)
    # One group holds a third of all rows, and half of its values are equal.
    return [("hot" if rng.random() < 0.34 else f"g{rng.randrange(30)}", float(rng.choice([0, 0, 0, rng.random()])), i) for i in range(4000)]


def test_positions_by_range_equal_a_full_sort(spark, hot_rows):
    df = spark.createDataFrame(hot_rows, "g string, v double, i int").repartition(7)
    order = [F.desc("v"), F.asc("i")]
    placed = {r["i"]: r["p"] for r in ordering.global_positions(df, [], order, "p").collect()}
    expected = {r[2]: n + 1 for n, r in enumerate(sorted(hot_rows, key=lambda r: (-r[1], r[2])))}
    assert placed == expected
    grouped = {r["i"]: r["p"] for r in ordering.ranked(df, ["g"], order, "p").collect()}
    window = Window.partitionBy("g").orderBy(*order)
    assert grouped == {r["i"]: r["p"] for r in df.withColumn("p", F.row_number().over(window)).collect()}


def test_positions_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    assert sorted((r["g"] or "", r["p"]) for r in ordering.global_positions(df, ["g"], [F.asc("v")], "p").collect()) == [("", 1), ("", 2), ("a", 1)]


def test_quantiles_by_position_equal_the_aggregate(spark, hot_rows):
    extra = [(None, 2.0, -1), (None, 4.0, -2), ("empty", None, -3), ("tied", 7.0, -4), ("tied", 7.0, -5)]
    df = stage(spark.createDataFrame(hot_rows + extra, "g string, v double, i int"))
    probs = [0.0, 0.01, 0.5, 0.9, 0.99, 1.0]
    wanted = F.array(*[F.lit(p) for p in probs])
    for groups in (["g"], []):
        got = {tuple(r[g] for g in groups): r["v_q"] for r in ordering.exact_quantiles(df, groups, ["v"], probs).collect()}
        plain = {tuple(r[g] for g in groups): r["v_q"] for r in df.groupBy(*groups).agg(F.percentile("v", wanted).alias("v_q")).collect()}
        assert got.keys() == plain.keys()
        for k in got:
            assert got[k] == (plain[k] and pytest.approx(plain[k], abs=1e-12))


# ---------------------------------------------------------------- tuning

@pytest.mark.parametrize("block", [1, 7, 50, 1000])
def test_kendall_against_all_pairs(spark, block):
    rng = random.Random(block)
    n = 120
    perm = list(range(1, n + 1))
    rng.shuffle(perm)
    pairs = stage(spark.createDataFrame([("s", i + 1, p) for i, p in enumerate(perm)] + [("one", 1, 1)], "scenario string, r_base long, r_test long"))
    found = {r["scenario"]: r["kendall"] for r in T.kendall(pairs, block_rows=block).collect()}
    bad = sum(1 for i in range(n) for j in range(i + 1, n) if perm[i] > perm[j])
    assert found["s"] == pytest.approx(1 - 4 * bad / (n * (n - 1))) and found["one"] is None


def test_comparison_of_empty_ranking_gives_zeros(spark):
    schema = "state string, gender string, age_group string, team_id_master string, rank long"
    base = spark.createDataFrame([("AZ", "M", "U10", "a", 1)], schema)
    row = T.compare_rankings(base, spark.createDataFrame([], schema)).first()
    assert all(v == 0 for v in row)
    same = T.compare_rankings(base, base).first()
    assert same["top5_overlap"] == 1.0 and same["teams_compared"] == 1
