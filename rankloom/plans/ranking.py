"""The layered rating: from games to a ranked table, all scenarios and pools in one job.

A *run key* is the scenario plus optional pool columns (for example gender and
age group). Every layer is keyed by it, so rating one slice, all slices or a
whole scenario sweep is the same plan. Scenarios that agree in all parameters a
layer and those below it read share its rows, which are copied to each scenario
where the first differing layer begins. Layers:

select -> weights -> raw -> opponent / adaptive / performance -> shrink ->
schedule strength -> scale -> score -> rank.

What is written to the shared folder between layers: the selected games (at
most ``max_games`` rows per team and scenario), and three team-level tables.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.config import BASELINE, RatingConfig, as_dict
from rankloom.functions.joins import join_on
from rankloom.functions import stats
from rankloom.functions.ids import canonical_id, spread_null
from rankloom.operators import graph
from rankloom.operators.ordering import exact_quantiles, ranked
from rankloom.operators.windows import recent_games
from rankloom.storage import stage

TEAM = "team_id_master"
OPPONENT = "opponent_id_master"
ATTRIBUTES = ("team", "club", "state", "gender", "age_group")
EPS = 1e-9

METRICS = (
    "off_raw", "def_raw", "sao_raw", "sad_raw", "sao_adjusted", "sad_adjusted", "sao_perf", "sad_perf",
    "sao_shrunk", "sad_shrunk", "sos_component", "sao_norm", "sad_norm", "sos_norm", "powerscore",
    "powerscore_adj", "gp_mult",
)
# Parameters that decide the rows of a layer, those of the layers below it included.
SELECTION = (
    "window_days", "max_games", "goal_diff_cap", "outlier_z", "recent_k", "recent_share", "tail_start", "tail_end",
    "tail_start_weight", "tail_end_weight", "fill_short_history", "ridge_ga",
)
CONTRIBUTION = (
    *SELECTION, "performance_k", "performance_decay", "performance_threshold", "adaptive_alpha", "adaptive_beta")
SCHEDULE = (*CONTRIBUTION, "shrink_tau", "unranked_base")
RANK_ORDER = ("powerscore_adj", "sao_norm", "sad_norm", "sos_norm", "gp_used")


@dataclass(frozen=True)
class RunSpec:
    """What to rate: configurations by scenario name, the as-of date and the pools."""

    configs: Mapping[str, RatingConfig]
    as_of: str
    pool_cols: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return ["scenario", *self.pool_cols]

    @property
    def team_keys(self) -> list[str]:
        return [*self.keys, TEAM]

    @property
    def as_of_date(self) -> Column:
        return F.lit(self.as_of).cast("date")

    def param(self, name: str) -> Column:
        """The parameter: a literal for one scenario, else a field of the row's ``_cfg`` (see ``with_params``)."""
        if len(self.configs) == 1:
            return F.lit(as_dict(next(iter(self.configs.values())))[name])
        return F.col(f"_cfg.{name}")

    def _alike(self, names: Sequence[str]) -> dict[str, list[str]]:
        """Scenarios with equal values of the parameters, by the first of them."""
        sets: dict[tuple, list[str]] = {}
        for scenario, config in self.configs.items():
            sets.setdefault(tuple(as_dict(config)[n] for n in names), []).append(scenario)
        return {found[0]: found for found in sets.values()}

    def shared(self, names: Sequence[str]) -> RunSpec:
        """The run with one scenario for all that agree in the parameters."""
        return replace(self, configs={scenario: self.configs[scenario] for scenario in self._alike(names)})

    def spread(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        """Rows of ``shared(names)`` once for every scenario they stand for; no names: the rows have every scenario."""
        alike = self._alike(names) if names else {}
        if all(len(found) == 1 for found in alike.values()):
            return df
        copies = F.from_json(F.lit(json.dumps(alike)), "map<string, array<string>>")
        return df.withColumn("scenario", F.explode(F.element_at(copies, F.col("scenario"))))

    def _scenario_structs(self) -> Column:
        """All configurations as one constant: parsing a text is far cheaper to build than a literal per value."""
        kinds = {bool: "boolean", int: "int", float: "double", str: "string"}
        fields = ", ".join(f"{k}: {kinds[type(v)]}" for k, v in as_dict(BASELINE).items())
        rows = [
            {"scenario": name, "_cfg": {k: type(v)(as_dict(c)[k]) for k, v in as_dict(BASELINE).items()}}
            for name, c in self.configs.items()
        ]
        return F.from_json(F.lit(json.dumps(rows)), f"array<struct<scenario: string, _cfg: struct<{fields}>>>")

    def per_scenario(self, df: DataFrame) -> DataFrame:
        """Each row once per scenario, with its ``scenario`` and, where they differ, its parameters."""
        if len(self.configs) == 1:
            return df.withColumn("scenario", F.lit(next(iter(self.configs))))
        return df.select("*", F.explode(self._scenario_structs()).alias("_s")).select("*", "_s.scenario", "_s._cfg").drop("_s")

    def with_params(self, df: DataFrame) -> DataFrame:
        """Adds ``_cfg`` to rows that carry a scenario. The joined table has one row per configuration."""
        if len(self.configs) == 1:
            return df
        table = df.sparkSession.range(1).select(F.explode(self._scenario_structs()).alias("_s")).select("_s.*")
        return df.join(F.broadcast(table), "scenario")


def run_spec(
    as_of: str, configs: RatingConfig | Mapping[str, RatingConfig] = BASELINE, pool_cols: Sequence[str] = ()
) -> RunSpec:
    named = {"baseline": configs} if isinstance(configs, RatingConfig) else dict(configs)
    return RunSpec(named, as_of, tuple(pool_cols))


# ---------------------------------------------------------------- selection

def within_window(games: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Games on or after ``as_of`` minus ``days``; the comparison reaches the scan."""
    return games.where(F.col("date") >= F.date_sub(as_of, days))


def select_games(games: DataFrame, spec: RunSpec) -> DataFrame:
    """Each team's newest games per scenario, prepared: capped difference, guarded goals, weights.

    The widest window and largest count are taken once; each scenario's games
    are a prefix of those, so the games table is read and shuffled once.
    """
    widest = max(c.window_days for c in spec.configs.values())
    most = max(c.max_games for c in spec.configs.values())
    needed = list(dict.fromkeys([TEAM, OPPONENT, "date", "gf", "ga", *ATTRIBUTES, *spec.pool_cols]))
    base = within_window(games.select(*needed).where(F.col(TEAM).isNotNull()), spec.as_of_date, widest)
    base = recent_games(base, [*spec.pool_cols, TEAM], most)
    base = spec.per_scenario(base).where(
        (F.col("game_index") < spec.param("max_games"))
        & (F.datediff(spec.as_of_date, F.col("date")) <= spec.param("window_days"))
    )
    team = Window.partitionBy(*spec.team_keys)
    base = base.withColumn("n", F.count("*").over(team)).withColumn(
        "goal_diff", stats.capped_goal_diff(F.col("gf"), F.col("ga"), spec.param("goal_diff_cap"))
    )
    for c in ("gf", "ga"):
        base = base.withColumn(
            f"{c}_kept",
            stats.sigma_clip(F.col(c).cast("double"), F.avg(c).over(team), F.stddev_samp(c).over(team),
                             spec.param("outlier_z")),
        )
    taper = stats.taper(
        F.col("game_index"), F.col("n"), spec.param("recent_k"), spec.param("recent_share"),
        spec.param("tail_start"), spec.param("tail_end"), spec.param("tail_start_weight"),
        spec.param("tail_end_weight"), spec.param("fill_short_history"),
    )
    total = F.sum("_w").over(team)
    return (
        base.withColumn("gf", F.col("gf_kept")).withColumn("ga", F.col("ga_kept")).drop("gf_kept", "ga_kept")
        .withColumn("_w", taper)
        .withColumn("weight", F.when(total > 0, F.col("_w") / total).otherwise(0.0))
        .drop("_w", "_cfg")
        .withColumn("days_since", F.datediff(spec.as_of_date, F.col("date")))
    )


# ---------------------------------------------------------------- raw layer

def _defence() -> Column:
    return F.greatest(F.lit(0.0), 3.0 - F.col("ga"))


def team_raw(selected: DataFrame, spec: RunSpec) -> DataFrame:
    """Weighted goals scored, weighted defence with its ridge, and games used per team."""
    sums = selected.groupBy(*spec.team_keys).agg(
        F.sum(F.col("weight") * F.col("gf")).alias("off_raw"),
        F.sum(F.col("weight") * _defence()).alias("_def"),
        F.count("*").alias("gp_used"),
    )
    return spec.with_params(sums).withColumn("def_raw", F.col("_def") + spec.param("ridge_ga")).drop("_def", "_cfg")


def league_stats(raw: DataFrame, spec: RunSpec) -> DataFrame:
    """Means and ranges of the raw layer, one row per run key."""
    return raw.groupBy(*spec.keys).agg(
        F.avg("off_raw").alias("mean_off"), F.avg("def_raw").alias("mean_def"),
        F.min("off_raw").alias("min_off"), F.max("off_raw").alias("max_off"),
        F.min("def_raw").alias("min_def"), F.max("def_raw").alias("max_def"),
    )


def strength_lookup(raw: DataFrame, league: DataFrame, spec: RunSpec) -> DataFrame:
    """What a game needs to know about a team: scaled attack and defence, and ratios to the mean.

    A league mean of 0 (nobody has enough games) gives the neutral ratio 1.
    """
    def ratio(value: str, mean: str) -> Column:
        return F.coalesce(stats.clip(F.col(value) / F.nullif(F.col(mean), F.lit(0.0)), 0.67, 1.5), F.lit(1.0))

    def scaled(value: str, low: str, high: str) -> Column:
        return (F.col(value) - F.col(low)) / F.greatest(F.lit(EPS), F.col(high) - F.col(low))

    return join_on(raw, league, spec.keys).select(
        *spec.team_keys, "gp_used",
        scaled("off_raw", "min_off", "max_off").alias("off_scaled"),
        scaled("def_raw", "min_def", "max_def").alias("def_scaled"),
        ratio("off_raw", "mean_off").alias("off_ratio"),
        ratio("def_raw", "mean_def").alias("def_ratio"),
    )


# ---------------------------------------------------------------- game layers

def game_contributions(selected: DataFrame, strengths: DataFrame, spec: RunSpec, shared: Sequence[str] = ()) -> DataFrame:
    """Per game: opponent, adaptive and performance contributions, raw where the opponent is unknown.

    ``shared``: both inputs are rows of ``spec.shared(shared)``.
    """
    opponent = strengths.select(
        *spec.keys, F.col(TEAM).alias("_opp_key"), F.col("off_ratio").alias("opp_off_ratio"),
        F.col("def_ratio").alias("opp_def_ratio"), F.col("def_scaled").alias("opp_def_scaled"),
    )
    own = strengths.select(*spec.team_keys, "off_scaled", "gp_used")
    rows = selected.select(
        *spec.team_keys, OPPONENT, "game_index", "gf", "ga", "goal_diff", "weight",
        spread_null(F.col(OPPONENT), TEAM, "game_index").alias("_opp_key"),
    )
    # Opponent first, own team last: the rows then already sit by team for the sum that follows.
    rows = join_on(join_on(rows, opponent, [*spec.keys, "_opp_key"], "left"), own, spec.team_keys)
    rows = spec.with_params(spec.spread(rows, shared))
    known = F.col("opp_def_scaled").isNotNull()
    off, dfn = F.col("weight") * F.col("gf"), F.col("weight") * _defence()
    expected = F.col("off_scaled") - F.col("opp_def_scaled")
    k = stats.adaptive_k(expected, F.col("gp_used"), spec.param("adaptive_alpha"), spec.param("adaptive_beta"))
    delta = F.col("goal_diff") - expected
    factor = stats.performance_factor(
        delta, spec.param("performance_k"), spec.param("performance_decay"), F.col("game_index"),
        spec.param("performance_threshold"),
    ) * (1.0 + 0.05 * stats.clip(delta, -2.0, 2.0))
    scaled_defence = F.greatest(F.lit(0.0), 3.0 - F.col("ga") * (2.0 - factor))
    return rows.select(
        *spec.team_keys, OPPONENT, "game_index", "weight",
        F.when(known, off * F.col("opp_def_ratio")).otherwise(off).alias("off_vs"),
        F.when(known, dfn * F.col("opp_off_ratio")).otherwise(dfn).alias("def_vs"),
        F.when(known, off * k).otherwise(off).alias("off_adaptive"),
        F.when(known, dfn * k).otherwise(dfn).alias("def_adaptive"),
        F.when(known, off * factor).otherwise(off).alias("off_perf"),
        F.when(known, F.col("weight") * scaled_defence).otherwise(dfn).alias("def_perf"),
    )


def team_layers(contributions: DataFrame, spec: RunSpec) -> DataFrame:
    return contributions.groupBy(*spec.team_keys).agg(
        F.sum("off_vs").alias("sao_raw"), F.sum("def_vs").alias("sad_raw"),
        F.sum("off_adaptive").alias("sao_adjusted"), F.sum("def_adaptive").alias("sad_adjusted"),
        F.sum("off_perf").alias("sao_perf"), F.sum("def_perf").alias("sad_perf"),
    )


def shrink(raw: DataFrame, layers: DataFrame, league: DataFrame, spec: RunSpec) -> DataFrame:
    """Performance layer pulled towards the league's raw mean."""
    tau = spec.param("shrink_tau")
    rows = join_on(join_on(raw, layers, spec.team_keys), league.select(*spec.keys, "mean_off", "mean_def"), spec.keys)
    return (
        spec.with_params(rows)
        .withColumn("sao_shrunk", stats.shrunk(F.col("sao_perf"), F.col("gp_used"), F.col("mean_off"), tau))
        .withColumn("sad_shrunk", stats.shrunk(F.col("sad_perf"), F.col("gp_used"), F.col("mean_def"), tau))
        .drop("mean_off", "mean_def", "_cfg")
    )


# ---------------------------------------------------------------- schedule strength

def alias_strengths(strengths: DataFrame, aliases: DataFrame | None, spec: RunSpec) -> DataFrame:
    """Strength under every id a team is known by; a real team id wins over an alias."""
    named = strengths.select(
        *spec.keys, canonical_id(F.col(TEAM)).alias("known_id"), "strength", F.lit(1).alias("_real")
    )
    if aliases is not None:
        pairs = aliases.select(F.col("alias_id").alias("_alias"), F.col("canonical_id").alias("known_id"))
        named = named.unionByName(
            named.join(pairs, "known_id")
            .select(*spec.keys, F.col("_alias").alias("known_id"), "strength", F.lit(0).alias("_real"))
        )
    return named.groupBy(*spec.keys, "known_id").agg(
        F.coalesce(F.max(F.when(F.col("_real") == 1, F.col("strength"))), F.max("strength")).alias("strength")
    )


def schedule_strength(
    selected: DataFrame, shrunk: DataFrame, spec: RunSpec, aliases: DataFrame | None = None, shared: Sequence[str] = ()
) -> DataFrame:
    """Mean strength of each team's distinct opponents; unknown opponents count at the base value.

    ``shared``: ``selected`` are rows of ``spec.shared(shared)``.
    """
    strength = 0.5 * F.col("sao_shrunk") + 0.5 * F.col("sad_shrunk")
    # Staged, so that a popular opponent's pairs can be split against it.
    lookup = stage(alias_strengths(shrunk.select(*spec.team_keys, strength.alias("strength")), aliases, spec), "strengths")
    base = spec.param("unranked_base")
    pairs = selected.select(*spec.team_keys, canonical_id(F.col(OPPONENT)).alias("known_id")).where(
        F.col("known_id").isNotNull()
    )
    if aliases is not None:
        targets = aliases.select(F.col("alias_id").alias("known_id"), F.col("canonical_id").alias("_target"))
        pairs = pairs.join(targets, "known_id", "left").select(
            *spec.team_keys, F.coalesce("_target", "known_id").alias("known_id")
        )
    # One distinct after resolving; the mean below then counts each opponent once.
    pairs = pairs.distinct()
    pairs = spec.spread(pairs.where(F.col("known_id") != canonical_id(F.col(TEAM))), shared)
    met = (
        spec.with_params(join_on(pairs, lookup, [*spec.keys, "known_id"], "left"))
        .groupBy(*spec.team_keys)
        .agg(F.avg(F.coalesce(F.col("strength"), base)).alias("sos_component"))
    )
    return spec.with_params(join_on(shrunk, met, spec.team_keys, "left")).withColumn(
        "sos_component", F.coalesce(F.col("sos_component"), base)
    ).drop("_cfg")


# ---------------------------------------------------------------- scaling and score

def robust_scale(
    df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], low: float = 0.01, high: float = 0.99
) -> DataFrame:
    """Hold to two quantiles, standardize with the sample deviation, squash to (0, 1).

    ``cols`` maps input to output columns. No spread at all gives 0.5.
    ``df`` should be staged: it is read for the quantiles, the spread and the result.
    """
    bounds = stage(exact_quantiles(df, keys, list(cols), [low, high]), "quantiles")
    held = join_on(df, bounds, keys)
    for c in cols:
        held = held.withColumn(f"{c}_held", stats.clip(F.col(c), F.col(f"{c}_q")[0], F.col(f"{c}_q")[1]))
    spread = held.groupBy(*keys).agg(
        *[F.avg(f"{c}_held").alias(f"{c}_mean") for c in cols],
        *[F.stddev_samp(f"{c}_held").alias(f"{c}_std") for c in cols],
    )
    scaled = join_on(held, stage(spread, "spread"), keys)
    for c, out in cols.items():
        deviation = F.coalesce(F.nullif(F.col(f"{c}_std"), F.lit(0.0)), F.lit(1.0))
        scaled = scaled.withColumn(out, stats.logistic((F.col(f"{c}_held") - F.col(f"{c}_mean")) / deviation))
    return scaled.select(*df.columns, *cols.values())


def range_scale(
    df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """Alternative: stretch between two quantiles to 0..1, then squash; equal quantiles give 0.5."""
    bounds = stage(exact_quantiles(df, keys, list(cols), [low, high]), "quantiles")
    held = join_on(df, bounds, keys)
    for c, out in cols.items():
        a, b = F.col(f"{c}_q")[0], F.col(f"{c}_q")[1]
        share = (stats.clip(F.col(c), a, b) - a) / F.nullif(b - a, F.lit(0.0))
        held = held.withColumn(out, F.when(a == b, 0.5).otherwise(stats.logistic(6.0 * (share - 0.5))))
    return held.select(*df.columns, *cols.values())


def score(scaled: DataFrame, spec: RunSpec) -> DataFrame:
    """Weighted score, games multiplier and the stepwise floor for short records."""
    gp = F.col("gp_used")
    sos = F.col("sos_norm")
    sos = F.when(spec.param("apply_sos_stretch"), F.pow(sos, spec.param("sos_stretch"))).otherwise(sos)
    floor = F.when(~spec.param("stepwise_floor"), 1.0).when(gp < 8, 0.85).when(gp < 15, 0.95).otherwise(1.0)
    return (
        spec.with_params(scaled).withColumn("sos_norm", sos)
        .withColumn(
            "powerscore",
            spec.param("off_weight") * F.col("sao_norm") + spec.param("def_weight") * F.col("sad_norm")
            + spec.param("sos_weight") * F.col("sos_norm"),
        )
        .withColumn("gp_mult", F.pow(F.least(gp, F.lit(20)) / 20.0, spec.param("provisional_alpha")))
        .withColumn("powerscore_adj", F.col("powerscore") * F.col("gp_mult") * floor)
        .drop("_cfg")
    )


def with_status(teams: DataFrame, spec: RunSpec) -> DataFrame:
    return spec.with_params(teams).withColumn(
        "is_active", F.datediff(spec.as_of_date, F.col("last_game_date")) <= spec.param("inactive_days")
    ).withColumn(
        "status",
        F.when((F.col("gp_used") >= spec.param("min_games")) & F.col("is_active"), "Active").otherwise("Provisional"),
    ).drop("_cfg")


def rank_order() -> list[Column]:
    """Score and its parts, best first; scores are compared to 9 decimals, then the team id decides.

    Sums of doubles depend on the order of addition. Rounding keeps teams with
    the same record together so that the id breaks the tie on every run.
    """
    return [F.round(F.col(c).cast("double"), 9).desc() for c in RANK_ORDER] + [F.col(TEAM).asc()]


def rank_rows(teams: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return ranked(teams, list(keys), rank_order(), name)


# ---------------------------------------------------------------- the whole run

def rate_teams(games: DataFrame, spec: RunSpec, aliases: DataFrame | None = None) -> DataFrame:
    """All layers up to the score, one row per run key and team (staged, unranked)."""
    chosen, played, met = (spec.shared(names) for names in (SELECTION, CONTRIBUTION, SCHEDULE))
    selected = stage(select_games(games, chosen), "selected")
    raw = stage(team_raw(selected, chosen), "team_raw")
    league = stage(league_stats(raw, chosen), "league")
    strengths = strength_lookup(raw, league, chosen)
    layers = met.spread(team_layers(game_contributions(selected, strengths, played, SELECTION), played), CONTRIBUTION)
    shrunk = stage(shrink(met.spread(raw, SELECTION), layers, met.spread(league, SELECTION), met), "shrunk")
    scheduled = stage(spec.spread(schedule_strength(selected, shrunk, met, aliases, SELECTION), SCHEDULE), "scheduled")
    scaled = robust_scale(
        scheduled, spec.keys,
        {"sao_shrunk": "sao_norm", "sad_shrunk": "sad_norm", "sos_component": "sos_norm"},
    )
    newest = spec.spread(selected.where(F.col("game_index") == 0).select(
        *spec.team_keys, F.col("date").alias("last_game_date"), *[c for c in ATTRIBUTES if c not in spec.pool_cols]
    ), SELECTION)
    return stage(with_status(join_on(score(scaled, spec), newest, spec.team_keys), spec), "scored")


def rank_teams(
    games: DataFrame,
    spec: RunSpec,
    aliases: DataFrame | None = None,
    state: str | None = None,
    connectivity: bool = False,
) -> DataFrame:
    """The ranking table: ``rank`` and ``rank_national`` within each run key.

    ``state`` keeps one state after all teams were rated and ranks it again.
    ``connectivity`` adds component id, size and degree from all games in the
    window; without it the columns hold one component of all teams.
    """
    teams = rate_teams(games, spec, aliases)
    if state is not None and state != "ALL":
        teams = stage(teams.where(F.col("state") == state), "one_state")
    ranking = rank_rows(teams, spec.keys, "rank_national").withColumn("rank", F.col("rank_national"))
    if connectivity:
        windowed = within_window(games, spec.as_of_date, max(c.window_days for c in spec.configs.values()))
        parts = graph.connectivity(windowed.select(TEAM, OPPONENT))
        ranking = ranking.join(parts.withColumnRenamed("node", TEAM), TEAM, "left").select(
            *ranking.columns,
            F.coalesce("component_id", F.col(TEAM)).alias("component_id"),
            F.coalesce("component_size", F.lit(1)).alias("component_size"),
            F.coalesce("degree", F.lit(0)).alias("degree"),
        )
    else:
        sizes = stage(teams.groupBy(*spec.keys).agg(F.count("*").alias("component_size")), "sizes")
        ranking = (
            join_on(ranking, sizes, spec.keys)
            .withColumn("component_id", F.lit("0")).withColumn("degree", F.lit(0).cast("long"))
        )
    return ranking.select(
        *[c for c in spec.keys], "rank", "rank_national", TEAM,
        *[c for c in ATTRIBUTES if c not in spec.pool_cols], *METRICS,
        "gp_used", "is_active", "status", "last_game_date", "component_id", "component_size", "degree",
    )


def state_view(ranking: DataFrame, keys: Sequence[str] = ("scenario",)) -> DataFrame:
    """Adds ``rank_state``: position within the state, same order as the ranking."""
    staged = stage(ranking, "ranking")
    return rank_rows(staged, [*keys, "state"], "rank_state")


def run_summary(ranking: DataFrame, keys: Sequence[str] = ("scenario",)) -> DataFrame:
    return ranking.groupBy(*keys).agg(
        F.count("*").alias("total_teams"),
        F.count_if(F.col("status") == "Active").alias("active_teams"),
        F.count_if(F.col("status") == "Provisional").alias("provisional_teams"),
    )
