"""Reports on teams, opponents and rankings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.config import BASELINE, RatingConfig
from rankloom.functions.ids import canonical_id
from rankloom.functions.text import missing_reason
from rankloom.operators.ordering import exact_quantiles, global_positions
from rankloom.storage import stage

#: Side of the grid of two-hop cells, and the teams in a block: at the most a cell's bitmaps take 128 MB.
GRID, LEAST_TEAMS, MOST_TEAMS = 5, 1024, 32_768
MOST_TASKS = 4096


def _won() -> Column:
    return F.col("gf") > F.col("ga")


def _lost() -> Column:
    return F.col("gf") < F.col("ga")


def team_record(games: DataFrame, keys: Sequence[str] = ("team_id_master",)) -> DataFrame:
    """Wins, losses, draws, goals and one-sided results per team."""
    n = F.count("*")
    gd = F.col("gf") - F.col("ga")
    return games.groupBy(*keys).agg(
        n.alias("games"), F.count_if(_won()).alias("wins"), F.count_if(_lost()).alias("losses"),
        F.count_if(gd == 0).alias("draws"), (F.count_if(_won()) * 100.0 / n).alias("win_pct"),
        F.sum("gf").alias("gf_total"), F.sum("ga").alias("ga_total"), F.sum(gd).alias("gd_total"),
        F.avg("gf").alias("gf_avg"), F.avg("ga").alias("ga_avg"), F.avg(gd).alias("gd_avg"),
        F.count_if(F.abs(gd) >= 7).alias("one_sided_games"),
    )


def scouting(games: DataFrame, team: str) -> DataFrame:
    """Record of every opponent of ``team``, by name; weak under 5 games or a 30 % win rate."""
    met = games.where((F.col("team") == team) & F.col("opponent").isNotNull()).select("opponent").distinct()
    wins = F.count_if(F.col("result") == "W")
    n = F.count("*")
    theirs = games.join(met.withColumnRenamed("opponent", "team"), "team", "left_semi").groupBy(
        F.col("team").alias("opponent")
    ).agg(
        n.alias("games"), wins.alias("wins"), F.count_if(F.col("result") == "L").alias("losses"),
        F.count_if(F.col("result") == "D").alias("ties"), (wins / n).alias("win_rate"),
        F.avg("gf").alias("gf_avg"), F.avg("ga").alias("ga_avg"), (F.avg("gf") - F.avg("ga")).alias("goal_diff"),
    )
    return theirs.withColumn("weak", (F.col("games") < 5) | (F.col("win_rate") < 0.3))


def scouting_all(games: DataFrame) -> DataFrame:
    """Per team: opponents in the data, weak ones, and their mean games and win rate."""
    records = games.groupBy(F.col("team").alias("opponent")).agg(
        F.count("*").alias("games"), (F.count_if(F.col("result") == "W") / F.count("*")).alias("win_rate")
    ).withColumn("weak", (F.col("games") < 5) | (F.col("win_rate") < 0.3))
    records = stage(records, "records")  # so that the meetings of a popular opponent can be split
    met = games.select("team", "opponent").where("opponent IS NOT NULL").distinct()
    return met.join(records, "opponent").groupBy("team").agg(
        F.count("*").alias("opponents"), F.count_if("weak").alias("weak_opponents"),
        F.avg("games").alias("avg_opponent_games"), F.avg("win_rate").alias("avg_opponent_win_rate"),
    )


def opponent_presence(games: DataFrame) -> DataFrame:
    """Each team's opponents: games against, whether they are in the data, and their goals."""
    met = games.where(F.col("opponent_id_master").isNotNull()).groupBy("team_id_master", "opponent_id_master").agg(
        F.count("*").alias("games_vs"), F.min("opponent").alias("opponent")
    )
    goals = games.groupBy(F.col("team_id_master").alias("opponent_id_master")).agg(
        F.sum("gf").alias("opp_gf"), F.sum("ga").alias("opp_ga")
    )
    met, goals = stage(met, "meetings"), stage(goals, "goals")  # so that a popular opponent's rows can be split
    joined = met.join(goals, "opponent_id_master", "left")
    return joined.withColumns({
        "present": F.col("opp_gf").isNotNull(),
        "opp_gd": F.col("opp_gf") - F.col("opp_ga"),
        "missing_reason": F.when(F.col("opp_gf").isNull(), missing_reason(F.col("opponent"))),
    })


def ranked_opponents(games: DataFrame, ranking: DataFrame) -> DataFrame:
    """Distinct opponents of each team that have a rank, with rank and score."""
    met = games.select("team_id_master", "opponent_id_master").where("opponent_id_master IS NOT NULL").distinct()
    side = ranking.select(
        F.col("team_id_master").alias("opponent_id_master"), F.col("rank").alias("opp_rank"),
        F.col("powerscore_adj").alias("opp_score"),
    )
    return met.join(side, "opponent_id_master")


def two_hop(games: DataFrame, team_id: str) -> DataFrame:
    """One row for ``team_id``: itself, its opponents and theirs, as a share of all teams."""
    pairs = games.select("team_id_master", "opponent_id_master").where("opponent_id_master IS NOT NULL").distinct()
    first = pairs.where(F.col("team_id_master") == team_id).select(F.col("opponent_id_master").alias("node"))
    second = pairs.join(first.withColumnRenamed("node", "team_id_master"), "team_id_master", "left_semi").select(
        F.col("opponent_id_master").alias("node")
    )
    own = games.where(F.col("team_id_master") == team_id).select(F.col("team_id_master").alias("node"))
    network = first.unionAll(second).unionAll(own).distinct()
    teams = games.agg(F.countDistinct("team_id_master")).scalar()
    return network.agg(F.count("*").alias("network_teams")).withColumn("total_teams", teams).withColumn(
        "connectivity_ratio", F.col("network_teams") / F.nullif(F.col("total_teams"), F.lit(0))
    )


def two_hop_all(games: DataFrame) -> DataFrame:
    """(team_id_master, network_teams): for every team the number of teams within two games of it, itself among them; exact.

    Teams get dense numbers and are cut into blocks. Who has met whom is sent as lists of numbers: to each cell of the
    grid (block of teams, block of teams they reach) goes what its teams have met, and what those have met of the other
    block. A task joins them in one bitmap per team of the cell, opponent by opponent, so neither pairs of pairs nor
    bitmaps are sent, and a pair of teams goes along one row and one column of the grid.
    """
    pairs = games.select("team_id_master", "opponent_id_master").dropna()
    teams = games.select("team_id_master").dropna().distinct()
    # With itself among its opponents a team reaches itself and whom it has met.
    met = stage(pairs.unionByName(teams.withColumn("opponent_id_master", F.col("team_id_master"))).distinct(), "two-hop-pairs")
    ids = met.select(F.col("team_id_master").alias("id")).unionByName(met.select(F.col("opponent_id_master").alias("id"))).distinct()
    numbers = stage(global_positions(ids, [], [F.col("id").asc()], "number").withColumn("number", F.col("number") - 1), "two-hop-numbers")
    n = numbers.count()
    size = min(MOST_TEAMS, max(LEAST_TEAMS, -(-n // GRID)))
    blocks = max(1, -(-n // size))

    def numbered(rows: DataFrame, column: str, name: str) -> DataFrame:
        return rows.join(numbers.select(F.col("id").alias(column), F.col("number").alias(name)), column)

    edges = stage(numbered(numbered(met, "team_id_master", "team"), "opponent_id_master", "opponent").select("team", "opponent"), "two-hop-edges")

    def lists(by: str, of: str, side: str, other: str) -> DataFrame:
        """What ``by`` has to do with each block of ``of``, sent to every cell of that block."""
        places = edges.select(F.col(by).alias("via"), (F.col(of) / size).cast("int").alias(side), (F.col(of) % size).cast("int").alias("at"))
        grouped = places.groupBy("via", side).agg(F.collect_list("at").alias("places"))
        return grouped.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
            "block", "reached", "via", F.lit(by == "team").alias("outgoing"), "places")

    cells = lists("opponent", "team", "block", "reached").unionByName(lists("team", "opponent", "reached", "block"))
    ordered = cells.repartitionById(min(blocks * blocks, MOST_TASKS), (F.col("block") * blocks + F.col("reached")).cast("int")).sortWithinPartitions("block", "reached", "via", "outgoing")
    counts = ordered.mapInArrow(lambda batches: _reached(batches, size), "team long, reached long")
    totals = counts.groupBy("team").agg(F.sum("reached").alias("network_teams"))
    return totals.join(numbers, totals["team"] == numbers["number"]).select(F.col("id").alias("team_id_master"), "network_teams")


def _reached(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(team, reached) per cell of rows in order of cell, ``via`` and side: who came by a team, then whom that team has met."""
    cell, via, came, bits = None, None, None, None

    def counted() -> pa.RecordBatch:
        found = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        teams = np.flatnonzero(found)
        return pa.RecordBatch.from_arrays([pa.array(teams + cell[0] * size), pa.array(found[teams])], names=["team", "reached"])

    for batch in batches:
        places = batch.column("places")
        values, ends = places.values.to_numpy(zero_copy_only=False), places.offsets.to_numpy()
        columns = (batch.column(c).to_pylist() for c in ("block", "reached", "via", "outgoing"))
        for row, (block, reached, team, outgoing) in enumerate(zip(*columns, strict=True)):
            if cell != (block, reached):
                if cell is not None:
                    yield counted()
                cell, via, bits = (block, reached), None, np.zeros((size, (size + 63) // 64), np.uint64)
            at = values[ends[row]:ends[row + 1]]
            if not outgoing:
                via, came = team, at
            elif via == team:
                met = np.zeros(bits.shape[1] * 64, np.uint8)
                met[at] = 1
                bits[came] |= np.packbits(met).view(np.uint64)
    if cell is not None:
        yield counted()


def head_to_head(games: DataFrame, first: str, second: str) -> DataFrame:
    """Totals of two teams side by side (one row each)."""
    return team_record(games.where(F.col("team_id_master").isin(first, second)), ("team_id_master",))


def alias_resolution(games: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per distinct opponent id: what it resolves to, whether an alias was found, games as a team."""
    met = games.select("opponent_id_master").where("opponent_id_master IS NOT NULL").distinct().withColumn(
        "canonical", canonical_id(F.col("opponent_id_master"))
    )
    pairs = aliases.select(F.col("alias_id").alias("canonical"), F.col("canonical_id").alias("alias_target"))
    as_team = games.groupBy(F.col("team_id_master").alias("resolved_id")).agg(F.count("*").alias("games_as_team"))
    resolved = met.join(pairs, "canonical", "left").withColumn(
        "resolved_id", F.coalesce("alias_target", "canonical")
    )
    return resolved.join(as_team, "resolved_id", "left").select(
        "opponent_id_master", "resolved_id", F.col("alias_target").isNotNull().alias("alias_found"),
        F.coalesce("games_as_team", F.lit(0)).alias("games_as_team"),
    )


# ---------------------------------------------------------------- rankings

def score_distribution(ranking: DataFrame, cols: Sequence[str], decimals: int = 6) -> DataFrame:
    """(metric, statistics) for each score column: range, spread, distinct values, share at the top."""
    longer = ranking.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in cols
    ])).alias("p")).select("p.*")
    # Counting per rounded value first keeps every aggregate partial.
    values = longer.groupBy("metric", F.round("value", decimals).alias("value")).agg(F.count("*").alias("n"))
    shape = longer.groupBy("metric").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.count("*").alias("teams"),
    )
    kinds = values.groupBy("metric").agg(
        F.count("*").alias("distinct_values"), F.max_by("n", "value").alias("at_max")
    )
    return shape.join(kinds, "metric").withColumn("share_at_max", F.col("at_max") / F.col("teams"))


def score_percentiles(ranking: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """(prob, value) of one score column."""
    found = exact_quantiles(stage(ranking.select(col), "scores"), [], [col], probs)
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col(f"{col}_q").alias("value"))
    return found.select(F.explode(pairs).alias("z")).select(
        F.col("z").getField("prob").alias("prob"), F.col("z").getField("value").alias("value")
    )


def score_by_state(ranking: DataFrame, col: str = "powerscore_adj") -> DataFrame:
    return ranking.groupBy("state").agg(
        F.count("*").alias("teams"), F.min(col).alias("min_score"), F.max(col).alias("max_score"),
        F.avg(col).alias("mean_score"),
    ).orderBy(F.desc("max_score"), "state")


def contributions(ranking: DataFrame, config: RatingConfig = BASELINE) -> DataFrame:
    """Weight times component for each team, and their sum."""
    parts = {
        "off_part": config.off_weight * F.col("sao_norm"), "def_part": config.def_weight * F.col("sad_norm"),
        "sos_part": config.sos_weight * F.col("sos_norm"),
    }
    return ranking.select("team_id_master", "rank", *[c.alias(n) for n, c in parts.items()]).withColumn(
        "total", F.col("off_part") + F.col("def_part") + F.col("sos_part")
    )


def standing(ranking: DataFrame, col: str = "powerscore_adj") -> DataFrame:
    """Percentile from the rank, the 90/95/99 % thresholds reached, and the gap to the next team."""
    staged = stage(ranking.select("team_id_master", "rank", col), "standing")
    n = staged.agg(F.count("*")).scalar()
    q = exact_quantiles(staged, [], [col], [0.90, 0.95, 0.99]).select(f"{col}_q").scalar()
    following = staged.select((F.col("rank") - 1).alias("rank"), F.col(col).alias("_next"))
    tier = (
        F.when(F.col(col) >= q[2], "top1").when(F.col(col) >= q[1], "top5").when(F.col(col) >= q[0], "top10")
        .otherwise("rest")
    )
    return staged.join(following, "rank", "left").select(
        "team_id_master", "rank", ((1 - F.col("rank") / n) * 100).alias("percentile"), tier.alias("tier"),
        (F.col(col) - F.col("_next")).alias("gap_to_next"),
    )


def state_rank_check(view: DataFrame) -> DataFrame:
    """Per state: whether its ranks merely copy the national ones, and whether they run from 1 to n."""
    n = F.count("*")
    return view.groupBy("state").agg(
        n.alias("teams"), F.min(F.col("rank_state") == F.col("rank_national")).alias("is_copy"),
        ((F.min("rank_state") == 1) & (F.max("rank_state") == n) & (F.countDistinct("rank_state") == n)).alias("is_dense"),
    )


def game_log(games: DataFrame, team_id: str) -> DataFrame:
    """Every game of one team, newest first."""
    return games.where(F.col("team_id_master") == team_id).select(
        "date", "opponent", "gf", "ga", (F.col("gf") - F.col("ga")).alias("goal_diff"), "result"
    ).orderBy(F.desc("date"), "opponent", "gf", "ga")
