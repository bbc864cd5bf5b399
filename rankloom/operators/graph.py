"""Opponent graph: edges, schedule strength, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.ordering import exact_quantiles
from rankloom.storage import stage

DAMPING = 0.85
#: Edges that a task joins at a time.
EDGES = 1_000_000


def opponent_edges(games: DataFrame) -> DataFrame:
    """One edge of weight 1 per game with both ids; repeats are kept."""
    return games.select(
        F.col("team_id_master").alias("team"), F.col("opponent_id_master").alias("opponent"),
        F.lit(1.0).alias("weight"),
    ).dropna(subset=["team", "opponent"])


def goal_strength(games: DataFrame) -> DataFrame:
    """Mean goal difference plus two, not below zero."""
    return games.groupBy(F.col("team_id_master").alias("team")).agg(
        F.greatest(F.lit(0.0), F.avg(F.col("gf") - F.col("ga")) + 2.0).alias("strength")
    )


def baseline_schedule(games: DataFrame, strengths: DataFrame) -> DataFrame:
    """Median opponent strength over the games a team is in, on either side.

    A game against oneself counts once. Teams without a known opponent get the
    median of all strengths. ``strengths`` should be staged.
    """
    # A pair is one row with its number of games, however often it played.
    one_way = games.select(
        F.col("team_id_master").alias("team"), F.col("opponent_id_master").alias("opponent")
    ).dropna().groupBy("team", "opponent").agg(F.count("*").alias("games"))
    one_way = stage(one_way, "one_way")
    other_way = one_way.where("team <> opponent").select(
        F.col("opponent").alias("team"), F.col("team").alias("opponent"), "games"
    )
    known = strengths.select(F.col("team").alias("opponent"), F.col("strength").alias("opp_strength"))
    met = stage(
        one_way.unionByName(other_way).join(known, "opponent")
        .join(strengths.select("team"), "team", "left_semi").select("team", "opp_strength", "games"),
        "met",
    )
    medians = exact_quantiles(met, ["team"], ["opp_strength"], [0.5], "games")
    league = exact_quantiles(strengths, [], ["strength"], [0.5]).select(F.col("strength_q")[0]).scalar()
    return strengths.join(medians, "team", "left").select(
        "team", F.coalesce(F.col("opp_strength_q")[0], league).alias("baseline_sos")
    )


def iterative_schedule(strengths: DataFrame, edges: DataFrame, max_rounds: int = 3, tolerance: float = 1e-4) -> DataFrame:
    """Repeat: new = 0.85 * weighted mean of known opponents + 0.15 * own, all teams at once.

    Parallel edges are summed first, so a pair is one row however often it
    played. Stops when nothing moves by ``tolerance`` or more.
    """
    pairs = stage(edges.groupBy("team", "opponent").agg(F.sum("weight").alias("weight")), "pairs")
    current = stage(strengths.select("team", "strength"), "strength")
    for _ in range(max_rounds):
        opponents = current.select(F.col("team").alias("opponent"), F.col("strength").alias("opp_strength"))
        means = (
            pairs.join(opponents, "opponent").groupBy("team")
            .agg((F.sum(F.col("weight") * F.col("opp_strength")) / F.sum("weight")).alias("mean"))
        )
        moved = stage(
            current.join(means, "team", "left").select(
                "team",
                F.coalesce(DAMPING * F.col("mean") + (1 - DAMPING) * F.col("strength"), F.col("strength")).alias("strength"),
                F.col("strength").alias("before"),
            ),
            "round",
        )
        change = moved.agg(F.max(F.abs(F.col("strength") - F.col("before")))).first()[0]
        current = moved.select("team", "strength")
        if change is None or change < tolerance:
            break
    return current


def combined_schedule(iterative: DataFrame, baseline: DataFrame) -> DataFrame:
    """Iterative value where there is one, else the baseline."""
    return baseline.join(iterative, "team", "full").select(
        "team", F.coalesce("strength", "baseline_sos").alias("sos")
    )


def undirected(games: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of teams that met; self games are kept apart in ``connectivity``."""
    both = games.dropna(subset=["team_id_master", "opponent_id_master"])
    return both.select(
        F.least("team_id_master", "opponent_id_master").alias("a"),
        F.greatest("team_id_master", "opponent_id_master").alias("b"),
    ).distinct()


def settled_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest number joined to each of ``n`` numbers by the edges (a, b): roots hook to smaller roots, then paths are halved."""
    label = np.arange(n)
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if np.array_equal(low, high):
            return label
        np.minimum.at(label, high, low)
        while not np.array_equal(label, label[label]):
            label = label[label]


def forest(pairs: DataFrame) -> DataFrame:
    """(node, low): the edges (a, b) of each task joined within it, so that a task sends at most one edge per node.

    A task joins ``EDGES`` edges at a time and carries the forest of what it has seen along while that is small.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def join() -> pa.Table:
            edges = pa.concat_tables(held)
            both = pa.chunked_array(edges.column("node").chunks + edges.column("low").chunks).combine_chunks()
            names = pc.unique(both)
            names = names.take(pc.sort_indices(names))  # numbers in the order of the names: the smallest number is the smallest name
            number = pc.index_in(both, names).to_numpy()
            label = settled_labels(number[:edges.num_rows], number[edges.num_rows:], len(names))
            inner = np.flatnonzero(label != np.arange(len(names)))
            return pa.table([names.take(pa.array(inner)), names.take(pa.array(label[inner]))], names=["node", "low"])

        for batch in batches:
            held.append(pa.table([batch.column("b"), batch.column("a")], names=["node", "low"]))
            if sum(t.num_rows for t in held) > EDGES:
                joined = join()
                held = [joined]
                if joined.num_rows > EDGES // 2:
                    yield from joined.to_batches()
                    held = []
        if held:
            yield from join().to_batches()

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.select("a", "b").mapInArrow(run, f"node {kind}, low {kind}")


def components(pairs: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node id reachable from each node: (node, component_id).

    ``pairs`` holds distinct (a, b), a <= b. Edges are joined within each task first, before anything is shuffled. Then
    two steps alternate until the edges settle: hang the larger neighbours of a node on its smallest one, then
    the smaller ones. The number of rounds grows with the logarithm of the
    size, not with the diameter, and each step only sends one minimum per node.
    """
    loops = pairs.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component_id"))
    # Each edge points from a node to a smaller one.
    links = stage(forest(pairs.where("a < b")), "links")
    seen = None
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("low").alias("node"), F.col("node").alias("low")))
        # Minima are staged before the joins: only then can the edges of a hot node be split.
        lowest = stage(both.groupBy("node").agg(F.min("low").alias("_m")).select(
            "node", F.least("node", "_m").alias("lowest")
        ), "lowest")
        wide = (
            both.where("low > node").join(lowest, "node")
            .select(F.col("low").alias("node"), F.col("lowest").alias("low")).distinct()
        )
        wide = stage(wide.where("node <> low"), "wide")
        floor = stage(wide.groupBy("node").agg(F.min("low").alias("lowest")), "floor")
        narrow = (
            wide.join(floor, "node").where("low <> lowest")
            .select(F.col("low").alias("node"), F.col("lowest").alias("low"))
            .unionByName(floor.select("node", F.col("lowest").alias("low")))
            .distinct()
        )
        links = stage(narrow, "links")
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("node", "low").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError("components did not settle")
    members = links.select("node", F.col("low").alias("component_id"))
    roots = links.select(F.col("low").alias("node"), F.col("low").alias("component_id"))
    return members.unionByName(roots).unionByName(loops).groupBy("node").agg(
        F.min("component_id").alias("component_id")
    )


def connectivity(games: DataFrame) -> DataFrame:
    """(node, component_id, component_size, degree) for every id that appears in a game.

    Degree counts distinct opponents; meeting oneself counts twice. Teams whose
    games all lack an opponent stand alone with degree 0.
    """
    pairs = stage(undirected(games), "undirected")
    found = stage(components(pairs), "components")
    sizes = found.groupBy("component_id").agg(F.count("*").alias("component_size"))
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count("*").alias("degree"))
    alone = (
        games.select(F.col("team_id_master").alias("node")).dropna().distinct()
        .join(found, "node", "left_anti")
        .select("node", F.col("node").alias("component_id"), F.lit(1).cast("long").alias("component_size"),
                F.lit(0).cast("long").alias("degree"))
    )
    return (
        found.join(sizes, "component_id").join(degree, "node")
        .select("node", "component_id", "component_size", "degree")
        .unionByName(alone)
    )


def connectivity_report(teams: DataFrame, small: int = 50) -> DataFrame:
    """One row: teams, smallest and largest component, teams in small components."""
    return teams.agg(
        F.count("*").alias("total_teams"), F.min("component_size").alias("min_component"),
        F.max("component_size").alias("max_component"),
        F.count_if(F.col("component_size") < small).alias("low_connectivity"),
    )
