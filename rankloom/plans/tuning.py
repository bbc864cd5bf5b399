"""Comparing ratings under different parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.config import RatingConfig, scenarios
from rankloom.functions.joins import join_on
from rankloom.operators.ordering import exact_quantiles, ranked
from rankloom.plans.ranking import TEAM, rank_teams, run_spec
from rankloom.storage import stage

ALIGN = ("state", "gender", "age_group", TEAM)
BLOCK_ROWS = 100_000  # rows one task sorts when inversions are counted
MAX_BLOCKS = 1024  # side of the block grid


def sweep(
    games: DataFrame, as_of: str, configs: Mapping[str, RatingConfig] | None = None,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Rankings of all scenarios from one job, keyed by ``scenario``."""
    return rank_teams(games, run_spec(as_of, configs or scenarios()), aliases)


def align(base: DataFrame, test: DataFrame, cols: Sequence[str] = ("rank",), test_keys: Sequence[str] = ()) -> DataFrame:
    """Teams in both rankings with ``<col>_base`` and ``<col>_test``; ``test_keys`` (scenario) are kept.

    A missing state, gender or age group equals a missing one.
    """
    left = base.select(*ALIGN, *[F.col(c).alias(f"{c}_base") for c in cols])
    right = test.select(*test_keys, *ALIGN, *[F.col(c).alias(f"{c}_test") for c in cols])
    return join_on(right, left, ALIGN)


def aligned_sweep(rankings: DataFrame, baseline: str = "baseline", cols: Sequence[str] = ("rank",)) -> DataFrame:
    """Every scenario against the baseline, baseline included."""
    return align(rankings.where(F.col("scenario") == baseline), rankings, cols, ("scenario",))


def reranked(pairs: DataFrame, keys: Sequence[str] = ("scenario",)) -> DataFrame:
    """Ranks renumbered 1..n among the teams both sides share (ranks are unique)."""
    first = stage(ranked(pairs, list(keys), [F.col("rank_base")], "r_base"), "rerank_base")
    return ranked(first, list(keys), [F.col("rank_test")], "r_test")


def spearman(pairs: DataFrame, keys: Sequence[str] = ("scenario",)) -> DataFrame:
    return pairs.groupBy(*keys).agg(F.corr("r_base", "r_test").alias("spearman"))


def _inversions(values: np.ndarray) -> int:
    """Pairs in the wrong order: inside short runs by comparing shifted copies, then by merging runs of doubling width."""
    values = np.asarray(values)
    n, width, count = len(values), 32, 0
    padded = np.append(values, np.full(-n % width, np.iinfo(values.dtype).max, values.dtype)).reshape(-1, width)
    for shift in range(1, width):
        count += int((padded[:, shift:] < padded[:, :-shift]).sum())
    values = np.sort(padded, axis=1).ravel()[:n].copy()
    while width < n:
        for start in range(0, n, 2 * width):
            left, right = values[start:start + width], values[start + width:start + 2 * width]
            if len(right):
                count += int((len(left) - np.searchsorted(left, right, side="right")).sum())
                values[start:start + len(left) + len(right)] = np.sort(
                    np.concatenate([left, right]), kind="stable")
        width *= 2
    return count


def kendall(pairs: DataFrame, keys: Sequence[str] = ("scenario",), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Kendall's tau of ``r_base`` and ``r_test`` (both 1..n without ties) per key.

    Tau needs the number of discordant pairs. No pair is ever built: both ranks
    are cut into blocks. Pairs in one test-rank block are counted by a merge in
    one task per block, pairs of one base-rank block but different test blocks
    likewise, and all others from the grid of block counts.
    ``pairs`` should be staged.
    """
    keys = list(keys)
    biggest = pairs.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    size = max(block_rows, -(-biggest // MAX_BLOCKS))
    blocked = pairs.select(
        *keys, "r_base", "r_test",
        F.floor((F.col("r_base") - 1) / size).cast("long").alias("b_base"),
        F.floor((F.col("r_test") - 1) / size).cast("long").alias("b_test"),
    )
    key_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema if f.name in keys)
    head = f"{key_types}, " if keys else ""

    def within(value: str):
        def count(pdf: pd.DataFrame) -> pd.DataFrame:
            ordered = pdf.sort_values("r_base")[value].to_numpy(dtype="int64", copy=True)
            return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, "bad": [_inversions(ordered)]})
        return count

    same_test = blocked.groupBy(*keys, "b_test").applyInPandas(within("r_test"), f"{head}bad long")
    same_base = blocked.groupBy(*keys, "b_base").applyInPandas(within("b_test"), f"{head}bad long")
    cells = blocked.groupBy(*keys, "b_base", "b_test").agg(F.count("*").alias("n"))

    def grid(pdf: pd.DataFrame) -> pd.DataFrame:
        # At most MAX_BLOCKS squared cells, whatever the number of teams.
        table = np.zeros((int(pdf["b_base"].max()) + 1, int(pdf["b_test"].max()) + 1), dtype="int64")
        table[pdf["b_base"].to_numpy(), pdf["b_test"].to_numpy()] = pdf["n"].to_numpy()
        earlier = np.cumsum(table, axis=0) - table
        above = earlier[:, ::-1].cumsum(axis=1)[:, ::-1] - earlier
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, "bad": [int((table * above).sum())]})

    across = cells.groupBy(*keys).applyInPandas(grid, f"{head}bad long")
    bad = same_test.unionByName(same_base).unionByName(across).groupBy(*keys).agg(F.sum("bad").alias("bad"))
    totals = pairs.groupBy(*keys).agg(F.count("*").alias("n"))
    all_pairs = F.col("n") * (F.col("n") - 1) / 2
    return join_on(totals, bad, keys).select(*keys, (1 - 2 * F.col("bad") / F.nullif(all_pairs, F.lit(0))).alias("kendall"))


def overlaps(pairs: DataFrame, keys: Sequence[str] = ("scenario",), ks: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """Share of the base top k that is also in the test top k; k is at most the number of teams."""
    found = pairs.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        *[F.count_if((F.col("r_base") <= k) & (F.col("r_test") <= k)).alias(f"_both{k}") for k in ks],
    )
    return found.select(
        *keys, *[(F.col(f"_both{k}") / F.least(F.lit(k), F.col("_n"))).alias(f"top{k}_overlap") for k in ks]
    )


def rank_deltas(pairs: DataFrame, keys: Sequence[str] = ("scenario",)) -> DataFrame:
    """Median, 90 % and largest absolute rank change, and the number of teams. ``pairs`` should be staged."""
    keys = list(keys)
    change = pairs.withColumn("delta", F.abs(F.col("rank_test") - F.col("rank_base")).cast("double"))
    quantiles = exact_quantiles(change, keys, ["delta"], [0.5, 0.9])
    extremes = change.groupBy(*keys).agg(F.max("delta").alias("max_rank_delta"), F.count("*").alias("teams_compared"))
    return join_on(extremes, quantiles, keys).select(
        *keys, F.col("delta_q")[0].alias("median_rank_delta"), F.col("delta_q")[1].alias("p90_rank_delta"),
        "max_rank_delta", "teams_compared",
    )


def delta_report(rankings: DataFrame, baseline: str = "baseline") -> DataFrame:
    """Per scenario and team: both ranks and scores and their differences."""
    pairs = aligned_sweep(rankings, baseline, ("rank", "team", "powerscore_adj"))
    diff: Column = F.col("rank_test") - F.col("rank_base")
    return pairs.withColumns({
        "rank_delta": diff, "abs_rank_delta": F.abs(diff),
        "powerscore_delta": F.col("powerscore_adj_test") - F.col("powerscore_adj_base"),
    })


METRIC_NAMES = ("spearman", "kendall", "top5_overlap", "top10_overlap", "top20_overlap", "median_rank_delta",
                "p90_rank_delta", "max_rank_delta", "teams_compared")


def compare_sweep(rankings: DataFrame, baseline: str = "baseline") -> DataFrame:
    """All comparison metrics, one row per scenario; scenarios sharing no team get zeros."""
    names = rankings.select("scenario").distinct()
    pairs = stage(aligned_sweep(rankings, baseline), "aligned")
    renumbered = stage(reranked(pairs), "reranked")
    keys = ["scenario"]
    result = names
    for part in (spearman(renumbered), kendall(renumbered), overlaps(renumbered), rank_deltas(pairs)):
        result = join_on(result, part, keys, "left")
    return result.select("scenario", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in METRIC_NAMES])


def compare_rankings(base: DataFrame, test: DataFrame) -> DataFrame:
    """The same metrics for two rankings, one row; zeros when they share no team."""
    tagged = base.withColumn("scenario", F.lit("base")).unionByName(
        test.withColumn("scenario", F.lit("test")), allowMissingColumns=True
    )
    found = compare_sweep(tagged, "base").where("scenario = 'test'").drop("scenario")
    # An empty test ranking has no scenario row: aggregate over nothing still gives one row.
    return found.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in METRIC_NAMES])


