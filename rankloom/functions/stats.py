"""Column expressions for the rating layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.least(F.greatest(x, low), high)


def capped_goal_diff(gf: Column, ga: Column, cap: Column | float) -> Column:
    """Goal difference held to the cap, then to seven either way."""
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    return clip(clip((gf - ga).cast("double"), -cap, cap), -7.0, 7.0)


def logistic(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def sigma_clip(x: Column, mean: Column, std: Column, z: Column | float) -> Column:
    """Hold ``x`` within z deviations; unchanged where the deviation is null or 0."""
    z = z if isinstance(z, Column) else F.lit(z)
    return F.when(std > 0, clip(x, mean - z * std, mean + z * std)).otherwise(x)


def taper(
    index: Column, n: Column, recent_k: Column, recent_share: Column, tail_start: Column, tail_end: Column,
    start_weight: Column, end_weight: Column, fill_short: Column,
) -> Column:
    """Unscaled recency weight of game ``index`` (0 = newest) out of ``n``.

    The newest ``recent_k`` games share ``recent_share``, the others the rest.
    With fewer than ``recent_k`` games nobody gets weight unless ``fill_short``.
    A long enough history has its tail thinned along a straight line.
    """
    steps = F.greatest(tail_end - tail_start - 1, F.lit(1))
    fade = start_weight + (end_weight - start_weight) * (index - tail_start) / steps
    thinned = (
        (tail_start < n) & (tail_end <= n) & (tail_end - tail_start > 1)
        & (index >= tail_start) & (index < tail_end)
    )
    share = (
        F.when(n < recent_k, F.when(fill_short, 1.0 / n).otherwise(0.0))
        .when(index < recent_k, recent_share / recent_k)
        .otherwise((1.0 - recent_share) / (n - recent_k))
    )
    return F.when(thinned, share * fade).otherwise(share)


def adaptive_k(gap: Column, games: Column, alpha: Column, beta: Column) -> Column:
    return (1.0 + alpha * F.abs(gap)) / (1.0 + beta * F.log(F.greatest(games, F.lit(1)).cast("double")))


def performance_factor(delta: Column, k: Column, decay: Column, index: Column, threshold: Column) -> Column:
    return F.when(F.abs(delta) < threshold, 1.0).otherwise(
        (1.0 + k * F.signum(delta)) * F.exp(-decay * index)
    )


def shrunk(value: Column, n: Column, prior: Column, tau: Column) -> Column:
    """Pull ``value`` towards ``prior``; no games at all gives the prior."""
    return F.when(n == 0, prior).otherwise((n * value + tau * prior) / (n + tau))
