"""Joins on key columns where a missing key equals a missing key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``; rows meet when all keys are equal or both missing.

    ``how`` is inner or left. Without keys ``right`` must have one row.
    """
    keys = list(keys)
    if not keys:
        return left.join(F.broadcast(right), F.lit(True), how)
    named = right.select(*[F.col(k).alias(f"_same_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys])
    return left.join(named, same, how).drop(*[f"_same_{k}" for k in keys])
