"""Exact positions and quantiles of ordered data without one task holding a group.

A window over the whole frame, or over one hot group, sorts everything in a
single task. These operators sort by range instead: rows are range-partitioned
on (group, order), numbered inside their partition, and shifted by the totals
of the partitions before. Only one total per partition reaches a window, and
there is one path for every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.joins import join_on
from rankloom.storage import stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _in_order(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Staged rows with ``_pid`` and ``_row``: partition and place in it under (group, order)."""
    keys = [F.col(c) for c in group_cols]
    numbered = stage(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_mid", F.monotonically_increasing_id()),
        "positions",
    )
    pid = F.shiftright("_mid", _ROW_BITS)
    return numbered.withColumn("_pid", pid).withColumn("_row", F.col("_mid") - F.shiftleft(pid, _ROW_BITS)).drop("_mid")


def _totals_before(rows: DataFrame, total: Column) -> DataFrame:
    """(_pid, _offset): sum of ``total`` over the partitions before; one row per partition."""
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy("_pid").agg(total.alias("_n")).select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def global_positions(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Add ``name``: 1-based position of each row in its group under ``order``.

    ``order`` must be a total order inside a group for the result to be unique.
    """
    rows = _in_order(df, group_cols, order)
    placed = rows.join(F.broadcast(_totals_before(rows, F.count("*"))), "_pid").withColumn(
        name, F.col("_row") + F.col("_offset") + 1)
    if group_cols:
        starts = stage(placed.groupBy(*group_cols).agg(F.min(name).alias("_start")), "group_starts")
        placed = join_on(placed, starts, group_cols).withColumn(name, F.col(name) - F.col("_start") + 1)
    return placed.select(*df.columns, name)


def ranked(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Row number per group under a total order."""
    return global_positions(df, group_cols, order, name)


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str], probs: Sequence[float],
                    times: str | None = None) -> DataFrame:
    """Linear-interpolated quantiles: one row per group, ``<col>_q`` array per value column.

    Equal values are counted first, so a tie is one row whatever its size; the
    values around each quantile are those at which the running count passes its
    place. A missing key is a group, and a group without values has a null array.
    ``times`` names a column that says how often a row counts.
    """
    groups = list(group_cols)
    values = F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in value_cols])
    often = F.col(times) if times else F.lit(1)
    counts = df.select(*groups, often.cast("long").alias("_t"), F.explode(values).alias("_p")).select(*groups, "_t", "_p._col", "_p._v").groupBy(
        *groups, "_col", "_v").agg(F.sum("_t").alias("_n"))
    key = [*groups, "_col"]
    rows = _in_order(counts.where(F.col("_v").isNotNull()), key, [F.col("_v")])
    inside = Window.partitionBy("_pid").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.join(F.broadcast(_totals_before(rows, F.sum("_n"))), "_pid").withColumn(
        "_to", F.sum("_n").over(inside) + F.col("_offset"))
    sizes = stage(running.groupBy(*key).agg(F.sum("_n").alias("_size"), F.max("_to").alias("_end")), "quantile_sizes")
    placed = join_on(running, sizes, key).withColumn("_to", F.col("_to") - F.col("_end") + F.col("_size"))
    picks = []
    for i, p in enumerate(probs):
        at = (F.col("_size") - 1) * F.lit(float(p)) + 1
        low, high = (F.min(F.when(F.col("_to") >= f(at), F.col("_v"))) for f in (F.floor, F.ceil))
        share = F.max(at - F.floor(at))
        picks.append((low * (1 - share) + high * share).alias(f"_q{i}"))
    found = placed.groupBy(*key).agg(*picks).select(*key, F.array(*[f"_q{i}" for i in range(len(probs))]).alias("_q"))
    wide = found.groupBy(*groups).agg(*[F.max(F.when(F.col("_col") == c, F.col("_q"))).alias(f"{c}_q") for c in value_cols])
    return join_on(df.select(*groups).distinct(), wide, groups, "left") if groups else wide
