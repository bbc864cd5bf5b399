"""Writers. Partitioned output is rebalanced first, so one large slice is split over several files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rankloom.plans.ranking import run_summary, state_view
from rankloom.sources.files import list_paths

SLICE = ("state", "gender", "age_group")
#: Folder value of a missing partition key.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], fmt: str = "parquet", mode: str = "errorifexists",
                      measures: Sequence[Column] = (), compression: str = "none") -> dict[str, object]:
    """One folder per value of ``cols``; the rebalance hint lets large ones spread and small ones merge.

    Text formats are written plain unless ``compression`` names a codec; readers tell by the file name.
    ``measures`` are gathered while the rows are written, behind the shuffle, where a lost task is counted once.
    """
    rows, seen = df.hint("rebalance", *cols), Observation(f"written-{uuid.uuid4().hex}")
    if measures:
        rows = rows.observe(seen, *measures)
    writer = rows.write.mode(mode).partitionBy(*cols)
    if fmt == "csv":
        writer.option("header", True).option("compression", compression).csv(path)
    else:
        writer.format(fmt).save(path)
    return seen.get if measures else {}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_normalized(games: DataFrame, root: str, version: str, csv: bool = True) -> DataFrame:
    """Normalized games as a partitioned table (and CSV); returns their statistics in one row.

    Counts, dates and missing values are gathered while writing, the numbers of states, genders and age groups are those
    of the folders written. Only the number of teams is counted from the table, one column of it, when it is asked for.
    """
    spark, path = games.sparkSession, f"{root}/version={version}"
    listed = [c for c in games.columns if c not in SLICE and c != "date"]
    seen = write_partitioned(games, path, SLICE, measures=[
        F.count("*").alias("games"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in listed]])
    written = spark.read.schema(games.schema).parquet(path)
    if csv:
        write_csv(written, f"{root}_csv/version={version}")
    folders = [dict(p.split("=", 1) for p in f.rstrip("/").split("/")[-len(SLICE):]) for f in list_paths(
        spark, f"{path}/" + "/".join(f"{c}=*" for c in SLICE))]
    values = {f"{c}s": len({f[c] for f in folders} - {NO_VALUE}) for c in SLICE}
    share = {f"missing_{c}": seen[f"missing_{c}"] / seen["games"] if seen["games"] else 0.0 for c in listed}
    known = {"games": "long", "first_date": "date", "last_date": "date"}
    return written.agg(F.countDistinct("team_id_master").alias("teams")).select(
        F.lit(seen["games"]).cast("long").alias("games"), "teams", *[F.lit(seen[c]).cast(known[c]).alias(c) for c in list(known)[1:]],
        *[F.lit(n).cast("long").alias(c) for c, n in values.items()], *[F.lit(n).alias(c) for c, n in share.items()])


def write_master(master: DataFrame, root: str, build_id: str) -> None:
    """The national snapshot and one folder per state."""
    write_csv(master, f"{root}/national/build={build_id}")
    write_partitioned(master, f"{root}/states/build={build_id}", ["state"], "csv")


def write_slices(slices: DataFrame, path: str) -> None:
    """All master slices in one pass."""
    write_partitioned(slices, path, SLICE, "csv")


def write_ranking(ranking: DataFrame, root: str) -> None:
    """Ranking, state views with ``rank_state``, connectivity columns and a summary."""
    ranking.write.parquet(f"{root}/ranking")
    stored = ranking.sparkSession.read.parquet(f"{root}/ranking")
    write_partitioned(state_view(stored), f"{root}/states", ["state"], "csv")
    write_csv(stored.select("scenario", "team_id_master", "component_id", "component_size", "degree"), f"{root}/connectivity")
    run_summary(stored).write.json(f"{root}/summary")


def write_unlinked(linked: DataFrame, path: str) -> DataFrame:
    """Games that found no team, kept apart."""
    rows = linked.where(F.col("link_status") == "unlinked")
    rows.write.parquet(path)
    return linked.sparkSession.read.parquet(path)


def write_deltas(deltas: Mapping[str, DataFrame], root: str) -> list[str]:
    """Each non-empty kind of change under ``change_type=<kind>``; returns the kinds written."""
    written = []
    for kind, rows in deltas.items():
        if not rows.isEmpty():
            write_csv(rows, f"{root}/change_type={kind}")
            written.append(kind)
    return written


def read_deltas(spark: SparkSession, root: str, kinds: Sequence[str], schema: str) -> DataFrame:
    """Changes of the kinds that were written, with ``change_type``; without any an empty table."""
    if not kinds:
        return spark.createDataFrame([], f"{schema}, change_type string")
    return spark.read.schema(schema).option("header", True).option("basePath", root).csv([f"{root}/change_type={k}" for k in kinds])


def count_deltas(changes: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """(change_type, teams) for every kind, 0 where nothing changed."""
    counts = changes.groupBy("change_type").agg(F.count("*").alias("teams"))
    named = changes.sparkSession.createDataFrame([(k,) for k in kinds], "change_type string")
    return named.join(counts, "change_type", "left").select("change_type", F.coalesce("teams", F.lit(0)).alias("teams"))


def write_new_teams(rows: DataFrame, root: str, build_id: str) -> bool:
    """New teams of a build; nothing is written when there are none."""
    if rows.isEmpty():
        return False
    write_csv(rows, f"{root}/build={build_id}")
    return True


def write_slice_summaries(summaries: DataFrame, path: str) -> None:
    summaries.write.partitionBy("build_id").json(path)


def export_history(entries: DataFrame, path: str) -> None:
    """Build history as CSV; lists become text."""
    flat = entries.select(*[
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else F.col(f.name)
        for f in entries.schema
    ])
    write_csv(flat, path)
