"""Keyed streaming state: what is known per team lives in the state store and changes with the keys a batch touches.

A job keeps its offsets and its state under one checkpoint folder. State is read back from there as a table (the
``statestore`` source), so no batch rewrites what it did not touch, and a batch that was killed starts again from the
state it started from. RocksDB keeps the state on disk and uploads only the changes of a batch.

A run is all that is available when a job is started. It is finished by a marker beside the offsets; a job that is
started again before its run was finished continues that run. High-water marks are pinned per run: games are judged by
the mark as it stood when the team was first touched by the run, so neither the cut into batches nor a killed batch
changes the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rankloom.functions import ids
from rankloom.functions.strings import strip
from rankloom.sources.files import list_paths

STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
DAY_MS, EPOCH = 86_400_000, date(1970, 1, 1)


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The session's state store settings for the queries started inside."""
    before = {key: spark.conf.get(key, None) for key in STORE}
    try:
        for key, value in STORE.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def run_number(spark: SparkSession, folder: str) -> int:
    """Finished runs of a job so far."""
    return len(list_paths(spark, f"{folder}/runs/*/_SUCCESS"))


def finish_run(spark: SparkSession, folder: str, run: int) -> None:
    spark.range(1).write.mode("overwrite").parquet(f"{folder}/runs/{run}")


def read_state(spark: SparkSession, folder: str, variable: str, schema: str) -> DataFrame:
    """(key columns, value columns) of a state variable, or an empty table of ``schema`` before the first batch."""
    if not list_paths(spark, f"{folder}/offsets/commits/*"):
        return spark.createDataFrame([], schema)
    rows = spark.read.format("statestore").option("path", f"{folder}/offsets").option("stateVarName", variable).load()
    parts = [c for c in ("key", "user_map_key", "value", "user_map_value") if c in rows.columns]
    return rows.select(*[f"{c}.*" for c in parts]).select(*[f.split()[0] for f in schema.split(", ")])


def run_stateful(stream: DataFrame, processor: StatefulProcessor, key: str, output: str, folder: str, time_mode: str = "None") -> None:
    """Process all that is available; rows that the processor gives go to ``<folder>/out``, once each."""
    spark = stream.sparkSession
    with state_store(spark):
        found = stream.groupBy(key).transformWithState(
            processor, outputStructType=output, outputMode="Append", timeMode=time_mode)
        found.writeStream.format("parquet").option("checkpointLocation", f"{folder}/offsets").option(
            "path", f"{folder}/out").outputMode("append").trigger(availableNow=True).start().awaitTermination()


def given(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows that processors of a job gave so far."""
    written = list_paths(spark, f"{folder}/out/_spark_metadata/*")
    return spark.read.schema(schema).parquet(f"{folder}/out") if written else spark.createDataFrame([], schema)


# ---------------------------------------------------------------- high-water marks

MARK = "run bigint, pinned date, last_scraped date, games_scraped bigint"
PROGRESS = "team_id_master string, last_scraped date, games_scraped bigint"


class Marks(StatefulProcessor):
    """A team's high-water mark: newest accepted date, number of accepted games, and the mark its run began with.

    A team that is so far behind the watermark that its mark cannot turn a game away any more is given out and forgotten.
    """

    def __init__(self, run: int, keep_days: int | None) -> None:
        self.run, self.keep_days = run, keep_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", MARK)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = self.mark.get()
        before = tuple(found) if found else (-1, None, None, 0)
        run, pinned, last, games = before
        if run < self.run:
            run, pinned = self.run, last
        dates = [r["date"] for r in rows if r["accepted"] and (pinned is None or r["date"] >= pinned)]
        if dates:
            last, games = max(dates) if last is None else max(last, max(dates)), games + len(dates)
        if (found or dates) and (run, pinned, last, games) != before:
            self.mark.update((run, pinned, last, games))
            if self.keep_days is not None and last != before[2]:
                # One timer stands, at the time that the last date gave it.
                if before[2] is not None:
                    self.handle.deleteTimer(self._forget_at(before[2]))
                self.handle.registerTimer(self._forget_at(last))
        return iter(())

    def _forget_at(self, last: date) -> int:
        return (last - EPOCH).days * DAY_MS + (self.keep_days + 1) * DAY_MS

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        found = self.mark.get()
        if found:
            _, _, last, games = found
            self.mark.clear()
            yield Row(team_id_master=key[0], last_scraped=last, games_scraped=games)

    def close(self) -> None:
        pass


def run_progress(stream: DataFrame, folder: str, as_of: Column | None = None, max_back: int = 365) -> DataFrame:
    """(team_id_master, last_scraped, games_scraped) after all available games, however they are cut into batches.

    A game counts if it is at most ``max_back`` days older than ``as_of`` and not older than the team's mark before the run.
    Without ``as_of`` every game counts. Teams whose mark is older than ``max_back`` days before the watermark leave
    the state and stay in the result.
    """
    spark, run = stream.sparkSession, run_number(stream.sparkSession, folder)
    accepted = F.lit(True) if as_of is None else F.col("date") >= F.date_sub(as_of, max_back)
    rows = stream.select("team_id_master", "date", F.coalesce(F.col("date").isNotNull() & accepted, F.lit(False)).alias("accepted"))
    mode, keep = "None", None
    if as_of is not None:
        # Games that the watermark turns away are older than any that could count; later dates do not move it past as_of.
        rows = rows.withColumn("seen_at", F.least("date", as_of).cast("timestamp")).withWatermark("seen_at", f"{max_back} days")
        mode, keep = "EventTime", max_back
    run_stateful(rows, Marks(run, keep), "team_id_master", PROGRESS, folder, mode)
    finish_run(spark, folder, run)
    live = read_state(spark, folder, "mark", f"team_id_master string, {MARK}").select("team_id_master", "last_scraped", "games_scraped")
    return live.unionByName(given(spark, folder, PROGRESS)).groupBy("team_id_master").agg(
        F.max("last_scraped").alias("last_scraped"), F.sum("games_scraped").alias("games_scraped")).where("games_scraped > 0")


# ---------------------------------------------------------------- identities

FEED, SPAN = "seen_at string, provider_team_id string", "first_seen string, first_name string, last_seen string"


class Identities(StatefulProcessor):
    """What is known of a team: names and clubs as map entries, the newest id per feed, first name and first and last sighting."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.aliases = handle.getMapState("aliases", "alias string", "first_seen string")
        self.clubs = handle.getMapState("clubs", "club string", "first_seen string")
        self.feeds = handle.getMapState("feeds", "provider string", FEED)
        self.span = handle.getValueState("span", SPAN)

    def _earliest(self, state, seen: dict[str, str]) -> None:
        for name, first in seen.items():
            known = state.getValue((name,))
            if known is None or first < known[0]:
                state.updateValue((name,), (first,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.span.get()
        first, name, last = before or (None, None, None)
        aliases: dict[str, str] = {}
        clubs: dict[str, str] = {}
        feeds: dict[str, tuple[str, str]] = {}
        for r in rows:
            seen = r["seen_at"]
            # Sighting and name as one sortable pair; a sighting without a time comes first, as in the batch form.
            at = (seen, r["team_name"] or "")
            if first is None or at < (first, name or ""):
                first, name = at
            last = seen if last is None else max(last, seen)
            for named, column in ((aliases, "alias"), (clubs, "club")):
                if r[column] is not None:
                    named[r[column]] = min(seen, named.get(r[column], seen))
            if r["provider"] is not None:
                entry = (seen, r["provider_team_id"] or "")
                feeds[r["provider"]] = max(entry, feeds.get(r["provider"], entry))
        self._earliest(self.aliases, aliases)
        self._earliest(self.clubs, clubs)
        for provider, newest in feeds.items():
            known = self.feeds.getValue((provider,))
            if known is None or newest > tuple(known):
                self.feeds.updateValue((provider,), newest)
        if before is None or (first, name, last) != tuple(before):
            self.span.update((first, name, last))
        return iter(())

    def close(self) -> None:
        pass


def run_identities(stream: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Fold sightings into the identity map: tables ``teams``, ``aliases``, ``clubs`` and ``feeds``, one row per entry.

    The result does not depend on the order of the sightings. Names and clubs stay rows; ``identity_rows`` makes the wide form.
    """
    tid = F.coalesce("team_id", ids.team_id(F.col("team_name"), F.col("state"), F.col("age_group"), F.col("gender")))
    rows = stream.withColumn("team_id", tid).where(F.col("team_id").rlike("^[a-f0-9]{12}$")).select(
        "team_id", "team_name", "provider", F.col("provider_team_id").cast("string").alias("provider_team_id"),
        F.when(F.coalesce("team_name", F.lit("")) != "", F.col("team_name")).alias("alias"),
        F.when(strip("club_name") != "", strip("club_name")).alias("club"), F.coalesce("seen_at", F.lit("")).alias("seen_at"))
    run_stateful(rows, Identities(), "team_id", "team_id string", folder)
    spark = stream.sparkSession
    return {
        "teams": read_state(spark, folder, "span", f"team_id string, {SPAN}"),
        "aliases": read_state(spark, folder, "aliases", "team_id string, alias string, first_seen string"),
        "clubs": read_state(spark, folder, "clubs", "team_id string, club string, first_seen string"),
        "feeds": read_state(spark, folder, "feeds", f"team_id string, provider string, {FEED}"),
    }


def identity_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per team with its names, clubs and feed ids as arrays and a map, for a sink that wants them together."""
    def listed(table: str, column: str, name: str) -> DataFrame:
        return tables[table].groupBy("team_id").agg(F.array_sort(F.collect_set(column)).alias(name))

    feeds = tables["feeds"].groupBy("team_id").agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("provider", F.nullif("provider_team_id", F.lit("")).alias("pid"))))).alias("provider_ids"))
    empty = F.array().cast(T.ArrayType(T.StringType()))
    return (
        tables["teams"].join(feeds, "team_id", "left").join(listed("aliases", "alias", "aliases"), "team_id", "left")
        .join(listed("clubs", "club", "club_history"), "team_id", "left")
        .select("team_id", F.nullif("first_name", F.lit("")).alias("canonical_name"),
                F.coalesce("provider_ids", F.create_map().cast("map<string,string>")).alias("provider_ids"),
                F.coalesce("aliases", empty).alias("aliases"), F.coalesce("club_history", empty).alias("club_history"),
                F.nullif("first_seen", F.lit("")).alias("created_at"), F.nullif("last_seen", F.lit("")).alias("updated_at"))
    )
