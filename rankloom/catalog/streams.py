"""Streaming queries: each runs what is available to the end and returns the resulting table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom import adapters as A
from rankloom.catalog.base import day_text, joined, query
from rankloom.catalog.sql import with_ctes
from rankloom.catalog.summaries import SIGHTINGS, _sightings
from rankloom.operators import digests, integrity
from rankloom.sources.sinks import write_partitioned
from rankloom.storage import scratch_path
from rankloom.streaming import incremental as I
from rankloom.streaming import state


def _events(spark, sf):
    """The events table as a stream of games: user as team, day as date."""
    schema = A.table(spark, sf, "events").schema
    stream = I.game_stream(spark, sf, schema, "events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _event_games(df):
    return df.select(
        F.col("user_id").cast("string").alias("team_id_master"), F.to_date("ts").alias("date"), "event_type", "value")


def _in_files(rows, folder, *keys):
    """Rows dealt to files by a key that has nothing to do with their dates: out of order, a few files to a batch."""
    write_partitioned(rows, folder, list(keys))
    return I.game_stream(rows.sparkSession, folder, rows.sparkSession.read.parquet(folder).schema, files_per_batch=4)


DAY = "2024-01-31"


@query("s01_high_water_mark", """
WITH e AS (SELECT user_id, ts::DATE AS d, event_id % 3 <> 0 AND ts::DATE < DATE '2024-01-20' AS early FROM events),
m AS (SELECT user_id, max(d) AS mark FROM e WHERE early AND d >= DATE '2024-01-31' - 20 GROUP BY 1)
SELECT user_id::VARCHAR AS team_id_master, strftime(max(d), '%Y-%m-%d') AS last_scraped, count(*) AS games_scraped FROM e LEFT JOIN m USING (user_id)
WHERE d >= DATE '2024-01-31' - 20 AND (early OR mark IS NULL OR d >= mark) GROUP BY 1""")
def s01(spark, sf):
    # Two runs: games before the 20th, then later games and the old ones that came late, which the marks of the first run turn away.
    folder = scratch_path(spark, "s01")
    as_of = F.lit(DAY).cast("date")
    rows = A.table(spark, sf, "events").withColumn("early", (F.col("event_id") % 3 != 0) & (F.to_date("ts") < "2024-01-20"))
    for early in (True, False):
        # One file per key however many tasks read the table: a run takes as many batches at any size.
        rows.where(F.col("early") == early).withColumn("file", F.col("event_id") % 9).repartition("file").write.partitionBy("file").mode(
            "append").parquet(f"{folder}/in")
        stream = I.game_stream(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema, files_per_batch=4)
        progress = state.run_progress(_event_games(stream), f"{folder}/job", as_of, 20)
    return progress.withColumn("last_scraped", day_text("last_scraped"))


@query("s02_progress_over_batches", """
SELECT user_id::VARCHAR AS team_id_master, strftime(max(ts), '%Y-%m-%d') AS last_scraped, count(*) AS games_scraped FROM events GROUP BY 1""")
def s02(spark, sf):
    folder = scratch_path(spark, "s02")
    stream = _in_files(A.table(spark, sf, "events").withColumn("file", F.col("event_id") % 9), f"{folder}/in", "file")
    return state.run_progress(_event_games(stream), f"{folder}/job").withColumn("last_scraped", day_text("last_scraped"))


@query("s03_append_with_dedupe", "SELECT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT value) AS n FROM events GROUP BY 1, 2, 3")
def s03(spark, sf):
    # A game is a repeat when user, kind, day and value were seen before.
    stream = _events(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    unique = I.run_deduped(stream, scratch_path(spark, "s03"), "day", ["user_id", "event_type", "day", "value"])
    return unique.groupBy("user_id", "event_type", "day").agg(F.count("*").alias("n"))


@query("s04_identity_upsert", with_ctes("""
SELECT k.team_id, array_to_string(aliases, '|') AS aliases, coalesce(array_to_string(clubs, '|'), '') AS club_history, n AS feeds
FROM known_all k JOIN feed_ids f USING (team_id)""", SIGHTINGS))
def s04(spark, sf):
    folder = scratch_path(spark, "s04")
    stream = _in_files(_sightings(spark, sf).withColumn("file", F.col("custkey") % 5).drop("custkey"), f"{folder}/in", "copy", "file")
    identities = state.identity_rows(state.run_identities(stream, f"{folder}/job"))
    return identities.select("team_id", joined("aliases", "|").alias("aliases"), joined("club_history", "|").alias("club_history"),
                             F.size("provider_ids").alias("feeds"))


@query("s05_tamper_check", """
SELECT status, count(*) AS games FROM (SELECT CASE WHEN event_id % 33 = 1 THEN 'new' WHEN event_id % 20 = 0 THEN 'modified' ELSE 'unchanged' END AS status FROM events) e GROUP BY 1""")
def s05(spark, sf):
    def games(df, value):
        return df.select(F.col("event_id").cast("string").alias("team_id_source"), F.col("event_type").alias("opponent_id"),
                         F.date_format("ts", "yyyy-MM-dd").alias("game_date"), value.alias("goals_for"), F.lit("H").alias("home_away"))

    stored = A.table(spark, sf, "events").where(F.col("event_id") % 33 != 1)
    changed = F.when(F.col("event_id") % 20 == 0, F.col("value") + 1).otherwise(F.col("value"))
    folder = scratch_path(spark, "s05")
    digests.write_store(integrity.hash_games(games(stored, F.col("value"))), f"{folder}/store")
    stream = _in_files(A.table(spark, sf, "events").withColumn("file", F.col("event_id") % 9), f"{folder}/in", "file")
    status = I.run_integrity(games(stream, changed), f"{folder}/store", f"{folder}/job")
    return status.groupBy("status").agg(F.count("*").alias("games"))


@query("s06_running_totals", """
SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS games, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def s06(spark, sf):
    stream = _events(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    totals = I.run_totals(stream, scratch_path(spark, "s06"), ["event_type", "day"], [F.count("*").alias("games"), F.sum("value").alias("total")])
    return totals.select("event_type", "day", "games", F.round("total", 4).alias("total"))
