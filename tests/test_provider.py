import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankloom.sources import files
from rankloom.sources.provider import ProviderStream, published, read_provider, stream_provider

SCHEMA = "team string, goals bigint, note string"


def publish(spark, root, day, rows):
    spark.createDataFrame(rows, "team string, goals int").coalesce(1).write.parquet(f"{root}/day={day}")


@pytest.fixture
def root(spark, tmp_path):
    place = f"file://{tmp_path}/feed"
    for day, rows in (("2025-01-01", [("a", 1), ("b", 2)]), ("2025-01-02", [("a", 3)]), ("2025-02-01", [("c", None)])):
        publish(spark, place, day, rows)
    return place


def schema_of(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_days_are_left_out_at_the_source(spark, root):
    found = read_provider(spark, root, schema_of(spark))
    assert sorted(map(tuple, found.fillna(-1).collect()), key=str) == [
        ("a", 1, None, dt.date(2025, 1, 1)), ("a", 3, None, dt.date(2025, 1, 2)), ("b", 2, None, dt.date(2025, 1, 1)), ("c", -1, None, dt.date(2025, 2, 1))]
    some = found.where((F.col("day") >= "2025-01-02") & (F.col("day") < "2025-02-01") & (F.col("team") == "a"))
    assert some.rdd.getNumPartitions() == 1 and [r["goals"] for r in some.collect()] == [3]
    assert found.where("day > '2030-01-01'").count() == 0 and read_provider(spark, root, schema_of(spark), "2025-01-02").count() == 2
    assert read_provider(spark, root + "/nothing", schema_of(spark)).count() == 0


def test_failed_batch_is_read_again_with_the_same_days(spark, root, tmp_path):
    seen, fail = [], [True]

    def each(batch, number):
        seen.append((number, sorted(str(r["day"]) for r in batch.select("day").distinct().collect())))
        if fail[0]:
            raise OSError("lost")

    def run():
        stream_provider(spark, root, schema_of(spark), "2025-01-02").writeStream.foreachBatch(each).option(
            "checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    publish(spark, root, "2025-02-02", [("d", 9)])
    fail[0] = False
    run()
    run()
    first = (0, ["2025-01-02", "2025-02-01"])
    assert seen[:2] == [first, first] and seen[2:] == [(1, ["2025-02-02"])]


def test_offsets_are_since_dates(spark, root):
    reader = ProviderStream(root, schema_of(spark).add("day", "date"), None)
    assert reader.initialOffset() == {"since": "0001-01-01"} and reader.latestOffset() == {"since": "2025-02-02"}
    assert len(reader.partitions({"since": "2025-01-02"}, {"since": "2025-02-01"})) == 1 and len(published(root)) == 3


def test_feed_reads_through_its_provider(spark, root):
    feed = files.register_feed("league", schema_of(spark), {"team_id_source": "upper(team)", "game_date": lambda: F.date_format("day", "yyyy-MM-dd")})
    assert sorted(map(tuple, feed.read(spark, root, "2025-01-02").collect())) == [("A", "2025-01-02"), ("C", "2025-02-01")]
    assert feed.stream(spark, root).isStreaming
