import os

import pytest
from pyspark.sql import functions as F

from rankloom.operators import identity
from rankloom.streaming import incremental as I
from rankloom.streaming import state

SCHEMA = "team_id_master string, date date"


def add(spark, source, rows):
    made = spark.createDataFrame(rows, "team_id_master string, date string").withColumn("date", F.to_date("date"))
    made.coalesce(1).write.mode("append").parquet(source)


def stream_of(spark, source, per_batch):
    return I.game_stream(spark, source, spark.createDataFrame([], SCHEMA).schema, files_per_batch=per_batch)


def run(stream, folder, as_of="2025-01-31", max_back=365):
    rows = state.run_progress(stream, folder, F.lit(as_of).cast("date"), max_back).collect()
    return {r["team_id_master"]: (str(r["last_scraped"]), r["games_scraped"]) for r in rows}


FILES = ([("a", "2025-01-08"), ("b", "2025-01-20")], [("a", "2025-01-02"), ("c", None)], [("a", "2025-01-09"), ("b", "2020-01-01")], [("b", "2025-01-19")])
DONE = {"a": ("2025-01-09", 3), "b": ("2025-01-20", 2)}


@pytest.mark.parametrize("per_batch", [1, 16])
def test_marks_do_not_depend_on_batches(spark, tmp_path, per_batch):
    source, folder = str(tmp_path / "in"), str(tmp_path / "job")
    for rows in FILES:
        add(spark, source, rows)
    assert run(stream_of(spark, source, per_batch), folder) == DONE
    add(spark, source, [("a", "2025-01-05"), ("a", "2025-01-10"), ("d", "2025-01-01")])  # the second run turns older games away
    assert run(stream_of(spark, source, per_batch), folder) == {"a": ("2025-01-10", 4), "b": ("2025-01-20", 2), "d": ("2025-01-01", 1)}


def test_killed_batch_continues_its_run(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "job")
    for rows in FILES:
        add(spark, source, rows)
    stream = stream_of(spark, source, 1)
    lost = stream.withColumn("date", F.when(F.col("date") == "2025-01-09", F.raise_error(F.lit("lost")).cast("date")).otherwise(F.col("date")))
    with pytest.raises(Exception, match="lost"):
        run(lost, folder)
    assert len([f for f in os.listdir(f"{folder}/offsets/commits") if f.isdigit()]) >= 1
    assert run(stream, folder) == DONE


def test_idle_teams_leave_the_state_but_not_the_result(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "job")
    add(spark, source, [("old", "2025-01-01"), ("old", "2025-01-02")])
    assert run(stream_of(spark, source, 1), folder, max_back=30) == {"old": ("2025-01-02", 2)}
    for day in ("2025-05-01", "2025-05-02", "2025-05-03"):
        add(spark, source, [("new", day)])
        found = run(stream_of(spark, source, 1), folder, "2025-05-05", 30)
    assert found == {"old": ("2025-01-02", 2), "new": ("2025-05-03", 3)}
    live = state.read_state(spark, folder, "mark", f"team_id_master string, {state.MARK}")
    assert [r["team_id_master"] for r in live.collect()] == ["new"]


def test_a_batch_writes_the_keys_it_touches(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "job")
    add(spark, source, [(f"t{i:05}", "2025-01-01") for i in range(20000)])
    run(stream_of(spark, source, 1), folder)

    def written():
        return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{folder}/offsets/state") for f in names}

    first = written()
    add(spark, source, [("t00007", "2025-01-02")])
    found = run(stream_of(spark, source, 1), folder)
    changes = {f: n for f, n in written().items() if f not in first and f.endswith(".changelog")}
    assert found["t00007"] == ("2025-01-02", 2) and len(found) == 20000
    assert sum(changes.values()) < sum(first.values()) / 10


SIGHTING = "team_id string, team_name string, provider string, provider_team_id string, club_name string, state string, gender string, age_group string, seen_at string"


@pytest.mark.parametrize("per_batch", [1, 16])
def test_identities_equal_the_batch_form(spark, tmp_path, per_batch):
    source, tid = str(tmp_path / "in"), "a" * 12
    parts = ([(tid, "Red B", "f", "1", " Club ", "AZ", "M", "U10", "3"), (tid, "Red A", "g", "7", None, "AZ", "M", "U10", "5")],
             [(tid, "Red", "f", "2", "", "AZ", "M", "U10", "1"), (None, "Blue", "g", None, "Other", "AZ", "M", "U10", "2")],
             [(tid, None, "f", "9", "Club", "AZ", "M", "U10", "4"), ("bad id", "X", "g", "9", None, "AZ", "M", "U10", "2")])
    for rows in parts:
        spark.createDataFrame(rows, SIGHTING).coalesce(1).write.mode("append").parquet(source)
    stream = I.game_stream(spark, source, spark.createDataFrame([], SIGHTING).schema, files_per_batch=per_batch)
    tables = state.run_identities(stream, str(tmp_path / "job"))
    found = state.identity_rows(tables)
    batch = identity.observe_identities(spark.read.schema(SIGHTING).parquet(source))
    order = ("team_id", "canonical_name", "provider_ids", "aliases", "club_history", "created_at", "updated_at")
    assert sorted(map(str, found.select(*order).collect())) == sorted(map(str, batch.select(*order).collect()))
    assert sorted(map(tuple, tables["aliases"].where(F.col("team_id") == tid).collect())) == [(tid, "Red", "1"), (tid, "Red A", "5"), (tid, "Red B", "3")]


def test_empty_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    assert run(stream_of(spark, source, 1), str(tmp_path / "job")) == {}


class Kept(dict):
    """A state variable that counts what it is asked."""

    def __init__(self):
        self.calls = []

    def _called(self, name, result=None):
        self.calls.append(name)
        return result

    def get(self):
        return self._called("get", self.__dict__.get("value"))

    def update(self, value):
        self._called("update")
        self.value = value

    def getValue(self, key):
        return self._called("getValue", dict.get(self, key))

    def updateValue(self, key, value):
        self._called("updateValue")
        self[key] = value

    def registerTimer(self, at):
        self._called("registerTimer")

    def deleteTimer(self, at):
        self._called("deleteTimer")


def test_a_team_asks_its_state_little(spark):
    from datetime import date

    marks = state.Marks(0, 20)
    marks.handle, marks.mark = Kept(), Kept()
    for day in (3, 9, 9, 5):
        list(marks.handleInputRows(("a",), iter([{"date": date(2025, 1, day), "accepted": True}]), None))
    list(marks.handleInputRows(("a",), iter([{"date": date(2025, 1, 20), "accepted": False}]), None))
    assert marks.mark.value == (0, None, date(2025, 1, 9), 4)
    assert marks.mark.calls.count("get") == 5 and marks.mark.calls.count("update") == 4 and len(marks.mark.calls) == 9
    assert marks.handle.calls == ["registerTimer", "deleteTimer", "registerTimer"]


def test_a_known_sighting_changes_no_state(spark):
    known = state.Identities()
    known.aliases, known.clubs, known.feeds, known.span = Kept(), Kept(), Kept(), Kept()
    row = {"seen_at": "3", "team_name": "Red", "alias": "Red", "club": "Club", "provider": "f", "provider_team_id": "1"}
    for _ in range(2):
        list(known.handleInputRows(("a",), iter([dict(row), {**row, "seen_at": "4", "alias": None, "provider_team_id": None}]), None))
    assert (dict(known.aliases), dict(known.clubs), dict(known.feeds)) == ({("Red",): ("3",)}, {("Club",): ("3",)}, {("f",): ("4", "")})
    assert known.span.value == ("3", "Red", "4")
    assert known.aliases.calls == ["getValue", "updateValue", "getValue"] and known.span.calls == ["get", "update", "get"]
