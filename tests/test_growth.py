"""What grew too fast or failed on larger tables."""

from pyspark.sql import functions as F

from rankloom.functions import text
from rankloom.operators import delta, reports
from rankloom.schemas import GAME_COLUMNS
from rankloom.sources import files, payloads, sinks

TEAM = "provider string, team_id_source string, team_id_master string, team_name string, club_name string, age_group string, gender string, state string"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_deltas_without_any_change_are_read_back_as_zero(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "team_id string, team_name string")
    for name, changes, counts in (("none", {"added": rows.limit(0), "removed": rows.limit(0)}, {"added": 0, "removed": 0}),
                                  ("one", {"added": rows, "removed": rows.limit(0)}, {"added": 2, "removed": 0})):
        root = str(tmp_path / name)
        written = sinks.write_deltas(changes, root)
        found = sinks.read_deltas(spark, root, written, "team_id string, team_name string")
        assert {r["change_type"]: r["teams"] for r in sinks.count_deltas(found, list(changes)).collect()} == counts


def test_entries_and_documents_are_taken_apart_once(spark):
    entries = spark.createDataFrame([], f"{TEAM}, entry string")
    plan = optimized(payloads.parse_game_entries(entries, F.lit("2025-01-01").cast("date")))
    assert plan.count("split(entry") == 1
    documents = spark.createDataFrame([], f"{TEAM}, payload string")
    for layout in ("history", "match"):
        plan = optimized(payloads.parse_matches(documents, F.lit("2025-01-01").cast("date"), layout))
        assert plan.count("parse_json") + plan.count("parseJson") == 1


def test_documents_and_rejects(spark):
    texts = ('{"a": 1}', '[{"a": 1}, {}]', '{"data": [{"a": 2}]}', "[]", "{}", '[{"a": 1}, null]', "[1]", "7", "null", "no json", None)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, payload string")
    rows, rejected = payloads.read_payloads(df, payloads.MATCH_LISTS)
    assert sorted((r["n"], r["pos"]) for r in rows.collect()) == [(0, 0), (1, 0), (1, 1), (2, 0), (4, 0)]
    assert sorted(r["n"] for r in rejected.collect()) == [5, 6, 7, 8, 9, 10]


def test_best_similar_names_without_the_pairs_of_a_block(spark, monkeypatch):
    names = [("AZ", f"Valley District {i % 3} Squad {i * 7919 % 4000}") for i in range(150)]
    new, old = [(s, n + " Gold") if i % 5 == 1 else (s, n.upper()) if i % 5 == 2 else (s, n) for i, (s, n) in enumerate(names)], names[::2]
    a, b = (spark.createDataFrame(rows, "state string, team_name string") for rows in (new, old))
    pairs = delta.similar_names(a, b, ["state"], 0.5, strict=True, tokens=text.trigrams).collect()
    best = {}
    for r in sorted(pairs, key=lambda r: (-r["score"], r["right_name"])):
        best.setdefault(r["left_name"], (r["right_name"], r["score"]))
    compared = []
    pairs_at = delta._pairs_at
    monkeypatch.setattr(delta, "_pairs_at", lambda *args: compared.append(pairs_at(*args)) or compared[-1])
    found = delta.best_similar(a, b, ["state"], 0.5, text.trigrams).collect()
    assert {r["left_name"]: (r["right_name"], r["score"]) for r in found} == best and len(found) == len(best)
    assert sum(df.count() for df in compared) < len(pairs) / 4


def test_two_hop_reach_sends_no_bitmaps(spark, monkeypatch):
    games = [(str(i % 40), None if i % 11 == 0 else str(i * i % 61) if i % 7 else f"x{i % 5}") for i in range(150)] + [("40", "40"), ("41", None), (None, "1")]
    met = {}
    for team, opponent in games:
        if team is not None:
            met.setdefault(team, set()).update({opponent} - {None})
    expected = {team: len({team}.union(found, *(met.get(o, ()) for o in found))) for team, found in met.items()}
    monkeypatch.setattr(reports, "LEAST_TEAMS", 1)
    df = spark.createDataFrame(games, "team_id_master string, opponent_id_master string")
    for grid in (1, 7):
        monkeypatch.setattr(reports, "GRID", grid)
        found = reports.two_hop_all(df)
        assert "bitmap" not in optimized(found)
        assert {r["team_id_master"]: r["network_teams"] for r in found.collect()} == expected
    assert reports.two_hop_all(df.limit(0)).count() == 0


def test_names_of_a_block_meet_by_their_sizes(spark, monkeypatch):
    names = [f"{'Red Blue Green Gold Grey'.split()[i % 5]} FC District {i % 13} Squad {i}{' Gold X' * (i % 50 == 7)}" for i in range(260)] + ["", "FC", "FC FC"]
    df = spark.createDataFrame([("AZ", n) for n in names], "state string, team_name string")
    words = {r["team_name"]: set(r["w"]) for r in df.select("team_name", text.name_tokens(F.col("team_name")).alias("w")).collect() if r["w"]}
    expected = {(x, y) for x in words for y in words if len(words[x] & words[y]) / len(words[x] | words[y]) >= 0.6}
    joined = []
    where = type(df).where
    monkeypatch.setattr(type(df), "where", lambda self, test: joined.append(self) or where(self, test))
    found = {(r["left_name"], r["right_name"]) for r in delta.similar_names(df, df, ["state"], 0.6).collect()}
    monkeypatch.undo()
    assert found == expected
    pairs = next(j for j in joined if {"_left_at", "_right_at"} <= set(j.columns))
    assert pairs.count() < 260 * 260 / 7


def test_builds_are_written_compressed_and_read_back(spark, tmp_path):
    root = str(tmp_path)
    rows = [("t1", "o1", "2025-01-01", "2", "1"), ("t1", "o1", "2025-01-01", "2", "1"), ("t2", None, "2025-01-02", "0", "0")]
    games = spark.createDataFrame(rows, "team_id_master string, opponent_id string, game_date string, goals_for string, goals_against string")
    games = games.select(*[F.col(c) if c in games.columns else F.lit("x").alias(c) for c in GAME_COLUMNS])
    sinks.write_partitioned(games.withColumn("slice_key", F.lit("AZ_M_U10")), f"{root}/build_1/games_feed", ["slice_key"], "csv", compression="gzip")
    assert {p.suffix for p in tmp_path.glob("build_1/games_feed/slice_key=*/part-*")} == {".gz"}
    found = files.consolidate_builds(spark, root, ["AZ"], ["M"], ["U10"])
    assert sorted((r["team_id_master"], r["slice_key"], r["gf"]) for r in found.collect()) == [("t1", "AZ_M_U10", 2.0), ("t2", "AZ_M_U10", 0.0)]


def test_schedule_pairs_are_rows_however_often_they_played(spark, monkeypatch):
    from statistics import median

    from rankloom.operators import graph

    games = ([("a", "b")] * 400 + [("a", "c")] * 399 + [("a", "d")] * 3 + [("b", "b"), ("c", None), (None, "c"), ("d", "x")]) * 2
    strength = {"a": 1.0, "b": 2.0, "c": 5.0, "d": 9.0}
    met = {t: [] for t in strength}
    for x, y in games:
        for team, opponent in [(x, y)] + [(y, x)] * (x != y):
            if team in strength and opponent in strength:
                met[team].append(strength[opponent])
    df = spark.createDataFrame(games, "team_id_master string, opponent_id_master string")
    staged, stage = {}, graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, name="stage": staged.setdefault(name, stage(df, name)))
    found = graph.baseline_schedule(df, spark.createDataFrame(list(strength.items()), "team string, strength double"))
    assert {r["team"]: r["baseline_sos"] for r in found.collect()} == {t: median(v or strength.values()) for t, v in met.items()}
    assert staged["met"].count() == 7


def test_iso_dates_are_one_cast_with_the_results_of_the_pattern(spark):
    from rankloom.functions.games import iso_date

    texts = ("2024-02-29", "2023-02-29", "0000-01-01", "0001-01-01", "1582-10-10", "2024-1-5", " 2024-01-05 ", "2024-01-05T23:30:00-05:00", "2024-01-05\n",
             "12024-01-05", "+12024-01-05", "-2024-01-05", "2024-01-05x", "not a date", "", None, "2024", "2024-13-01", "24-01-01", "10:00", "T10:00", "9999-12-31")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    pattern = F.coalesce(F.try_to_date("t", "yyyy-MM-dd"), F.col("t").try_cast("timestamp").cast("date"))
    assert df.where(~pattern.eqNullSafe(iso_date(F.col("t")))).count() == 0
    assert "gettimestamp" not in optimized(df.select(iso_date(F.col("t")))).lower()
