"""Graph, change detection, linking, sources and streams on small fixtures."""

import datetime as dt
import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from rankloom.functions import text
from rankloom.operators import clean, delta, graph, identity, integrity, link, quality, registry
from rankloom.sources import files, payloads
from rankloom.storage import stage
from rankloom.streaming import incremental as I

GAMES = "team_id_master string, opponent_id_master string, gf double, ga double"


def _find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


@pytest.mark.parametrize("seed", [1, 2])
def test_components_and_degree(spark, seed):
    rng = random.Random(seed)
    # A long chain, a star, random pairs, a self game, and games without an opponent.
    rows = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)] + [("hub", f"leaf{i}") for i in range(60)]
    rows += [(f"r{rng.randrange(40)}", f"r{rng.randrange(40)}") for _ in range(25)] + [("self", "self"), ("alone", None)]
    found = {r["node"]: r for r in graph.connectivity(spark.createDataFrame(rows, "team_id_master string, opponent_id_master string")).collect()}
    nodes = {x for r in rows for x in r if x}
    parent = {x: x for x in nodes}
    for a, b in rows:
        if b:
            parent[_find(parent, a)] = _find(parent, b)
    groups = {}
    for x in nodes:
        groups.setdefault(_find(parent, x), set()).add(x)
    assert found.keys() == nodes
    for members in groups.values():
        for x in members:
            edges = {frozenset((a, b)) for a, b in rows if b and x in (a, b)}
            degree = sum(2 if len(e) == 1 else 1 for e in edges)
            assert (found[x]["component_id"], found[x]["component_size"], found[x]["degree"]) == (min(members), len(members), degree)


def test_schedules_against_plain_python(spark):
    rng = random.Random(4)
    rows = [(f"t{rng.randrange(8)}", rng.choice([f"t{rng.randrange(8)}", "x1", None]), float(rng.randrange(5)), float(rng.randrange(5))) for _ in range(80)]
    rows.append(("lonely", None, 1.0, 0.0))
    games = spark.createDataFrame(rows, GAMES)
    strengths = stage(graph.goal_strength(games))
    s = {t: max(0.0, statistics.mean(r[2] - r[3] for r in rows if r[0] == t) + 2) for t in {r[0] for r in rows}}
    base = {r["team"]: r["baseline_sos"] for r in graph.baseline_schedule(games, strengths).collect()}
    for t in s:
        met = [s[o] for o in [(r[1] if r[0] == t else r[0]) for r in rows if t in (r[0], r[1])] if o in s]
        assert base[t] == pytest.approx(statistics.median(met) if met else statistics.median(s.values()))
    current = dict(s)
    for _ in range(3):
        new = {}
        for t in current:
            met = [current[r[1]] for r in rows if r[0] == t and r[1] in current]
            new[t] = 0.85 * statistics.mean(met) + 0.15 * current[t] if met else current[t]
        current = new
    found = {r["team"]: r["strength"] for r in graph.iterative_schedule(strengths, graph.opponent_edges(games), tolerance=0.0).collect()}
    assert found == pytest.approx(current)


TEAMS = "team_name string, age_group string, gender string, state string"


def test_new_teams(spark):
    old = spark.createDataFrame([("Red Lion", "U10", "M", "AZ"), ("Blue Fox", "U12", None, "CA")], TEAMS)
    new = spark.createDataFrame([("Red Lion", "U10", "M", "AZ"), (" red lion ", "U10", "M", "AZ"), ("Blue Fox", "U12", None, "CA"), ("Gold Owl", "U13", "M", "TX")], TEAMS)
    names = lambda df: sorted(r["team_name"] for r in df.collect())
    assert names(delta.new_teams(new, old)) == [" red lion ", "Gold Owl"]
    assert names(delta.new_teams(new, old, normalize_keys=True)) == ["Gold Owl"]
    assert delta.new_teams(new, old.limit(0)).count() == 4
    assert delta.new_teams(new.limit(0), old).count() == 0
    with pytest.raises(ValueError, match="Missing required columns"):
        delta.new_teams(new.drop("team_name"), old)


@pytest.mark.parametrize("threshold", [0.5, 0.7])
def test_similar_names_finds_every_pair(spark, threshold):
    rng = random.Random(9)
    words = ["red", "lion", "fox", "owl", "star", "gold", "blue", "city", "fc"]
    rows = [(" ".join(rng.sample(words, rng.randrange(1, 6))), "U10", "M", rng.choice(["AZ", "AZ", "CA"])) for _ in range(150)]
    df = spark.createDataFrame(rows, TEAMS)
    keys = ["age_group", "gender", "state"]
    found = {(r["state"], r["left_name"], r["right_name"]) for r in delta.similar_names(df, df, keys, threshold).collect()}
    stop = {"fc"}
    expected = set()
    for a in set(rows):
        for b in set(rows):
            x, y = set(a[0].split()) - stop, set(b[0].split()) - stop
            if a[3] == b[3] and x and y and len(x & y) / len(x | y) >= threshold - 1e-12:
                expected.add((a[3], a[0], b[0]))
    assert found == expected


def test_conflicts_keep_the_fullest_row_and_all_feeds(spark):
    rows = [("t1", "A", None, "GotSport", "u1"), ("t1", "A", "Club", "AthleteOne", "u2"), ("t2", "B", None, "AthleteOne", "u3"), ("t2", "B", None, "GotSport", "u4")]
    df = spark.createDataFrame(rows, "team_id string, team_name string, club_name string, provider string, source_url string")
    got = {r["team_id"]: (r["source_url"], r["providers"]) for r in delta.resolve_conflicts(df).collect()}
    assert got == {"t1": ("u2", ["AthleteOne", "GotSport"]), "t2": ("u4", ["AthleteOne", "GotSport"])}


def test_state_clean_up(spark):
    df = spark.createDataFrame([("CAS",), ("CAN",), ("TXN",), ("MEX",), ("",), (None,), ("A",), ("USA",), ("OH",)], "state string")
    assert sorted(r["state"] for r in clean.normalize_states(df).collect()) == ["CA", "CA", "OH", "TX", "USA"]


def test_link_gate(spark):
    good = spark.createDataFrame([("1", "2", 1.0, 1.0)] * 99 + [("2", None, 1.0, 1.0)], GAMES)
    assert clean.check_links(good) == "ok"
    with pytest.raises(ValueError, match="missing"):
        clean.check_links(spark.createDataFrame([("1", "2", 1.0, 1.0)] * 9 + [("2", None, 1.0, 1.0)], GAMES))
    assert clean.check_links(spark.createDataFrame([("1", "9", 1.0, 1.0)], GAMES)) == "low_overlap"


VALID = ("a" * 12, "1", "Red", "U10", 10, "M", "AZ", "feed", None, "u", "2025-01-01T00:00:00")


@pytest.mark.parametrize("place,value,rule", [
    (0, "XYZ", "team_id_format"), (2, None, "team_name_missing"), (3, "10", "age_group_format"), (4, 9, "age_range"), (5, "X", "gender_code"),
    (6, "arizona", "state_format"), (6, "ZZ", "state_unknown"), (7, None, "provider_missing"), (9, None, "source_url_missing"), (10, "yesterday", "created_at_format"), (4, 11, "age_mismatch")])
def test_each_rule_fails_alone(spark, place, value, rule):
    from rankloom.schemas import MASTER_TEAM
    assert quality.rejected_rows(spark.createDataFrame([VALID], MASTER_TEAM), quality.master_rules()).count() == 0
    row = list(VALID)
    row[place] = value
    broken = quality.rejected_rows(spark.createDataFrame([tuple(row)], MASTER_TEAM), quality.master_rules()).first()["broken_rules"]
    assert rule in broken


def test_hash_text_and_integrity(spark):
    import hashlib
    df = spark.createDataFrame([("7.0", None, "2025-07-31", 1.0, 2.0, "H")], "team_id_source string, opponent_id string, game_date string, goals_for double, goals_against double, home_away string")
    row = integrity.hash_games(df).first()
    plain = "team_id_source:7.0|opponent_id:NULL|game_date:2025-07-31|goals_for:1.0|goals_against:2.0|home_away:H"
    assert (row["game_id"], row["game_hash"]) == ("game_7.0_2025-07-31", hashlib.sha256(plain.encode()).hexdigest())
    nothing = integrity.integrity_report(integrity.diff_hashes(df.sparkSession.createDataFrame([], "game_id string, game_hash string"), integrity.hash_games(df))).first()
    assert nothing["integrity_score"] == 0.0 and nothing["needs_refresh"]


def test_retention_and_latest_build(spark):
    entries = spark.createDataFrame([(f"2025-01-{d:02d}",) for d in range(1, 29)], "timestamp string")
    kept = registry.retention_split(entries, 20).where("retained").agg(F.count("*"), F.min("timestamp")).first()
    assert tuple(kept) == (20, "2025-01-09")
    files_seen = spark.createDataFrame([("AZ_M_U10", "build_20250101_0900"), ("AZ_M_U10", "build_20250102_0800"), ("AZ_M_U10", "other")], "slice_key string, build_id string")
    assert registry.latest_builds(files_seen).first()["latest_build"] == "build_20250102_0800"


# ---------------------------------------------------------------- sources

def test_whole_file_readers(spark, tmp_path):
    (tmp_path / "ids.json").write_text(json.dumps({"a" * 12: {"canonical_name": "Red", "provider_ids": {"f": "1"}, "aliases": ["Red"], "club_history": []}}, indent=1))
    assert files.read_identity_map(spark, str(tmp_path / "ids.json")).first()["provider_ids"] == {"f": "1"}
    (tmp_path / "hash.json").write_text(json.dumps({"slice_key": "AZ_M_U10", "build_id": "b", "total_games": 2, "games": {"g1": "x", "g2": "y"}}, indent=1))
    assert files.read_hash_store(spark, str(tmp_path / "hash.json")).count() == 2


def test_builds_as_single_files(spark, tmp_path):
    from rankloom.schemas import GAME_COLUMNS
    for build, goals in (("build_20250101_0900", 1), ("build_20250102_0900", 2)):
        folder = tmp_path / build
        folder.mkdir()
        values = {c: "" for c in GAME_COLUMNS} | {"team_id_master": "1", "opponent_id": "2", "game_date": "2025-01-01", "goals_for": str(goals), "goals_against": "0.0"}
        for slice_key in ("AZ_M_U10", "CA_F_U11"):
            body = ",".join(GAME_COLUMNS) + "\n" + ",".join(values[c] for c in GAME_COLUMNS) + "\n"
            (folder / f"games_feed_{slice_key}.csv").write_text(body)
    latest = files.consolidate_builds(spark, str(tmp_path), ["AZ"], ["M"], ["U10"]).collect()
    assert [(r["gf"], r["slice_key"], r["build_id"], r["club"]) for r in latest] == [(2.0, "AZ_M_U10", "build_20250102_0900", None)]
    assert files.consolidate_builds(spark, str(tmp_path), ["AZ", "CA"], ["M", "F"], ["U10", "U11"], refresh=True).count() == 2
    with pytest.raises(ValueError):
        files.consolidate_builds(spark, str(tmp_path), ["TX"], ["M"], ["U10"])


def test_ranking_page_cells(spark):
    html = """<table id='rankingsTable'><tr><th>h</th></tr><tr><td>7. <a href="#">Red &amp; Blue</a></td><td>AZ</td><td>1,200</td></tr>
<tr><td>short</td></tr><tr><td>Owls</td><td>State</td><td>tx</td></tr></table>"""
    df = spark.createDataFrame([(10, "f", "u", html)], "age int, gender string, url string, html string")
    rows = [(r["rank"], r["team_name"], r["points"], r["state"], r["gender"]) for r in payloads.parse_ranking_pages(df).collect()]
    assert rows == [(7, "Red & Blue", 7, "AZ", "Female"), (3, "Owls", 0, "TX", "Female")]


# ---------------------------------------------------------------- streams

def test_progress_stream_restarts_where_it_stopped(spark, tmp_path):
    schema = "team_id_master string, date date"
    source, folder = str(tmp_path / "in"), str(tmp_path / "job")
    as_of = F.lit("2025-01-31").cast("date")

    def add(rows):
        spark.createDataFrame(rows, "team_id_master string, date string").withColumn("date", F.to_date("date")).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = I.game_stream(spark, source, spark.createDataFrame([], schema).schema, files_per_batch=1)
        return {r["team_id_master"]: (str(r["last_scraped"]), r["games_scraped"]) for r in I.run_progress(stream, folder, as_of, 365).collect()}

    add([("a", "2025-01-05"), ("a", "2025-01-07"), ("b", "2020-01-01")])
    assert run() == {"a": ("2025-01-07", 2)}
    add([("a", "2025-01-06"), ("a", "2025-01-08"), ("b", "2025-01-01")])
    assert run() == {"a": ("2025-01-08", 3), "b": ("2025-01-01", 1)}
    assert run() == {"a": ("2025-01-08", 3), "b": ("2025-01-01", 1)}


def test_identity_upsert_flags(spark):
    schema = "team_id string, team_name string, provider string, provider_team_id string, club_name string, state string, gender string, age_group string, seen_at string"
    tid = "a" * 12
    before = identity.observe_identities(spark.createDataFrame([(tid, "Red", "f", "1", None, "AZ", "M", "U10", "1")], schema))
    rows = spark.createDataFrame([(tid, "Red", "f", "1", None, "AZ", "M", "U10", "2"), (None, "Blue", "g", "9", " Club ", "AZ", "M", "U10", "2"),
                                  ("bad id", "X", "g", "9", None, "AZ", "M", "U10", "2")], schema)
    got = {r["canonical_name"]: (r["is_new"], r["was_updated"], r["club_history"]) for r in identity.upsert_identities(before, rows).collect()}
    assert got == {"Red": (False, False, []), "Blue": (True, True, ["Club"])}
    assert spark.range(1).select(text.likely_same(F.lit("Red Lion"), F.lit("lion RED"))).first()[0]


# ---------------------------------------------------------------- rows that must not get lost or multiply

def test_rename_with_a_typing_error(spark):
    schema = "team_name string, age_group string, gender string, state string"
    old = spark.createDataFrame([("Phoenix Rising", "U10", "M", "AZ"), ("Tucson Lions", "U10", "M", "AZ")], schema)
    new = spark.createDataFrame([("Pheonix Rising", "U10", "M", "AZ")], schema)
    found = {s: [(r["old_team_name"], r["new_team_name"]) for r in delta.renamed_teams(new, old, scorer=s).collect()] for s in ("letters", "words")}
    assert found == {"letters": [("Phoenix Rising", "Pheonix Rising")], "words": []}


def test_ambiguous_feed_ids_do_not_multiply_games(spark):
    games = spark.createDataFrame([("x", "7", None, "p"), ("x", "7", None, "q"), ("m1", "9", None, "p")],
                                  "team_id_master string, team_id_source string, opponent_id string, provider string")
    master = spark.createDataFrame([("m2", "7", "p", "Two"), ("m3", "7", "p", "Three"), ("m4", "7", "q", "Four"), ("m1", "1", "p", "One")],
                                   "team_id_master string, provider_team_id string, provider string, team_name string")
    got = link.link_games(games, master).select("team_id_source", "provider", "link_status", "team_name_master").collect()
    assert sorted(map(tuple, got)) == [("7", "p", "fallback", "Two"), ("7", "q", "fallback", "Four"), ("9", "p", "primary", "One")]
    assert [tuple(r) for r in link.ambiguous_keys(master).collect()] == [("p", "7", 2, "m2")]


def test_survivors_do_not_depend_on_row_order(spark):
    rows = [("Red", "U10", "M", "AZ", "s", 1, 5, url) for url in ("b", "a", "c")]
    schema = "team_name string, age_group string, gender string, state string, source string, rank int, points int, url string"
    for order in (rows, rows[::-1]):
        assert [r["url"] for r in delta.dedupe_feed(spark.createDataFrame(order, schema)).collect()] == ["a"]
    new = spark.createDataFrame([("t", "b"), ("t", "a"), (None, "z"), ("k", "n")], "team_id string, name string")
    base = spark.createDataFrame([("k", "old")], "team_id string, name string")
    assert sorted((r["team_id"] or "", r["name"]) for r in delta.merge_with_baseline(new, base).collect()) == [("", "z"), ("k", "old"), ("t", "a")]


@pytest.mark.parametrize("per_batch", [1, 16])
def test_late_unique_games_are_stored_once(spark, tmp_path, per_batch):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id int, day string, note string"
    for part in ([(1, "2025-06-01", "x")], [(2, "2025-06-20", "x"), (1, "2025-06-01", "y")], [(3, "2025-03-01", "x"), (4, None, "n")], [(4, None, "n")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    stream = I.game_stream(spark, source, spark.createDataFrame([], schema).schema, files_per_batch=per_batch)
    assert sorted(r["id"] for r in I.run_deduped(stream, folder, "day", ["id", "day"]).collect()) == [1, 2, 3, 4]


@pytest.mark.parametrize("per_batch", [1, 16])
def test_progress_does_not_depend_on_batches(spark, tmp_path, per_batch):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "team_id_master string, date date"
    for day in ("2025-01-08", "2025-01-02"):
        spark.createDataFrame([("a", dt.date.fromisoformat(day))], schema).coalesce(1).write.mode("append").parquet(source)
    stream = I.game_stream(spark, source, spark.createDataFrame([], schema).schema, files_per_batch=per_batch)
    assert [tuple(r)[1:] for r in I.run_progress(stream, folder, F.lit("2025-01-10").cast("date")).collect()] == [(dt.date(2025, 1, 8), 2)]


def test_page_entries_are_read_by_line(spark):
    entry = "Saturday, March 1, 2025\nRush 2016 Boys\n3 - 1\nPhoenix Rising 2015\n2025 Spring Cup\n9:30 AM"
    inline = "Sunday, March 2, 2025\n10:00 AM\nPhoenix Rising 2015 0 - 2 Rush 2016 Boys\n2025 Fall League"
    rows = [("f", "1", "m", "Rush 2016 Boys", "U10", "M", "AZ", e) for e in (entry, inline, "no date\n1 - 2", None)]
    df = spark.createDataFrame(rows, "provider string, team_id_source string, team_id_master string, team_name string, age_group string, gender string, state string, entry string")
    got = payloads.parse_game_entries(df).select("game_date", "home_away", "opponent_name", "goals_for", "goals_against", "competition").collect()
    assert sorted(map(tuple, got)) == [("2025-03-01", "H", "Phoenix Rising 2015", 3, 1, "2025 Spring Cup"),
                                       ("2025-03-02", "A", "Phoenix Rising 2015", 0, 2, "2025 Fall League")]
