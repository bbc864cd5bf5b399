import os

import pytest
from pyspark.sql import functions as F

from rankloom.operators import digests, integrity
from rankloom.sources import store as S

SCHEMA = "team string, day date, gf int, scraped_at string"


def files_of(folder):
    return {d.rsplit("=", 1)[1]: sorted(f for f in os.listdir(os.path.join(folder, "games", d)) if f.endswith(".parquet"))
            for d in os.listdir(f"{folder}/games") if d.startswith("_day=")}


def games(spark, rows):
    return spark.createDataFrame(rows, "team string, day string, gf int, scraped_at string").withColumn("day", F.to_date("day"))


@pytest.fixture
def store(spark, tmp_path):
    return S.GameStore(spark, str(tmp_path / "store"), SCHEMA, ["team", "day", "gf"], "day", "scraped_at")


def content(store):
    return sorted((r["team"] or "", str(r["day"]), r["gf"], r["scraped_at"] or "") for r in store.read().collect())


def test_append_keeps_the_newest_and_leaves_other_days_alone(spark, store):
    store.append(games(spark, [("a", "2025-01-01", 1, "1"), ("a", "2025-01-02", 2, "1"), ("b", "2025-01-03", 3, None), (None, None, 0, "1")]))
    before = files_of(store.folder)
    got = store.append(games(spark, [("a", "2025-01-02", 2, "2"), ("a", "2025-01-03", 9, "2"), ("b", "2025-01-03", 3, None), (None, None, 0, "0"),
                                     ("c", "2024-06-01", 1, "2"), ("a", "2025-01-02", 2, "0"), ("d", "2025-01-02", 1, "5")]))
    assert content(store) == sorted([("a", "2025-01-01", 1, "1"), ("a", "2025-01-02", 2, "2"), ("b", "2025-01-03", 3, ""), ("", "None", 0, "1"),
                                     ("a", "2025-01-03", 9, "2"), ("c", "2024-06-01", 1, "2"), ("d", "2025-01-02", 1, "5")])
    after = files_of(store.folder)
    assert got["days_rewritten"] == 1 and got["compared"] >= 3
    assert after["2025-01-01"] == before["2025-01-01"] and after["none"] == before["none"]
    assert set(before["2025-01-03"]) < set(after["2025-01-03"]) and not set(before["2025-01-02"]) & set(after["2025-01-02"])


def test_append_again_after_a_lost_write_stores_once(spark, store, monkeypatch):
    store.append(games(spark, [("a", "2025-01-01", 1, "1")]))
    write = store._write
    monkeypatch.setattr(store, "_write", lambda rows, table, mode: write(rows, table, mode) if table == "filter" else (_ for _ in ()).throw(OSError("lost")))
    rows = games(spark, [("b", "2025-01-01", 1, "1"), ("a", "2025-01-01", 1, "0")])
    with pytest.raises(OSError):
        store.append(rows)
    monkeypatch.undo()
    for _ in range(2):
        store.append(rows)
    assert content(store) == [("a", "2025-01-01", 1, "1"), ("b", "2025-01-01", 1, "1")]


def test_filter_knows_every_key_and_few_others(spark):
    rows = spark.range(20000).select(F.lit("d").alias("_day"), F.col("id").alias("k"))
    bits = S.merged(S.bloom_filter(rows.where("k % 2 = 0"), ["k"]), S.bloom_filter(rows.where("k < 10"), ["k"]))
    asked = rows.withColumn("block", S._block(["k"])).join(bits, ["_day", "block"], "left").withColumn("known", S._known(F.col("bitmap"), S._positions(["k"])))
    counts = asked.groupBy((F.col("k") % 2 == 0).alias("even")).agg(F.count_if("known").alias("n")).collect()
    found = {r["even"]: r["n"] for r in counts}
    assert found[True] == 10000 and found[False] < 200


def test_store_of_nothing(spark, store):
    assert store.append(games(spark, [])) == {"new": 0, "compared": 0, "days_rewritten": 0} and content(store) == []


# ---------------------------------------------------------------- digest tree

HASHES = "slice_key string, game_id string, game_hash string"


def hashes(spark, change=lambda i: f"h{i}", n=3000, skip=()):
    rows = [(None if i % 7 == 0 else f"s{i % 3}", f"game_{i}", change(i)) for i in range(n) if i not in skip]
    return spark.createDataFrame(rows, HASHES)


def test_digest_diff_equals_the_full_one(spark, tmp_path):
    folder = str(tmp_path / "hashes")
    old = hashes(spark, skip=(5, 6, 7))
    new = hashes(spark, lambda i: f"h{i}" if i % 100 else "changed", skip=(8, 21))
    digests.write_store(old, folder, ["slice_key"])
    keys = ["slice_key", "game_id", "status"]

    def rows(df):
        return sorted(map(str, df.select(*keys).collect()))

    full = integrity.diff_hashes(old.fillna("none"), new.fillna("none"), ["slice_key"]).withColumn("slice_key", F.nullif("slice_key", F.lit("none")))
    assert rows(digests.diff_store(new, folder, ["slice_key"])) == rows(full)
    batch = rows(digests.check_batch(new.where("game_id LIKE 'game_1%'"), folder, ["slice_key"]))
    assert batch == rows(full.where("game_id LIKE 'game_1%' AND status <> 'deleted'"))
    assert digests.diff_store(new.limit(0), folder, ["slice_key"]).groupBy("status").count().collect()[0][:] == ("deleted", 2997)


def test_one_changed_game_opens_one_leaf(spark, tmp_path, monkeypatch):
    folder, opened = str(tmp_path / "hashes"), []
    digests.write_store(hashes(spark), folder, ["slice_key"])
    read = digests.stored_rows
    monkeypatch.setattr(digests, "stored_rows", lambda spark, folder, leaves, schema: opened.append(leaves) or read(spark, folder, leaves, schema))
    found = digests.diff_store(hashes(spark, lambda i: "x" if i == 1234 else f"h{i}"), folder, ["slice_key"])
    assert {r["game_id"] for r in found.where("status <> 'unchanged'").collect()} == {"game_1234"} and found.count() == 3000
    assert [len(x) for x in opened] == [1]
    assert len({f.split("leaf=")[1].split("/")[0] for f in found.inputFiles() if "leaf=" in f}) == 1
    opened.clear()
    assert digests.diff_store(hashes(spark), folder, ["slice_key"]).where("status <> 'unchanged'").count() == 0 and opened == [[]]


# ---------------------------------------------------------------- layouts of documents

def test_documents_by_line_and_by_file_are_told_apart(spark, tmp_path):
    from rankloom.sources import files

    folder = tmp_path / "hash store"
    folder.mkdir()
    (folder / "one.json").write_text('{\n "slice_key": "s", "build_id": "b",\n "games": {"g1": "h1", "g2": "h2"}}')
    (folder / "many.json").write_text('\n'.join('{"slice_key": "s", "build_id": "b", "games": {"g%d": "h"}}' % i for i in range(3, 6)))
    layouts = files.json_layouts(spark, str(folder), None)
    assert {k: [p.rsplit("/", 1)[1] for p in v] for k, v in layouts.items()} == {True: ["many.json"], False: ["one.json"]}
    assert sorted(r["game_id"] for r in files.read_hash_store(spark, str(folder)).collect()) == ["g1", "g2", "g3", "g4", "g5"]


def test_survivors_among_rows_that_differ_in_maps(spark):
    from rankloom.operators.windows import best_row

    df = spark.createDataFrame([("k", {"a": i}, [{"b": i}]) for i in range(6)], "key string, m map<string,int>, l array<map<string,int>>")
    picks = {str(best_row(df.repartition(n), ["key"], []).select("m", "l").first()) for n in (1, 2, 3, 5)}
    assert len(picks) == 1


def test_days_without_a_new_key_keep_their_filter(spark, store):
    def filters():
        return {d: sorted(f for f in os.listdir(os.path.join(store.folder, "filter", d)) if f.endswith(".parquet"))
                for d in os.listdir(f"{store.folder}/filter") if d.startswith("_day=")}

    rows = [("a", "2025-01-01", 1, "1"), ("b", "2025-01-01", 1, "1"), ("a", "2025-01-02", 2, None), (None, None, 0, "1")]
    assert store.append(games(spark, rows + rows[:1]))["new"] == 4
    before = filters()
    got = store.append(games(spark, [(t, d, n, "2") for t, d, n, _ in rows[1:]] + [("c", "2025-01-02", 2, "2")]))
    assert got == {"new": 1, "compared": 3, "days_rewritten": 3}
    after = filters()
    assert after["_day=2025-01-01"] == before["_day=2025-01-01"] and after["_day=none"] == before["_day=none"]
    assert after["_day=2025-01-02"] != before["_day=2025-01-02"]
    assert content(store) == sorted([("a", "2025-01-01", 1, "1"), ("b", "2025-01-01", 1, "2"), ("a", "2025-01-02", 2, "2"), ("", "None", 0, "2"), ("c", "2025-01-02", 2, "2")])
