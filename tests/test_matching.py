import random
import re

import pytest
from pyspark.sql import functions as F

from rankloom.functions import similarity as sim
from rankloom.operators import delta, matching

KEYS = ["state", "age_group"]


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def plain_ratio(a, b):
    return 2 * plain_common(a, b) / (len(a) + len(b)) if a or b else 1.0


def plain_partial(a, b):
    if not a or not b:
        return float(not a and not b)
    out = 0.0
    for short, long in ((a, b), (b, a)) if len(a) == len(b) else ((a, b),) if len(a) < len(b) else ((b, a),):
        for start in range(1 - len(short), len(long)):
            out = max(out, plain_ratio(short, long[max(0, start):start + len(short)]))
    return out


def plain_score(a, b):
    if not a or not b:
        return 0.0
    wa, wb = sorted(a.split()), sorted(b.split())
    both = sorted(set(wa) & set(wb))
    only = [sorted(set(wa) - set(wb)), sorted(set(wb) - set(wa))]
    with_a, with_b, shared = " ".join(both + only[0]), " ".join(both + only[1]), " ".join(both)
    best, stretch = plain_ratio(a, b), max(len(a), len(b)) / min(len(a), len(b))
    if stretch < 1.5:
        sets = [plain_ratio(with_a, with_b)] + ([plain_ratio(shared, with_a), plain_ratio(shared, with_b)] if both else [])
        sets += [1.0] if both and not (only[0] and only[1]) else []
        return max(best, 0.95 * max([plain_ratio(" ".join(wa), " ".join(wb)), *sets]))
    scale = 0.9 if stretch <= 8 else 0.6
    words = 1.0 if both else plain_partial(" ".join(wa), " ".join(wb))
    return max(best, scale * plain_partial(a, b), scale * 0.95 * words)


def names(seed, n):
    rng = random.Random(seed)
    parts = ["Phoenix", "Rising", "FC", "Rush", "Tucson", "Lions", "United", "2015", "Ñandú", "B", "AZ", "Real", "Sporting", "Club de Fútbol"]
    out = []
    for _ in range(n):
        name = " ".join(rng.sample(parts, rng.randint(1, 5)))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            at = rng.randrange(len(name) + 1)
            name = name[:at] + rng.choice(["", "x", " ", "o"]) + name[at + rng.choice([0, 1]):]
        out.append(name)
    return out + ["a", "ab", "abc", "abcd", "x" * 150, "x" * 130 + "y" * 40, "aa aa aa", "aa", " lead", "lead"]


def test_ratios_equal_plain_ones():
    a, b = names(1, 200), names(2, 200)
    a += ["", "", "z"] + ["😀é" * 70]
    b += ["", "q", ""] + ["é😀" * 64]
    assert sim.ratios(a, b).tolist() == pytest.approx([plain_ratio(x, y) for x, y in zip(a, b)])
    assert sim.partial_ratios(a, b).tolist() == pytest.approx([plain_partial(x, y) for x, y in zip(a, b)])


def test_weighted_score_equals_plain_one(spark):
    rng = random.Random(3)
    pairs = list(zip(names(4, 300), rng.sample(names(5, 300), 310), strict=True)) + [(None, "x"), ("x", None), ("", "x"), ("", ""), ("x", "x")]
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("s", sim.weighted_score(F.col("a"), F.col("b")))
    for a, b, s in df.collect():
        assert (s is None) == (a is None or b is None) and (s is None or s == pytest.approx(plain_score(a, b)))


def blocks(spark):
    left = [(name, "AZ" if i % 3 else "CA", "U10") for i, name in enumerate(names(6, 120))]
    right = [(name, "AZ" if i % 2 else "CA", "U10") for i, name in enumerate(names(7, 120))]
    schema = "team_name string, state string, age_group string"
    return left, right, spark.createDataFrame([*left, left[0], (None, "AZ", "U10"), ("", "AZ", "U10")], schema), spark.createDataFrame(right, schema)


@pytest.mark.parametrize("cutoff", [0.7, 0.8])
def test_best_match_equals_comparing_all(spark, cutoff):
    left, right, a, b = blocks(spark)
    expected = {}
    for name, state, _ in left:
        scored = sorted((-round(1.0 if name == other else plain_score(name, other), 9), other) for other, s, _ in right if s == state)
        if scored and -scored[0][0] > cutoff:
            expected[state, name] = (scored[0][1], -scored[0][0])
    found = {(r["state"], r["left_name"]): (r["right_name"], r["score"]) for r in matching.best_matches(a, b, KEYS, cutoff).collect()}
    assert found == expected and len(found) > 60


def test_filter_keeps_every_pair_that_passes_and_leaves_some_out(spark):
    left, right, a, b = blocks(spark)
    entries = [matching._entries(df, KEYS, "team_name") for df in (a, b)]
    kept = {(r["state"], r["left_name"], r["right_name"]) for r in matching.candidate_pairs(*entries, KEYS, 0.7).collect()}
    every = {(s, x, y) for x, s, _ in left for y, t, _ in right if s == t and x != y}
    passing = {p for p in every if plain_score(p[1], p[2]) > 0.7}
    assert passing <= kept < every
    with pytest.raises(ValueError):
        matching.candidate_pairs(*entries, KEYS, 0.6)


def test_rename_by_score(spark):
    schema = "team_name string, age_group string, gender string, state string"
    old = spark.createDataFrame([("Phoenix Rising", "U10", "M", "AZ"), ("Tucson Lions", "U10", "M", "AZ"), ("Owls", "U12", "M", "AZ")], schema)
    new = spark.createDataFrame([("Rising Phoenix 2015 Boys Premier", "U10", "M", "AZ"), ("Owl", "U12", "M", "AZ")], schema)
    got = [(r["old_team_name"], r["new_team_name"], round(r["similarity_score"], 6)) for r in delta.renamed_teams(new, old, scorer="weighted").collect()]
    assert got == [("Phoenix Rising", "Rising Phoenix 2015 Boys Premier", 85.5)]


def test_alike_names_of_a_block_are_not_all_scored(spark, monkeypatch):
    rng = random.Random(8)
    old = [f"{rng.choice(['Valley', 'Harbor', 'Summit'])} FC District {i % 13} Squad {i * 7919 % 4000}" for i in range(120)]
    new = [n + " Gold" if i % 3 else n.upper() if i % 2 else n for i, n in enumerate(old)] + ["Summit FC District 4", "12", "FC Owls"]
    a, b = (spark.createDataFrame([(n, "AZ", "U10") for n in rows], "team_name string, state string, age_group string") for rows in (new, old))
    expected = {}
    for name in set(new):
        best = min((-round(1.0 if name == other else plain_score(name, other), 9), other) for other in old)
        if -best[0] > 0.7:
            expected[name] = (best[1], -best[0])
    compared = []
    candidates = matching.candidate_pairs
    monkeypatch.setattr(matching, "candidate_pairs", lambda *args: compared.append(candidates(*args)) or compared[-1])
    found = {r["left_name"]: (r["right_name"], r["score"]) for r in matching.best_matches(a, b, KEYS, 0.7).collect()}
    assert found == expected
    assert sum(df.count() for df in compared) < len(new) * len(old) / 4


def test_letter_pairs_of_a_text_that_is_worked_out(spark):
    text = F.array_join(sim.words(F.col("name")), " ")
    df = spark.createDataFrame([("b aab",), ("",), (None,)], "name string").select(matching.letter_pairs(text, (" ", " ")).alias("p"))
    assert [r["p"] for r in df.collect()][:2] == [[" a1", "aa1", "ab1", "b 1", " b1", "b 2"], ["  1"]]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_letters_are_a_multiset_without_blanks(spark):
    texts = ["aba a", " \t ", "", "é😀é😀", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, name string").select("i", matching.letters_of(F.col("name")).alias("x"))
    found = {r["i"]: r["x"] for r in df.collect()}
    assert [found[i] for i in range(3)] == [[(97 << 32) + 1, (98 << 32) + 1, (97 << 32) + 2, (97 << 32) + 3], [], []]
    assert len(set(found[3])) == 4 and {x >> 32 for x in found[3]} == {ord("é"), ord("😀")}


def test_names_that_share_too_few_letters_are_not_scored(spark):
    left = [f"{w.upper()} FC DISTRICT {i % 13} SQUAD {i} " for i, w in enumerate(["Valley", "Harbor", "Summit"] * 5)]
    right = [f"{w} FC District {i % 13} Squad {i}" for i, w in enumerate(["Valley", "Harbor", "Summit"] * 5)]
    a, b = (spark.createDataFrame([(n, "AZ", "U10") for n in rows], "team_name string, state string, age_group string") for rows in (left, right))
    assert not any(plain_score(x, y) > 0.7 for x in left for y in right)
    assert matching.candidate_pairs(*[matching._entries(df, KEYS, "team_name") for df in (a, b)], KEYS, 0.7).count() == 0


def test_staged_names_are_not_broadcast_by_the_size_of_their_files(spark, monkeypatch):
    """Their letter pairs take some fifty times the room of the files."""
    name = F.concat_ws(" ", F.lit("FC District"), (F.col("id") % 13).cast("string"), F.lit("Squad"), F.col("id").cast("string"))
    df = spark.range(400).select(name.alias("team_name"), F.lit("AZ").alias("state"), F.lit("U10").alias("age_group"))
    plans, stage = {}, matching.stage
    monkeypatch.setattr(matching, "stage", lambda df, name="stage": plans.setdefault(name, []).append(
        df._jdf.queryExecution().executedPlan().toString()) or stage(df, name))
    matching.best_matches(df.withColumn("team_name", F.concat("team_name", F.lit(" Gold"))), df, KEYS).count()
    sent = [re.findall(r"BroadcastExchange.*?FileScan parquet \[([^\]]*)", p, re.DOTALL) for k in ("match-pairs", "match-open") for p in plans[k]]
    assert len(sent) > 3 and not any("name#" in columns for found in sent for columns in found if "plain#" in columns or "size#" not in columns)
