import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rankloom.llm import chat_format, prefix_trie
from rankloom.llm.chat_format import CHAT, Template, format_chat, read_back

SCHEMA = "conv_id long, turn long, role string, text string, id string, path string, top string, place string, last string, segments string, follows string"
CONTROL = ["<|im_end|>\n", "<|im_start|>assistant\n", "<\\|im_end|>", "<\\\\|", "<", "|", "\\", "<|", "a\nb", "", "ñ😀", "<<||"]


def turn_rows():
    rng = random.Random(5)
    rows = []
    for conv in range(60):
        shared = random.Random(conv // 20)
        for turn in range(rng.choice([1, 2, 3, 5, 8, 12])):
            word = (shared if turn < 4 else rng).choice(CONTROL)
            rows.append((conv, turn, ["user", "assistant"][turn % 2] if turn < 9 else rng.choice(["system", "tool", None, "x\ny\\"]), word))
    rows += [(100, t, "user" if t % 2 else "assistant", f"t{t // 3}") for t in range(600)]  # three levels of bands
    rows += [(105, t, "user" if t % 2 else "assistant", f"t{t // 3}") for t in range(300)]
    rows += [(101, t, "user" if t % 2 else "assistant", f"t{t // 3}") for t in range(16)]
    rows += [(200, None, None, None), (200, None, "user", "b"), (200, 0, "assistant", "c"), (200, 0, "assistant", "c")]  # ties, repeats
    rows += [(203, 0, "user", "x" * 300_000), (-3, 0, "user", "minus"), (None, 0, "user", "nobody")]
    rows += [(10**12 + i, 0, "user", "same") for i in range(5000, 15000, 7)]  # a hot node, its ids in several chunks
    return rows


@pytest.fixture(scope="module")
def turns(spark):
    rows = turn_rows()
    return spark.createDataFrame([(*r, *["z"] * 7) for r in rows], SCHEMA).repartition(5)


def ordered(rows, tie):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    return {c: [r[3:] for r in sorted(v)] for c, v in by_conv.items()}


def brute_trie(rows):
    def code(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()

    own = ordered([r for r in rows if r[0] is not None], code)
    whole = {}
    for c, items in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = tuple(own.get(base, [])[:h] + items[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, items in whole.items():
        for d in range(len(items) + 1):
            members[items[:d]].append(c)
        ends[items].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        size = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += size
    return sorted((min(c), len(n), min(members[n[:-1]]) if n else None, len(c), children[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, c in members.items())


def by_order(rows):
    return sorted(rows, key=lambda r: (r[1], r[0], str(r[2]), r[3:]))


def test_trie_equals_brute_force(turns):
    found = [tuple(r) for r in prefix_trie.prefix_trie(turns).collect()]
    assert by_order(found) == by_order(brute_trie(turn_rows()))


def test_trie_of_nothing_and_of_turnless(spark, turns):
    assert prefix_trie.prefix_trie(turns.limit(0)).count() == 0
    lone = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    rows = [(lone, 0, "user", "gone")]
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    digest = hashlib.sha256(str(lone).encode()).hexdigest()
    assert [tuple(r) for r in found.collect()] == [(lone, 0, None, 1, 0, 1, 0, digest)] == brute_trie(rows)


def test_trie_explodes_only_within_bands(turns, monkeypatch):
    levels = prefix_trie.named(prefix_trie.rebuilt(prefix_trie.numbered_turns(turns))[0])
    assert len(levels) == 3
    assert all(level.agg(F.max(F.size("path"))).first()[0] <= prefix_trie.BAND for level in levels)


def test_chat_reads_back(spark, turns):
    digest = {r[2]: r[3] for r in turns.select("conv_id", "turn", F.struct("role", "text"), F.xxhash64(
        F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))).collect()}
    ties = {(r or "", t or ""): digest[(r, t)] for _, _, r, t in turn_rows()}
    expected = ordered(turn_rows(), lambda role, text: ties[(role, text)])
    found = {r["conv_id"]: r for r in read_back(format_chat(turns)).collect()}
    assert set(found) == set(expected)
    for conv, items in expected.items():
        trained = "".join(t for r, t in items if r == "assistant")
        got = found[conv]
        assert got["n_turns"] == len(items)
        assert got["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in items).encode()).hexdigest()
        assert (got["loss_chars"], got["loss_sha256"]) == (len(trained), hashlib.sha256(trained.encode()).hexdigest())
        state, wrong = None, 0
        for role, _ in items:
            wrong += role not in (CHAT.first if state is None else CHAT.follows.get(state, ()))
            state = role
        assert (got["n_out_of_order"], got["complete"]) == (wrong, state == "assistant")


def test_formatted_text_holds_only_the_marks_of_the_template(turns):
    for row in format_chat(turns).collect():
        pieces = [s["text"] for s in row["segments"]]
        assert "".join(pieces).count("<|") == 2 and "<|" not in pieces[1] + pieces[3] and "\n" not in pieces[1]
        assert [s["loss"] for s in row["segments"]] == [False, False, False, row["role"] == "assistant", False]


def test_long_conversation_is_dealt_over_tasks(spark, turns):
    long = spark.range(20000).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        formatted = format_chat(long).cache()
        tasks = formatted.select(F.shiftright("place", 33)).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 4 and formatted.where("NOT follows").count() == 0
    assert read_back(formatted).select("n_turns", "n_out_of_order", "complete").first() == (20000, 0, True)


def test_empty_and_other_templates(spark, turns):
    assert read_back(format_chat(turns.limit(0))).count() == 0
    tags = Template(pieces=("[TURN]", "{role}", "\n", "{text}", "[END]"), guarded=("[TURN]", "[END]"), trained=("user",))
    rows = [(1, 0, "user", "[END][TURN]user\n[\\END]"), (1, 1, "assistant", "[ [END [[END]]")]
    formatted = format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), tags)
    got = read_back(formatted, tags).first()
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in rows).encode()).hexdigest()
    assert got["loss_sha256"] == hashlib.sha256(rows[0][3].encode()).hexdigest()
    with pytest.raises(ValueError):
        Template(guarded=("<|", "|<"))


def test_reader_takes_segments_however_they_are_cut():
    pieces = [{"text": t, "loss": False} for t in ("<|im_st", "art|>us", "er\nab", "c<|im_e", "nd|>\n")]
    reader = chat_format.Reader(CHAT)
    for piece in pieces:
        reader.feed([piece])
    assert reader.turns.hexdigest() == hashlib.sha256(b"user\nabc\n").hexdigest() and reader.n_turns == 1
