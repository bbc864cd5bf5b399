"""Decontamination, near copies, repeats, personal data and packing against plain versions, on awkward rows."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from rankloom.llm import decontamination, near_copies, packing, personal, repeats

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_decontamination(spark, docs, texts):
    items = [("a", " ".join(texts[6].split()[:20])), ("b", "one two"), ("c", None), ("d", "!!"), (None, "x" * 30000), ("a2", texts[6])]
    table = spark.createDataFrame(items, "item_id string, text string")
    got = decontamination.judged(decontamination.find_passages(docs, table))
    expected = []
    for r in docs.select("doc_id", "text").collect():
        w, hit, ids = words(r.text), set(), set()
        for item, text in items:
            v = words(text)
            size = min(13, len(v))
            for at in range(len(v) - size + 1 if v else 0):
                for i in range(len(w) - size + 1):
                    if w[i:i + size] == v[at:at + size]:
                        hit |= set(range(i, i + size))
                        ids.add(item or "")
        expected.append((r.doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                         bool(hit) and 20 * len(hit) >= len(w)))
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(expected, key=repr)
    spans = next(r for r in got.select("text", "spans", "n_hit").collect() if r.text == texts[6])
    assert len(words(texts[6][spans.spans[0]:spans.spans[-1]])) == spans.n_hit


def test_decontamination_in_passes(spark, docs, texts, monkeypatch):
    items = spark.createDataFrame([(i, texts[6 + i]) for i in range(20)], "item_id long, text string")
    whole = decontamination.judged(decontamination.find_passages(docs, items))
    monkeypatch.setattr(decontamination, "PASS_WORDS", 400)
    parted = decontamination.judged(decontamination.find_passages(docs, items))
    columns = ("doc_id", "hit_words", "spans", "items", "contaminated")
    assert rows_of(whole, *columns) == rows_of(parted, *columns)


def test_decontamination_of_nothing(docs, no_docs, spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.judged(decontamination.find_passages(docs, items)).filter("n_hit > 0 or contaminated").count() == 0
    assert decontamination.find_passages(no_docs, items).count() == 0


def plain_links(rows):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = collections.defaultdict(set)
    for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2):
        if a and b and 5 * len(a & b) >= 4 * len(a | b):
            links[i].add(j)
            links[j].add(i)
    return links


@pytest.mark.parametrize("tile", [144, 2])
def test_near_copies(docs, tile, monkeypatch):
    monkeypatch.setattr(near_copies, "TILE", tile)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    links = plain_links(rows)
    expected = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        expected.append((doc_id, min((rows[j][0] for j in seen if rows[j][0] is not None), default=None), len(links[i])))
    assert rows_of(near_copies.near_copies(docs), "doc_id", "class_id", "n_links") == sorted(expected, key=repr)


def test_near_copies_in_a_large_group(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(500):
        text = list(base)
        for at in rng.choice(60, i % 3, replace=False):
            text[at] = f"x{rng.integers(1e9)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links = plain_links(rows)
    assert rows_of(near_copies.near_copies(docs), "doc_id", "n_links") == sorted(((i, len(links[i])) for i, _ in rows), key=repr)


def test_near_copies_of_nothing(no_docs):
    assert near_copies.near_copies(no_docs).count() == 0


def plain_repeats(data, length):
    times = collections.Counter(t[i:i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if times[t[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0 if t else np.zeros(0, bool)
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((len(t), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest(), edges.tolist()))
    return out


@pytest.mark.parametrize("length", [200, 106])
def test_repeats(docs, length):
    rows = docs.select("doc_id", "text").collect()
    expected = [(r.doc_id, *x) for r, x in zip(rows, plain_repeats([(r.text or "").encode() for r in rows], length), strict=True)]
    got = repeats.find_repeats(docs, length)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans") == sorted(expected, key=repr)


def test_repeats_of_random_cuts(spark):
    rng = np.random.default_rng(8)
    source = rng.integers(97, 123, 3000, np.uint8).tobytes().decode()
    rows = [(i, rng.integers(97, 123, 50, np.uint8).tobytes().decode() + source[a:a + n] + "!" * int(i % 3))
            for i, (a, n) in enumerate(zip(rng.integers(0, 2700, 60), rng.integers(150, 700, 60), strict=True))]
    got = repeats.find_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    expected = [(i, *x) for (i, _), x in zip(rows, plain_repeats([t.encode() for _, t in rows], 200), strict=True)]
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans") == sorted(expected, key=repr)


def test_repeats_of_a_run_of_copies(spark):
    """Batches of one partition that hold the same rows are blocks of their own."""
    docs = spark.range(0, 25_000, 1, 1).selectExpr("id AS doc_id", "repeat('0123456789', 30) AS text")
    got = repeats.find_repeats(docs).drop("doc_id").distinct().collect()
    assert [tuple(r) for r in got] == [(300, 300, 1, hashlib.sha256(b"").hexdigest(), [0, 300])]
    assert repeats.find_repeats(docs).count() == 25_000


def test_repeats_of_nothing(no_docs):
    assert repeats.find_repeats(no_docs).count() == 0
    with pytest.raises(ValueError):
        repeats.find_repeats(no_docs, 105)


BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def passes(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def plain_spans(text):
    return sorted((m.start(), n, m.end(), k) for n, (k, p) in enumerate(BASE) for m in re.finditer(p, text) if passes(k, m.group()))


TRICKY = ["a@b.c%d@e.f", "x@y", "a.b@c.d.e-f@g.h", "1.2.3.4.5.6.7.8", "0001.002.3.255", "256.1.1.1", "1..2.3.4", "+1+1 555 123 4567",
          "+123456789012345678", "4111-1111 1111-1111", "4111  1111", "é@ü.com a@b.com c@d.org", "++49 30 1234567)", "a" * 5000 + "@", "1" * 5000,
          "a@b.c" * 400, "1.1.1.1 " * 300, "😀 a@b.de 😀 1.2.3.4"]


def test_personal_data(spark, docs):
    rows = [(i, t) for i, t in enumerate(TRICKY)] + [(100 + i, r.text) for i, r in enumerate(docs.select("text").collect())]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = personal.label(table, personal.fit(table))
    for r in found.collect():
        assert [tuple(x) for x in r.base] == plain_spans(r.text or ""), r.text[:80]
        assert {tuple(x) for x in r.base} <= {tuple(x) for x in r.spans}
    masked = found.select("text", "spans", personal.redacted("text", "spans").alias("masked")).collect()
    assert all((r.masked == r.text) == (not r.spans) for r in masked if r.text is not None)
    assert next(r.masked for r in masked if r.text == TRICKY[-1]) == "😀 [EMAIL] 😀 [IP]"


def test_personal_data_native(docs):
    plan = personal.label(docs, personal.SpanClassifier([]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_long_secrets_are_one_span(spark):
    token = "aB3-_x.9+/" * 100
    rows = [(i, f"login token={token} end {i}") for i in range(20)] + [(20, "key secret=" + "7" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = personal.label(docs, personal.fit(docs)).withColumn("safe", personal.redacted("text", "spans")).where("doc_id < 20")
    assert sorted((r.doc_id, [(s.s, s.e, s.kind) for s in r.spans], r.safe) for r in got.collect()) == [
        (i, [(6, 1012, "secret")], f"login [SECRET] end {i}") for i in range(20)]


def test_labelers_are_weighed():
    """A labeler that contradicts the others is found unreliable."""
    rng = np.random.default_rng(0)
    counts = collections.Counter()
    for _ in range(4000):
        good = rng.random() < 0.5
        right = lambda p: (1 if good else -1) * (1 if rng.random() < p else -1)  # noqa: B023, E731
        counts[(5, (right(0.95), right(0.9), right(0.9), right(0.5)), 3)] += 1
    classifier = personal.SpanClassifier([(*k, n) for k, n in counts.items()])
    assert classifier.accuracy["shape"] > 0.9 and classifier.accuracy["edges"] < 0.6
    assert classifier.weights[len(personal.KINDS)] > 4 * abs(classifier.weights[len(personal.KINDS) + 3])


def test_personal_data_of_nothing(no_docs):
    assert personal.label(no_docs, personal.fit(no_docs)).count() == 0


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.public_vocabulary())
    rows = packing.pack(docs, packing.public_vocabulary()).collect()
    sequences = collections.defaultdict(list)
    pieces = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0
    for i, text in enumerate(texts[:-1]):  # the last one is there three times
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    assert sum(r.length for r in pieces[len(texts) - 1]) == 3 * pieces[len(texts) - 1][0].doc_tokens


@pytest.mark.parametrize("text", ["a<|endoftext|>b  c", "don't I'LL\x0b1234", "é ́x ß ﬁ", "tab\tnew\r\nline\n\n", "😀👍🏽 한국어 テスト"])
def test_words_are_encoded_as_texts(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.public_vocabulary()).encode(text, add_special_tokens=False).ids
    ids, at = packing.Encoder(packing.public_vocabulary())([text, ""])
    assert ids.tolist() == whole + [2, 2] and at.tolist() == [0, len(whole) + 1, len(whole) + 2]


def test_least_squares_uses_exact_sets():
    histogram = np.zeros(4097, int)
    histogram[[1000, 3096, 2048, 1024]] = [7, 9, 4, 4]
    sets = packing.combinations(np.flatnonzero(histogram)[::-1])
    used = dict(zip(sets, packing.repeats(sets, histogram), strict=True))
    assert used[(3096, 1000)] == 7
    used_up = 2 * used.get((2048, 2048), 0) + used.get((2048, 1024, 1024), 0)
    assert 2 <= used_up <= 4


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs, packing.public_vocabulary()).count() == 0


def test_packing_of_long_words_forgets_them(spark, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_CHARS", 1_000_000)
    encode = packing.Encoder(packing.public_vocabulary())
    blobs = ["ab" * 700_000 + str(i) for i in range(3)]
    for blob in blobs:
        ids, at = packing.encoded(encode, [(0, blob), (1, "a b")])
        assert encode.chars < 3_000_000 and ids[-1] == packing.END and at[-1] == len(ids) and len(at) == 3
    rows = packing.pack(spark.createDataFrame(list(enumerate(blobs)), "doc_id long, text string"), packing.public_vocabulary()).collect()
    for i, blob in enumerate(blobs):
        ids, _ = packing.Encoder(packing.public_vocabulary())([blob])
        pieces = sorted(r for r in rows if r["doc_id"] == i)
        assert sum(r["length"] for r in pieces) == len(ids) == pieces[0]["doc_tokens"]


def test_sample_hashes_widen_with_the_input():
    assert [repeats.sample_width(n) for n in (0, 10**9, 3 * 10**10, 10**12, 10**14)] == [5, 5, 5, 6, 7]


def test_words_encoded_together_equal_words_alone():
    encode = packing.Encoder(packing.public_vocabulary())
    words = ["a", "Größe,", "naïve", "<|startoftext|>", "x<|endoftext|>y", "\x1c", "e\u0301", "'s", "don't", "42nd", "京都", "😀", "", "a"]
    for some in (words, [w for w in words if w != "<|startoftext|>"] * 700, []):
        ids, counts = encode.code(some)
        alone = [e.ids for e in encode.tokenizer.encode_batch(some, add_special_tokens=False)]
        assert counts.tolist() == [len(a) for a in alone] and ids.tolist() == [i for a in alone for i in a]
    text = "a\x1cb  c\u00a0d\u2028e\nf\tg\x0bh\u3000i"
    ids, _ = encode([text])
    assert ids.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids + [packing.END]


def test_plain_words_do_not_pass_the_whole_tokenizer(monkeypatch):
    encode, asked = packing.Encoder(packing.public_vocabulary()), []
    whole = encode.code_whole
    monkeypatch.setattr(encode, "code_whole", lambda words: asked.extend(words) or whole(words))
    odd = ["İstanbul", "ΑΣ", "Ⱥb", "été", "x<|endoftext|>y", "a’s"]
    plain = ["Größe", "CAN'T", "we'LLs", "''s", "a1b22²", "_x_", "<|ENDOFTEXT|>", "Œuvre,", "the", "The", "\x85", "\x00\x7f"]
    texts = [" ".join(plain + odd), " \n", "", " ".join(plain), "a\x1cB \v c\x1dİ", *("".join(f"{chr(c)}A{chr(c)}1'{chr(c)} " for c in range(s, s + 64)) for s in range(0, 0x2100, 64))]
    ids, at = encode(texts)
    assert asked[:len(odd)] == odd and not any(all(ord(c) < 0x130 for c in w) and "<|endoftext|>" not in w for w in asked)
    for i, text in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids + [packing.END]
