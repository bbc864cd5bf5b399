import itertools
import random
import re

import pytest

from rankloom.llm import filter_audit
from rankloom.llm.filter_audit import audit, mask_cells

DOCS = "doc_id long, text string, lang string, source string, n_chars long, mask string, part string, digest string"


def doc_rows():
    rng = random.Random(11)
    texts = [None, "", " \t\n", "ONE TWO", "a # b", "\x0b".join(f"w{i}" for i in range(200)), " ".join(["same"] * 300), "Ü" * 50 + "AB",
             " ".join(f"w{i % 99}" for i in range(199)), " ".join(f"w{i % 100}" for i in range(200)), "x y " * 150, "Y" + "n" * 33 + "é", "long | " * 20_000]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(300)]
    rows += [(1000 + i, "one hot text", "en") for i in range(150)] + rows[-1:] * 3 + [(None, "one hot text", "en"), (None, None, None)]
    rows += [(999, "one hot text", "fr")] * 2
    return rows


def label_rows():
    rng = random.Random(12)
    return [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 300, 2), 1001, 1001, 999, None, 5000]]


def brute(rows, labels):
    texts = [t or "" for _, t, _ in rows]
    first = {}
    for (doc, _, _), text in zip(rows, texts, strict=True):
        if doc is not None:
            first[text] = min(doc, first.get(text, doc))
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    judged = []
    for (doc, _, lang), text in zip(rows, texts, strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "".join(c for c, f in zip("ABCDE", [
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            bool(re.search(r"[#$%&*|]", text)), doc is not None and doc > first[text]], strict=True) if f)
        judged.append((lang or "", fails, doc in good, doc in toxic))
    out = {}
    for part in {j[0] for j in judged}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = [j for j in judged if j[0] == part]
            for step, letter in enumerate(order, 1):
                gone = [j for j in alive if letter in j[1]]
                alive = [j for j in alive if letter not in j[1]]
                failing = [j for j in judged if j[0] == part and letter in j[1]]
                out[part, order, step] = [len(alive), len(gone), len(failing) - len(gone), sum(j[1] == letter for j in failing),
                                          sum(j[2] for j in gone), sum(j[3] for j in gone)]
                shapley[letter] += len(gone)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def frames(spark):
    docs = spark.createDataFrame([(*r, None, None, "m", "p", "d") for r in doc_rows()], DOCS).repartition(4)
    labels = spark.createDataFrame([(*r, "x") for r in label_rows()], "doc_id long, quality int, toxic int, mask string")
    return docs, labels


def test_audit_equals_brute_force(frames):
    found = {tuple(r)[:3]: tuple(r)[3:] for r in audit(mask_cells(*frames), "ABCDE").collect()}
    assert found == brute(doc_rows(), label_rows())


def test_nothing_to_audit(frames):
    docs, labels = frames
    assert audit(mask_cells(docs.limit(0), labels), "ABCDE").count() == 0
    assert mask_cells(docs, labels.limit(0)).selectExpr("sum(docs)", "sum(good)", "sum(toxic)").first() == (len(doc_rows()), 0, 0)


def test_three_filters_and_too_many(spark, frames):
    cells = spark.createDataFrame([("p", 0b011, 4, 1, 0), ("p", 0b100, 2, 0, 2), ("q", 0, 3, 0, 0)], "part string, mask int, docs long, good long, toxic long")
    rows = {tuple(r)[:3]: tuple(r)[3:] for r in audit(cells, "ABC").collect()}
    assert len(rows) == 2 * 6 * 3
    assert rows["p", "ABC", 1] == (2, 4, 0, 0, 1, 0, 12) and rows["p", "ABC", 2] == (2, 0, 4, 0, 0, 0, 12)
    assert rows["p", "CBA", 1] == (4, 2, 0, 2, 0, 2, 12) and rows["q", "BAC", 3] == (3, 0, 0, 0, 0, 0, 0)
    with pytest.raises(ValueError):
        filter_audit.step_metrics(cells, "ABCDEFG")
