import random

import pytest

CLASHING = "score double, spans string, n_words string, items string, node string, base string, lang_pred string, text_key string"


def sentence(rng, words, vocabulary="alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau".split()):
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "s", "en", "ing", "ed"]) for _ in range(words))


@pytest.fixture(scope="session")
def texts():
    """Copies, near copies, shared passages, empty and very long texts."""
    rng = random.Random(3)
    passage = sentence(rng, 70)
    base = [sentence(rng, rng.randint(3, 120)) for _ in range(40)]
    near = []
    for t in base[:12]:
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    long = sentence(rng, 12000)
    return [None, "", " \n", "!!!", "one", "one two", *base, *base[:6], *near, base[0] + ". " + passage, passage + " " + base[1],
            long, "x" * 30000, "Größe naïve ñandú " * 30, "mail a.b@c.example.org or +1 (555) 123-4567, 10.0.0.256 10.0.0.25 4111 1111 1111 1111"]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents, the last rows repeated, one id null, with columns named like results."""
    rows = [(i, t, "en" if i % 2 else None, "s", len(t or "")) for i, t in enumerate(texts)]
    rows += rows[-1:] * 2 + [(None, "one two three four five six", None, None, None)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c.split()[0]: F.lit("7").cast(c.split()[1]) for c in CLASHING.split(", ")})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
