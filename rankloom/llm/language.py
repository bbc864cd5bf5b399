"""Language of mixed text: scripts narrow the candidates, Viterbi labels the words (operator 4).

Learning counts, per language of the learning rows, hashed byte trigrams of words (word edges included) and letters per
script, over all of them: tasks emit counts per batch, Spark adds them up. The model has ``BUCKETS`` numbers per
language, whatever the corpus size. A word's score in a language is the sum of its trigrams' log probabilities; languages
that were not seen in the word's script are ruled out, unless that rules out all. Viterbi then finds the cheapest
labelling of a text's words when each change of language costs ``SWITCH``. The text's language is the one with the most
letters (bytes); its score is that share of the letters times the probability that the words' summed scores give the
language.

Learning shuffles only counts; prediction runs where the texts are read.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every text if nothing was learned;
null and empty languages teach nothing; repeated rows count as often as they stand; equal scores go to the language first
by name; words are runs of ASCII letters and non-ASCII characters; columns named like a result are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from rankloom.llm.common import by_size, fold, query, table
from rankloom.llm.words import BLOCK, Block, Hasher, map_texts, word_bytes

BUCKETS = 1 << 16
SWITCH = 12.0
UNKNOWN = "und"
#: First code point of each script's range; the number of a script is its place here. Fixed values of the standard.
SCRIPTS = np.array([
    0x0000,  # Latin
    0x0370,  # Greek
    0x0400,  # Cyrillic
    0x0530,  # Armenian
    0x0590,  # Hebrew
    0x0600,  # Arabic
    0x0900,  # scripts of India
    0x0E00,  # Thai and neighbours
    0x10A0,  # Georgian
    0x1100,  # Hangul parts
    0x1200,  # Ethiopic and others
    0x1E00,  # Latin with marks
    0x1F00,  # Greek with marks
    0x2000,  # signs
    0x2E80,  # Han parts
    0x3040,  # Kana
    0x3100,  # Han
    0xAC00,  # Hangul
    0xD7B0,  # others
])
SAME_SCRIPT = {11: 0, 12: 1, 9: 17, 14: 16}
#: A language is a candidate for a script if this share of its letters was in it.
SEEN_SHARE = 1e-4
PREDICTED = StructType([
    StructField("lang_pred", StringType()), StructField("score", DoubleType()),
    StructField("span_ends", ArrayType(LongType())), StructField("span_langs", ArrayType(StringType())),
])


def word_scripts(block: Block) -> np.ndarray:
    """Script number of each word: the highest among its characters, so any non-Latin letter decides."""
    data = block.data
    out = np.zeros(len(data), np.int8)
    heads = np.flatnonzero(data >= 0xC2)
    if len(heads):
        first = data[heads].astype(np.int64)
        follow = [np.where(heads + i < len(data), data[np.minimum(heads + i, len(data) - 1)], 0).astype(np.int64) & 63 for i in (1, 2)]
        point = np.where(first < 0xE0, ((first & 31) << 6) | follow[0],
                         np.where(first < 0xF0, ((first & 15) << 12) | (follow[0] << 6) | follow[1], 0x2000))
        number = np.searchsorted(SCRIPTS, point, "right") - 1
        for a, b in SAME_SCRIPT.items():
            number[number == a] = b
        number[number == 13] = 0  # signs belong to no script
        out[heads] = number
    return np.maximum.reduceat(out, block.begin) if len(block.begin) else np.zeros(0, np.int8)


def trigrams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each trigram in word order, and how many each word has: one per byte and one for its end."""
    letter = np.where(word_bytes(digits=False)[block.data], block.data, 0).astype(np.int64)
    code = letter.copy()
    code[1:] += letter[:-1] << 8
    code[2:] += np.where(letter[1:-1] > 0, letter[:-2], 0) << 16
    size = block.end - block.begin + 1
    place = np.repeat(block.begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    return ((code[place] * 0x9E3779B1 + 0x7F4A7C15) >> 13) % BUCKETS, size


def summed(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of rows; every stretch has one row at least."""
    return np.add.reduceat(values, np.cumsum(size) - size, axis=0)


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray) -> None:
        self.langs = langs
        self.logp = np.log((counts + 0.1) / (counts.sum(axis=1, keepdims=True) + 0.1 * BUCKETS)).T.astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        allowed = share.T >= SEEN_SHARE
        self.allowed = np.where(allowed.any(axis=1, keepdims=True), allowed, True)

    def word_scores(self, block: Block) -> np.ndarray:
        """Words by languages; ruled-out languages far below the others."""
        buckets, size = trigrams(block)
        scores = summed(self.logp[buckets], size).astype(np.float64)
        return np.where(self.allowed[word_scripts(block)], scores, scores.min(axis=1, keepdims=True) - 1e3)


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of each word; ``first`` has each text's first word, then the number of words. Texts go in step."""
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    opens, count = first[:-1][order], count[order]
    longest = int(count[0]) if len(count) else 0
    live = np.searchsorted(-count, -np.arange(longest + 1), "left")
    best = scores.copy()
    came = np.zeros(len(scores), np.int16)  # the language to come from on a change
    stays = np.ones(scores.shape, bool)
    for step in range(1, longest):
        at = opens[:live[step]] + step
        before = best[at - 1]
        top = before.argmax(axis=1)
        change = before[np.arange(len(at)), top][:, None] - switch
        came[at], stays[at] = top, before >= change
        best[at] += np.maximum(before, change)
    path = np.zeros(len(scores), np.int16)
    some = np.flatnonzero(count)
    last = opens[some] + count[some] - 1
    path[last] = best[last].argmax(axis=1)
    for step in range(longest - 2, -1, -1):
        at = opens[:live[step + 1]] + step
        after = path[at + 1]
        path[at] = np.where(stays[at + 1, after], after, came[at + 1])
    return path


def learn(docs: DataFrame) -> Model:
    """A model of (text, lang) rows."""
    kinds = StructType([StructField("lang", StringType()), StructField("kind", LongType()), StructField("n", LongType())])

    def count(batches):
        hasher, member = Hasher(), word_bytes(digits=False)
        for batch in batches:
            rows = [(t or b"", name) for t, name in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            total: dict[str, np.ndarray] = {}
            for part in by_size(sorted(rows, key=lambda r: r[1]), lambda r: len(r[0]), BLOCK):
                for lang in sorted({r[1] for r in part}):
                    block = Block([t for t, name in part if name == lang], member, hasher)
                    held = total.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                    held[:BUCKETS] += np.bincount(trigrams(block)[0], minlength=BUCKETS)
                    held[BUCKETS:] += np.bincount(word_scripts(block), block.end - block.begin, len(SCRIPTS)).astype(np.int64)
            for lang, held in total.items():
                some = np.flatnonzero(held)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(some, pa.int64()), pa.array(held[some])],
                                                 names=kinds.names)

    rows = docs.filter(F.col("text").isNotNull() & (F.coalesce(F.col("lang"), F.lit("")) != "")).select(
        F.col("text").cast("string"), F.col("lang").cast("string"))
    found = rows.mapInArrow(count, kinds).groupBy("lang", "kind").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS + len(SCRIPTS)))
    if langs:
        counts[pd.Categorical(found["lang"], langs).codes, found["kind"]] = found["n"]
    return Model(langs, counts[:, :BUCKETS], counts[:, BUCKETS:])


def predictor(model: Model):
    hasher, member = Hasher(), word_bytes(digits=False)
    langs = np.array(model.langs, object)

    def predict(texts: list[bytes]) -> tuple[list, list, list, list]:
        n = len(texts)
        pred, score = [UNKNOWN] * n, [0.0] * n
        ends: list[list[int]] = [[] for _ in texts]
        names: list[list[str]] = [[] for _ in texts]
        block = Block(texts, member, hasher)
        if not len(block.begin) or not len(langs):
            return pred, score, ends, names
        scores = model.word_scores(block)
        path = viterbi(scores, block.first)
        owner, letters = block.owner(), block.end - block.begin
        share = np.bincount(owner * len(langs) + path, letters, n * len(langs)).reshape(n, len(langs))
        some = np.flatnonzero(block.count)
        total = np.full((n, len(langs)), 0.0)
        total[some] = np.add.reduceat(scores, block.first[some], axis=0)
        best = share.argmax(axis=1)
        part = share[np.arange(n), best] / np.maximum(share.sum(axis=1), 1)
        prob = 1.0 / np.exp(np.clip(total - total[np.arange(n), best][:, None], -700, 700)).sum(axis=1)
        change = np.flatnonzero(np.append((path[1:] != path[:-1]) | (owner[1:] != owner[:-1]), True))
        for doc in some:
            if has_letter(texts[doc]):
                pred[doc], score[doc] = str(langs[best[doc]]), float(part[doc] * min(prob[doc], 1.0))
        points = np.cumsum((block.raw & 0xC0) != 0x80)
        for word in change:
            doc = owner[word]
            base = points[block.starts[doc] - 1] if block.starts[doc] else 0
            ends[doc].append(int(points[block.end[word] - 1] - base))
            names[doc].append(str(langs[path[word]]))
        return pred, score, ends, names

    return predict


ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    """ASCII first, so that only texts without one are decoded."""
    return bool(ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score, and the spans of one language: span_ends (code points) and span_langs."""
    return map_texts(docs, lambda: predictor(model), PREDICTED)


@query("op4_language_id")
def op4(spark, sf_dir):
    """Every document's language, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.filter(fold() != 2).select("text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", (fold() == 2).alias("held_out"), "lang_pred", "score")
