"""Toxic spans by a linear-chain conditional random field (operator 6).

A token is a run of letters or digits, a sequence the tokens up to a sentence end or line break, of any length. Features of
a token are its word and its first 3 to 8 bytes if it is longer, hashed to ``BUCKETS`` weights. Labels mark whole documents, so token
labels come first: on the fitting rows, features are picked greedily that are nearly pure to toxic documents and
explain those no earlier pick explains, then all that are purer still and not rare; tokens of toxic documents that have a picked feature are toxic. The field is then
fitted to these sequences by gradient steps on its likelihood, whose expectations come from forward-backward.

With two states both passes need only the log ratio of the states, so all sequences of a block advance together. A
document's score is a logistic function, fitted on the same rows, of its highest token marginal and of the marginals'
sum; its spans are the maximal
runs of tokens with a marginal of one half or more.

Fitting takes at most about ``FIT_ROWS`` labelled rows of each class, chosen by a hash of the id, and runs in one task;
scoring covers all rows where they are read, without a shuffle.

Defined cases: null and empty texts and texts without tokens get the lowest score; a null label is no label; a document
with several labels counts as toxic if one says so; repeated rows are scored alike; without labels of both classes every
score is the share of toxic ones (0 without any); columns named like a result are replaced.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from rankloom.llm.common import fold, give_back, query, table
from rankloom.llm.words import Block, Hasher, map_texts, mixed, word_bytes

FIT_ROWS = 2000
BUCKETS = 1 << 20
PREFIXES = (3, 4, 5, 6, 7, 8)
EPOCHS = 5
PURE, SURE = 0.6, 0.9
THRESHOLD = 0.3
SCORED = StructType([StructField("score", DoubleType()), StructField("spans", ArrayType(LongType()))])
#: Bytes that end a sequence: . ! ? line feed, and the zero byte between texts.
ENDS = np.isin(np.arange(256), [0, 10, 33, 46, 63])


def features(block: Block) -> np.ndarray:
    """Bucket of each feature of each token, one column per kind; a prefix that isn't shorter than the word is bucket 0."""
    columns = [block.hashes()]
    for size in PREFIXES:
        end = np.minimum(block.begin + size, block.end)
        prefix = block.hasher.of(block.sums, block.begin, end)
        columns.append(np.where(block.end - block.begin > size, mixed(prefix + np.uint64(size)), np.uint64(0)))
    return np.stack([(c % np.uint64(BUCKETS)).astype(np.int32) for c in columns], axis=1)


def sequences(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """First token and length of each sequence."""
    if not len(block.begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    stops = np.cumsum(ENDS[block.data])
    opens = np.flatnonzero(np.concatenate([[True], stops[block.begin[1:]] != stops[block.end[:-1] - 1]]))
    return opens, np.diff(np.append(opens, len(block.begin)))


def log_ratio(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log((e^t01 + e^(x + t11)) / (e^t00 + e^(x + t10))): the message along an edge."""
    return np.logaddexp(t[0, 1], x + t[1, 1]) - np.logaddexp(t[0, 0], x + t[1, 0])


def forward_backward(unary: np.ndarray, opens: np.ndarray, lengths: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of each token's toxic state from its left with itself, and from its right; their sum is the marginal's."""
    left, right = unary.copy(), np.zeros(len(unary))
    order = np.argsort(-lengths, kind="stable")
    opens, lengths = opens[order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    live = np.searchsorted(-lengths, -np.arange(longest + 1), "left")  # sequences longer than each step
    for step in range(1, longest):
        at = opens[:live[step]] + step
        left[at] += log_ratio(left[at - 1], t)
    for step in range(longest - 2, -1, -1):
        at = opens[:live[step + 1]] + step
        right[at] = log_ratio(unary[at + 1] + right[at + 1], t.T)
    return left, right


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def token_labels(kinds: np.ndarray, doc: np.ndarray, toxic: np.ndarray, clean_weight: float) -> np.ndarray:
    """Tokens of toxic documents that have one of the picked features."""
    clean, docs, buckets = np.zeros(BUCKETS), [], []
    for column in kinds.T:  # one kind at a time: pairs of document and bucket are many times the tokens
        pairs = np.unique(doc.astype(np.int64) * BUCKETS + column)
        of_toxic = toxic[pairs // BUCKETS] == 1
        clean += clean_weight * np.bincount(pairs[~of_toxic] % BUCKETS, minlength=BUCKETS)
        docs.append((pairs[of_toxic] // BUCKETS).astype(np.int32))
        buckets.append((pairs[of_toxic] % BUCKETS).astype(np.int32))
    docs, buckets = np.concatenate(docs), np.concatenate(buckets)
    every = np.bincount(buckets, minlength=BUCKETS)
    pure = (every + 0.5) / (every + clean + 1.0)
    pure[0] = 0.0
    few = min(3, max(1, int(toxic.sum()) // 20))
    keep = (pure[buckets] >= PURE) & (every[buckets] >= few)
    docs, buckets = docs[keep], buckets[keep]
    picked = (pure >= SURE) & (every >= max(few, 0.02 * toxic.sum()))
    sure, picked = picked, np.zeros(BUCKETS, bool)
    while len(docs):
        gain = np.bincount(buckets, minlength=BUCKETS) - 2 * clean  # what it explains, less twice what it would accuse
        best = int(gain.argmax())
        if gain[best] < few:
            break
        picked[best] = True
        open_docs = np.ones(len(toxic), bool)
        open_docs[docs[buckets == best]] = False
        docs, buckets = docs[open_docs[docs]], buckets[open_docs[docs]]
    return (picked | sure)[kinds].any(axis=1) & (toxic[doc] == 1)


class Field:
    """Weights of the field: a bias and a weight per bucket for the toxic state, and the transitions."""

    def __init__(self) -> None:
        self.weights, self.bias, self.t = np.zeros(BUCKETS, np.float32), 0.0, np.zeros((2, 2))
        self.final = np.zeros(3)

    def unary(self, kinds: np.ndarray) -> np.ndarray:
        return self.bias + self.weights[kinds].sum(axis=1, dtype=np.float64)

    def fit(self, blocks: list[tuple], seen: np.ndarray) -> None:
        """Adaptive gradient steps, a block at a time; ``blocks`` has (kinds, opens, lengths, labels)."""
        power, rest = np.full(BUCKETS, 1e-2), np.full(5, 1e-2)
        for epoch in range(EPOCHS):
            for kinds, opens, lengths, labels in blocks:
                left, right = forward_backward(self.unary(kinds), opens, lengths, self.t)
                p = logistic(left + right)
                gap = labels - p
                grad = sum(np.bincount(c, gap, minlength=BUCKETS) for c in kinds.T) - 1e-3 * self.weights
                grad[~seen] = 0.0
                inner = np.ones(len(p), bool)
                inner[opens] = False
                a, b = np.flatnonzero(inner) - 1, np.flatnonzero(inner)
                # Of an edge, the log weights of its four state pairs, less their sum: expected counts of transitions.
                edge = np.stack([self.t[0, 0] + 0 * b, self.t[0, 1] + self.unary(kinds[b]) + right[b],
                                 self.t[1, 0] + left[a], self.t[1, 1] + left[a] + self.unary(kinds[b]) + right[b]], axis=1)
                edge = np.exp(edge - edge.max(axis=1, keepdims=True))
                edge /= edge.sum(axis=1, keepdims=True)
                real = np.bincount((2 * labels[a] + labels[b]).astype(int), minlength=4)
                other = np.append(real - edge.sum(axis=0), gap.sum())
                power += np.square(grad)
                rest += np.square(other)
                self.weights += (0.5 * grad / np.sqrt(power)).astype(np.float32)
                step = 0.2 * other / np.sqrt(rest)
                self.t += step[:4].reshape(2, 2)
                self.bias += step[4]

    def marginals(self, block: Block) -> np.ndarray:
        """Log odds of each token."""
        left, right = forward_backward(self.unary(features(block)), *sequences(block), self.t)
        return left + right


def summary(odds: np.ndarray, block: Block) -> np.ndarray:
    """Of each text the highest log odds, the log of the expected number of toxic tokens, and 1; -20 and -7 without tokens."""
    out = np.tile([-20.0, -7.0, 1.0], (len(block.count), 1))
    some = np.flatnonzero(block.count)
    if len(some):
        p = logistic(odds)
        out[some, 0] = np.clip(np.maximum.reduceat(odds, block.first[some]), -20.0, 20.0)
        out[some, 1] = np.log(1e-3 + np.add.reduceat(np.where(p >= 0.05, p, 0.0), block.first[some]))
    return out


def calibrate(design: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic function of ``summary``, by Newton steps with a light pull to (0.5, 0, 0)."""
    start, pull = np.array([0.5, 0.0, 0.0]), np.diag([1.0, 1.0, 1e-3])
    w = start
    for _ in range(30):
        p = logistic(design @ w)
        grad = design.T @ (weight * (y - p)) - pull @ (w - start)
        w = w + np.linalg.solve((design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + pull, grad)
    return w


def fitted(texts: list[bytes], toxic: np.ndarray, clean_weight: float = 1.0) -> Field:
    """A field fitted to documents with labels 0 and 1; a clean one stands for ``clean_weight`` of them."""
    field, hasher, member, size = Field(), Hasher(), word_bytes(), 200
    blocks, docs, at = [], [], 0
    for start in range(0, len(texts), size):
        block = Block(texts[start:start + size], member, hasher)
        blocks.append((features(block), *sequences(block)))
        docs.append((block.owner() + start).astype(np.int32))
    if not toxic.any() or toxic.all():
        share = min(max(float(toxic.mean()) if len(toxic) else 0.0, 1e-9), 1 - 1e-9)
        field.final[2] = np.log(share / (1 - share))
        return field
    kinds = np.concatenate([b[0] for b in blocks])
    labels = token_labels(kinds, np.concatenate(docs), toxic, clean_weight).astype(float)
    seen = np.bincount(kinds.ravel(), minlength=BUCKETS) >= 2
    seen[0] = False
    ready = []
    del kinds
    for kinds, opens, lengths in blocks:
        ready.append((kinds, opens, lengths, labels[at:at + len(kinds)]))
        at += len(kinds)
    field.fit(ready, seen)
    design = []
    for start in range(0, len(texts), size):
        block = Block(texts[start:start + size], member, hasher)
        design.append(summary(field.marginals(block), block))
    design = np.concatenate(design)
    field.final = calibrate(design, toxic.astype(float), np.where(toxic == 1, 1.0, clean_weight))
    return field


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Field:
    """Fitted on the documents that are not held out and have a label, at most about ``rows`` of each class."""
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold() != 2)).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    share = {r["toxic"]: min(1.0, rows / r["count"]) for r in marked.groupBy("toxic").count().collect()}
    chance = (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) / float(1 << 20))
    wanted = F.coalesce(*[F.when(F.col("toxic") == k, F.lit(v)) for k, v in share.items()], F.lit(0.0))
    chosen = marked.filter(chance < wanted)  # at most about 2 x rows, so small enough to send to every task
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min("text").alias("text")).select("toxic", "text")
    weight = share.get(1, 1.0) / share.get(0, 1.0)

    def train(frames):
        unique = {t: int(y) for frame in frames for t, y in zip(frame["text"], frame["toxic"], strict=True)}
        rows = sorted(unique.items())
        field = fitted([t.encode() for t, _ in rows], np.array([y for _, y in rows], np.int64), weight)
        yield pd.DataFrame({"field": [pickle.dumps(vars(field))]})
        give_back()

    field = Field()
    trained = found.coalesce(1).mapInPandas(train, "field binary").collect()  # a bounded sample: one task
    vars(field).update(pickle.loads(trained[0]["field"]) if trained else vars(fitted([], np.zeros(0, np.int64))))
    return field


def scorer(field: Field):
    hasher, member = Hasher(), word_bytes()

    def score(texts: list[bytes]) -> tuple[list, list]:
        block = Block(texts, member, hasher)
        odds = field.marginals(block)
        scores = logistic(summary(odds, block) @ field.final)
        spans: list[list[int]] = [[] for _ in texts]
        hot = odds >= 0.0
        for doc in np.unique(block.owner()[hot]):
            low, high = block.first[doc], block.first[doc + 1]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], hot[low:high].astype(np.int8), [0]])))
            at = np.stack([block.begin[low + edges[::2]], block.end[low + edges[1::2] - 1]], axis=1).ravel() - block.starts[doc]
            points = np.concatenate([[0], np.cumsum((block.raw[block.starts[doc]:block.starts[doc + 1]] & 0xC0) != 0x80)])
            spans[doc] = points[at].tolist()
        return scores.tolist(), spans

    return score


def score_toxicity(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with score and spans (code points: start, end, start, end)."""
    return map_texts(docs, lambda: scorer(field), SCORED)


@query("op6_toxicity")
def op6(spark, sf_dir):
    """Every document scored by a field fitted on the labelled ones outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold() == 2).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
