"""Benchmark decontamination with an FM-index per training shard (operator 5).

A shard is a block of whole texts inside a Spark task. Words that no benchmark phrase has cannot be part of an
occurrence, so they end a run; runs shorter than the shortest phrase cannot hold one either. What is left, word numbers
with a separator after each run, is indexed: suffix order by doubling, the symbols before each suffix in a wavelet
matrix, and suffix positions sampled at every ``SAMPLE``-th place and at each run's start. All phrases of the benchmark
are searched backwards together, their occurrences located by walking to the next sampled position, and the covered
words merged to removal spans.

No shuffle: documents stay where they are read. Phrases travel with the task in passes of at most ``PASS_WORDS`` words;
a larger benchmark takes more passes, each adding to what the earlier ones hit. Phrases are taken from items on
the driver, pass by pass, so its memory has the same bound.

Defined cases: null and empty texts have no words, no hits and are not contaminated; an item without words has
no phrase; items of equal text both count; a null item id counts as the empty text; repeated rows are judged each on its own; an
empty benchmark hits nothing; input columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from rankloom.llm.common import query, table
from rankloom.llm.words import Block, Hasher, map_texts, word_bytes

WINDOW = 13
SAMPLE = 8
PASS_WORDS = 4_000_000
HITS = StructType([
    StructField("n_words", LongType()),
    StructField("hit_words", ArrayType(LongType())),  # start, end, start, end: word numbers, ends exclusive
    StructField("spans", ArrayType(LongType())),  # the same as code points of the text
    StructField("items", ArrayType(StringType())),
])


class Phrases:
    """The distinct windows of some items as word numbers, and the items of each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW) -> None:
        block = Block([text for _, text in items], word_bytes(), Hasher())
        self.vocabulary, numbers = np.unique(block.hashes(), return_inverse=True)
        self.item_ids = [i for i, _ in items]
        seen: dict[tuple, set[int]] = {}
        for item in range(len(items)):
            words = (numbers[block.first[item]:block.first[item + 1]] + 1).tolist()
            for at in range(max(1, len(words) - window + 1) if words else 0):
                seen.setdefault(tuple(words[at:at + window]), set()).add(item)
        self.lengths = np.array([len(p) for p in seen], np.int64)
        self.words = np.zeros((len(seen), window), np.int64)
        for row, phrase in zip(self.words, seen, strict=True):
            row[:len(phrase)] = phrase
        self.items = [sorted(x) for x in seen.values()]
        self.shortest = int(self.lengths.min()) if len(seen) else 0
        self.maybe = np.zeros(1 << 20, bool)  # a first sieve by 20 bits of the hash
        self.maybe[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers from 1, or 0 for words that no phrase has."""
        out = np.zeros(len(hashes), np.int64)
        if len(self.vocabulary):
            likely = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[likely]), len(self.vocabulary) - 1)
            same = self.vocabulary[at] == hashes[likely]
            out[likely[same]] = at[same] + 1
        return out


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; 0 is a separator, each smaller than the later ones and than all words."""
    n, stops = len(symbols), symbols == 0
    rank = np.where(stops, np.cumsum(stops) - 1, symbols + stops.sum())
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - width] = rank[width:] + 1
        key = rank * np.int64(2 * n + int(symbols.max()) + 2) + after
        order = np.argsort(key)
        in_order = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])])
        if rank[order[-1]] == n - 1 or width >= n:
            return order
        width *= 2


class FMIndex:
    def __init__(self, symbols: np.ndarray) -> None:
        n, order = len(symbols), suffix_order(symbols)
        self.n = n
        self.before = symbols[order - 1]  # of position 0 the last symbol, a separator
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=int(symbols.max()) + 2))])
        self.ones, self.zeros, self.base = [], [], np.zeros(len(self.less), np.int64)
        level = self.before
        values = np.arange(len(self.less))
        for bit in range(int(self.less.size).bit_length() - 1, -1, -1):
            set_here = (level >> bit) & 1
            ones = np.concatenate([[0], np.cumsum(set_here)])
            zeros = n - int(ones[-1])
            wanted = (values >> bit) & 1
            self.base = np.where(wanted == 1, zeros + ones[self.base], self.base - ones[self.base])
            self.ones.append(ones)
            self.zeros.append(zeros)
            level = np.concatenate([level[set_here == 0], level[set_here == 1]])
        starts = np.concatenate([[True], symbols[:-1] == 0])
        self.sampled = (starts | (np.arange(n) % SAMPLE == 0))[order]
        self.order = order

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands among the first ``at`` symbols before the suffixes."""
        top = len(self.ones) - 1
        for depth, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            up = ones[at]
            at = np.where((symbol >> (top - depth)) & 1 == 1, zeros + up, at - up)
        return at - self.base[symbol]

    def search(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that occur, and the range of suffixes that start with each."""
        live = np.arange(len(lengths))
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.n, np.int64)
        for step in range(int(lengths.max())):
            on = lengths[live] > step
            symbol = words[live[on], lengths[live[on]] - 1 - step]
            known = symbol < len(self.less) - 1
            symbol = np.where(known, symbol, 0)
            low[on] = np.where(known, self.less[symbol] + self.rank(symbol, low[on]), 0)
            high[on] = np.where(known, self.less[symbol] + self.rank(symbol, high[on]), 0)
            left = low < high
            live, low, high = live[left], low[left], high[left]
        return live, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: steps back until a sampled one."""
        rows, steps, at = rows.copy(), np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(at := at[~self.sampled[rows[at]]]):
            symbol = self.before[rows[at]]
            rows[at] = self.less[symbol] + self.rank(symbol, rows[at])
            steps[at] += 1
        return self.order[rows] + steps


def hits_in(block: Block, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starting word, length and phrase of every occurrence."""
    none = np.zeros(0, np.int64)
    numbers = phrases.numbers(block.hashes())
    if not phrases.shortest or not numbers.any():
        return none, none, none
    known = numbers > 0
    opens = known.copy()
    opens[1:] &= ~known[:-1]
    firsts = block.first[:-1][block.count > 0]
    opens[firsts] |= known[firsts]
    starts = np.flatnonzero(opens)
    lengths = np.diff(np.append(np.cumsum(known)[starts] - 1, known.sum()))
    starts, lengths = starts[lengths >= phrases.shortest], lengths[lengths >= phrases.shortest]
    if not len(starts):
        return none, none, none
    at = np.cumsum(lengths + 1) - lengths - 1  # of each run in the indexed text
    symbols, word = np.zeros(int((lengths + 1).sum()), np.int64), np.zeros(int((lengths + 1).sum()), np.int64)
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.repeat(at, lengths) + inside
    word[place] = np.repeat(starts, lengths) + inside
    symbols[place] = numbers[word[place]]
    index = FMIndex(symbols)
    found, low, high = index.search(phrases.words, phrases.lengths)
    if not len(found):
        return none, none, none
    times = high - low
    rows = np.repeat(low, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    which = np.repeat(found, times)
    return word[index.locate(rows)], phrases.lengths[which], which


def scanner(phrases: Phrases):
    """Function from texts, and what earlier passes hit, to the lists of ``HITS``."""
    hasher, member = Hasher(), word_bytes()

    def scan(texts: list[bytes]) -> tuple[list, list, list, list]:
        block = Block(texts, member, hasher)
        start, length, which = hits_in(block, phrases)
        cover = np.zeros(len(block.begin) + 1, np.int64)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + length, -1)
        # A text's last word never joins the next text's first one.
        hit = np.concatenate([[0], (np.cumsum(cover)[:-1] > 0).astype(np.int8), [0]])
        owner = block.owner()
        words: list[list[int]] = [[] for _ in texts]
        spans: list[list[int]] = [[] for _ in texts]
        items: list[list[str]] = [[] for _ in texts]
        for doc in np.unique(owner[start]) if len(start) else ():
            one = np.concatenate([[0], hit[1 + block.first[doc]:1 + block.first[doc + 1]], [0]])
            edges = np.flatnonzero(np.diff(one))
            words[doc] = edges.tolist()
            begin, end = block.begin[block.first[doc] + edges[::2]], block.end[block.first[doc] + edges[1::2] - 1]
            points = np.cumsum((block.raw[block.starts[doc]:block.starts[doc + 1]] & 0xC0) != 0x80)
            at = np.stack([begin, end], axis=1).ravel() - block.starts[doc]
            spans[doc] = np.where(at > 0, points[np.maximum(at - 1, 0)], 0).tolist()
        if len(start):
            pairs = np.unique(np.stack([owner[start], which], axis=1), axis=0)
            for doc, phrase in pairs.tolist():
                items[doc] += [phrases.item_ids[i] for i in phrases.items[phrase]]
        return block.count.tolist(), words, spans, [sorted(set(x)) for x in items]

    return scan


def passes(items: DataFrame, window: int) -> list[Phrases]:
    """The benchmark in lots of at most about ``PASS_WORDS`` words (by its bytes)."""
    texts = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lots = max(1, -(-held // (2 * PASS_WORDS)))
    for lot in range(lots):
        rows = texts.filter(F.pmod(F.xxhash64("id", "text"), F.lit(lots)) == lot).collect()
        yield Phrases(sorted((r["id"], r["text"].encode()) for r in rows), window)


def merged(a: str, b: str):
    """Union of two lists of [start, end) pairs in start order; touching pairs join."""
    pair = lambda c: F.expr(f"transform(sequence(0, size({c}) - 2, 2), i -> struct({c}[i] AS s, {c}[i + 1] AS e))")
    both = F.array_sort(F.concat(F.when(F.size(a) > 0, pair(a)).otherwise(F.array().cast("array<struct<s:bigint,e:bigint>>")),
                                 F.when(F.size(b) > 0, pair(b)).otherwise(F.array().cast("array<struct<s:bigint,e:bigint>>"))))
    return F.aggregate(both, F.array().cast("array<bigint>"), lambda out, p: F.when(
        (F.size(out) > 0) & (F.element_at(out, -1) >= p["s"]),
        F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.greatest(F.element_at(out, -1), p["e"]))),
    ).otherwise(F.concat(out, F.array(p["s"], p["e"]))))


def find_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, hit_words, spans (to remove) and items (ids whose phrases occur, sorted as text)."""
    out, again = docs, {"hit_words", "spans", "items"}
    for number, phrases in enumerate(passes(items, window)):
        if number:
            out = out.withColumnsRenamed({c: f"{c} so far" for c in again})
        out = map_texts(out, lambda p=phrases: scanner(p), HITS)
        if number:
            out = out.withColumns({
                "hit_words": merged("`hit_words`", "`hit_words so far`"), "spans": merged("`spans`", "`spans so far`"),
                "items": F.array_sort(F.array_union("items", "items so far")),
            }).drop(*[f"{c} so far" for c in again])
    return out


def hit_count(spans: str = "hit_words"):
    """Words in the merged spans: ends less starts."""
    return F.aggregate(spans, F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-1).alias("sign")), lambda a, x: F.struct(
        (a["sum"] + a["sign"] * x).alias("sum"), (-a["sign"]).alias("sign")), lambda a: a["sum"])


def judged(found: DataFrame) -> DataFrame:
    """``find_passages`` with n_hit, n_items, items_sha256 and contaminated: a twentieth of the words or more are hit."""
    return found.withColumn("n_hit", hit_count()).withColumns({
        "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join("items", ",").cast("binary"), 256),
        "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
    })


SQL5 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT item_id, len(w) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p, w FROM b WHERE len(w) > 0),
k AS (SELECT DISTINCT item_id, least(n, 13) AS m, w[p:p + least(n, 13) - 1] AS phrase FROM i),
sizes AS (SELECT DISTINCT m FROM k),
s AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS p, w FROM d, sizes WHERE len(w) >= m),
f AS (SELECT s.doc_id, k.item_id, s.p, s.m FROM s JOIN k ON k.m = s.m AND k.phrase = s.w[s.p:s.p + s.m - 1]),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM f) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM f) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)
"""


@query("op5_decontaminate", SQL5)
def op5(spark, sf_dir):
    """Every document judged against all phrases of the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, table(spark, sf_dir, "benchmark"))
    return judged(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
