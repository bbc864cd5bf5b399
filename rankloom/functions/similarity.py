"""Similarity of names by insertions and deletions, over whole Arrow batches at once.

The share two texts have in common is 2 * (longest common subsequence) / (total length). The subsequence is found bit by
bit, one lane per pair: a machine word holds 64 positions of the left text, and each step takes the next character of
all right texts of the batch. Longer texts take several words, with the carry handed on. Texts of unequal length are also
compared window by window, each window a lane.

``weighted_score`` puts them together as name matchers usually do: plain, words sorted, words as sets, and best windows
where one name is at least half as long again as the other, each with its usual discount.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions.strings import strip

#: Entries of the table of letter masks and windows that one step holds.
CELLS = 2_000_000
# The discounts of sorted and set forms and of windows, and the length ratios at which windows are used.
WORDS, WINDOW, FAR_WINDOW, UNEQUAL, FAR = 0.95, 0.9, 0.6, 1.5, 8.0


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one row each, -1 behind the end; and the lengths."""
    size = np.array([len(t) for t in texts], np.int64)
    wide = np.full((len(texts), max(1, int(size.max(initial=0)))), -1, np.int32)
    wide[np.arange(wide.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    return wide, size


def common_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair."""
    a, size_a = _codes(left)
    b, _ = _codes(right)
    letters, at = np.unique(np.concatenate([a.ravel(), b.ravel()]), return_inverse=True)
    at_a, at_b = at[:a.size].reshape(a.shape), at[a.size:].reshape(b.shape)
    words, lanes = (a.shape[1] + 63) // 64, np.arange(len(left))
    masks = np.zeros((words, len(left), len(letters)), np.uint64)
    for i in range(a.shape[1]):
        masks[i // 64, lanes, at_a[:, i]] |= np.uint64(1) << np.uint64(i % 64)
    masks[:, :, letters == -1] = 0
    rows = np.full((words, len(left)), np.iinfo(np.uint64).max, np.uint64)
    for j in range(b.shape[1]):
        carry = np.zeros(len(left), np.uint64)
        for w in range(words):
            row = rows[w]
            hit = row & masks[w, lanes, at_b[:, j]]
            total = row + hit
            over = total < row
            full = total + carry
            carry = (over | (full < total)).astype(np.uint64)
            rows[w] = full | (row - hit)
    bits = np.arange(a.shape[1])
    taken = np.zeros(len(left), np.int64)
    for w in range(words):
        inside = np.clip(size_a - 64 * w, 0, 64)
        mask = np.where(inside == 64, np.iinfo(np.uint64).max, (np.uint64(1) << (inside % 64).astype(np.uint64)) - np.uint64(1))
        taken += np.bitwise_count(~rows[w] & mask).astype(np.int64)
    return taken if len(bits) else np.zeros(len(left), np.int64)


def ratios(left: list[str], right: list[str]) -> np.ndarray:
    """2 * common subsequence / total length of each pair; 1 for two empty texts."""
    out = np.ones(len(left))
    total = np.array([len(x) + len(y) for x, y in zip(left, right, strict=True)], np.int64)
    # Pairs of like length share a step, so that one long text does not widen the tables of all.
    order = np.argsort([max(len(x), len(y)) for x, y in zip(left, right, strict=True)], kind="stable")
    start = 0
    while start < len(order):
        longest = max(1, max(len(left[order[start]]), len(right[order[start]])))
        stop = min(len(order), start + max(1, CELLS // (64 * ((longest + 63) // 64))))
        pick = order[start:stop]
        out[pick] = 2.0 * common_lengths([left[i] for i in pick], [right[i] for i in pick])
        start = stop
    return np.where(total > 0, out / np.maximum(total, 1), 1.0)


def windows(shorter: str, longer: str) -> list[str]:
    """Stretches of the longer text that the shorter may lie on: as long as it, less at both ends."""
    m, n = len(shorter), len(longer)
    return [longer[max(0, at):at + m] for at in range(1 - m, n)] if m else [""]


def partial_ratios(left: list[str], right: list[str]) -> np.ndarray:
    """Best ratio of the shorter text with a window of the longer; 1 for two empty texts, 0 if one is empty."""
    out = np.zeros(len(left))
    held: list[tuple[int, str, str]] = []

    def settle() -> None:
        if held:
            at, x, y = (list(c) for c in zip(*held, strict=True))
            np.maximum.at(out, np.array(at), ratios(x, y))
            held.clear()

    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        pairs = [(x, y)] if len(x) < len(y) else [(y, x)] if len(y) < len(x) else [(x, y), (y, x)]
        if not x or not y:
            out[i] = float(not x and not y)
            continue
        for short, long in pairs:
            held += [(i, short, w) for w in dict.fromkeys(windows(short, long))]
        if len(held) > CELLS // 64:
            settle()
    settle()
    return out


def _over_known(fn):
    """A function of two lists of texts as one of two columns; a missing side gives a missing result."""
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known = (a.notna() & b.notna()).to_numpy()
        out = np.full(len(a), np.nan)
        if known.any():
            out[known] = fn(a[known].tolist(), b[known].tolist())
        return pd.Series(out).astype(object).where(known, None)
    return run


def ratio(a: Column, b: Column) -> Column:
    """2 * common subsequence / total length, from 0 to 1."""
    return F.pandas_udf(_over_known(ratios), T.DoubleType())(a, b)


def partial_ratio(a: Column, b: Column) -> Column:
    """Best ratio of the shorter text within the longer."""
    return F.pandas_udf(_over_known(partial_ratios), T.DoubleType())(a, b)


def words(name: Column) -> Column:
    """Words between blanks, sorted (case is kept)."""
    return F.array_sort(F.filter(F.split(strip(F.regexp_replace(name, r"\s+", " ")), " "), lambda w: w != ""))


def word_forms(a: Column, b: Column) -> dict[str, Column]:
    """Texts that the forms of the score compare: both sides sorted, what they share, and both with it in front."""
    left, right = words(a), words(b)
    both = F.array_sort(F.array_intersect(left, right))
    only = [F.array_sort(F.array_except(x, y)) for x, y in ((left, right), (right, left))]
    text = [F.array_join(x, " ") for x in (left, right, both, *only)]
    front = F.when(text[2] == "", "").otherwise(F.concat(text[2], F.lit(" ")))
    return {"sorted_a": text[0], "sorted_b": text[1], "both": text[2], "only_a": text[3], "only_b": text[4],
            "with_a": F.trim(F.concat(front, text[3])), "with_b": F.trim(F.concat(front, text[4]))}


def weighted_score(a: Column, b: Column) -> Column:
    """Similarity of two names from 0 to 1 by the best of their discounted forms; 0 if a name is empty."""
    form = word_forms(a, b)
    shorter, longer = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    near, some = longer < shorter * UNEQUAL, shorter > 0
    shared = form["both"] != ""

    def where(test: Column, x: Column, y: Column, fn=ratio) -> Column:
        """The form's ratio where it counts; elsewhere the function gets nothing to do."""
        return F.coalesce(fn(F.when(test, x), F.when(test, y)), F.lit(0.0))

    # One side's words all in the other's: the shared words are that side, a full match.
    inside = shared & ((form["only_a"] == "") | (form["only_b"] == ""))
    as_set = F.greatest(where(some & near, form["with_a"], form["with_b"]), where(some & near & shared, form["both"], form["with_a"]),
                        where(some & near & shared, form["both"], form["with_b"]), F.when(inside, 1.0).otherwise(0.0))
    as_words = F.greatest(where(some & near, form["sorted_a"], form["sorted_b"]), as_set) * WORDS
    scale = F.when(longer <= shorter * FAR, WINDOW).otherwise(FAR_WINDOW)
    far = some & ~near
    part_words = F.greatest(where(far & ~shared, form["sorted_a"], form["sorted_b"], partial_ratio), F.when(shared, 1.0).otherwise(0.0)) * WORDS
    parts = F.greatest(where(far, a, b, partial_ratio), part_words) * scale
    found = F.greatest(where(some, a, b), F.when(near, as_words).otherwise(parts))
    return F.when(a.isNull() | b.isNull(), None).when(a == b, F.when(F.length(a) > 0, 1.0).otherwise(0.0)).when(some, found).otherwise(0.0)
