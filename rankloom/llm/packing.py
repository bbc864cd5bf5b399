"""Packing of token sequences by non-negative least squares (operator 9).

Documents are packed where they are read, in units of about ``UNIT`` bytes of text, so memory is bounded and nothing is
shuffled. In a unit, whole windows are cut off long documents; the histogram of what remains is matched: combinations of
two or three lengths that fill a window exactly are enumerated, least squares with non-negative repeat counts is solved
against the histogram, the counts are rounded so that no length is used more often than it is there, and the residual
documents are packed greedily, the largest that fits first, cut where none fits. What is left at the end of a unit goes
to sequences whose lengths are powers of two. So no sequence needs padding.

Tokens: words between blanks never share a token in these vocabularies, so each distinct word is encoded once per
task and documents are put together from arrays. Where the vocabulary folds case and parts letters, numbers and signs, a word
below U+0180 is folded and parted here, each distinct part is encoded once and the tokenizer does the merges alone; other
words, and those that hold a special token, go through the whole tokenizer.

Defined cases: null and empty texts have one token, the closing one; a text of any length is cut over as many sequences as
it takes; repeated rows are packed each; null ids are kept; an empty table gives no rows; of other columns only the id
is read. Sequence ids are unique, not dense: task number times 2^32 and a count.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from bisect import bisect_right, insort
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from rankloom.llm.common import by_size, give_back, query, table

WINDOW = 4096
END = 2
UNIT = 8_000_000
#: Characters that are encoded at a time: the arrays of words and places are many times the text, the ids are not.
STEP = 1_000_000
#: Exact combinations enumerated per longest member; words, and characters in them, kept by a task before it forgets them.
TRIPLES, KEPT_WORDS, KEPT_CHARS = 4, 400_000, 16_000_000
SWEEPS = 8
#: Words encoded together; characters at which Python parts words and the vocabulary does not.
TOGETHER, PARTED = 1000, "\x1c\x1d\x1e\x1f"
#: The steps before the merges that ``parts_of`` stands for; its characters are their own NFC and fold one to one.
BLANKS, PLAIN, OUTSIDE = "\t\n\v\f\r \x85\xa0", [chr(c) for c in range(0x180) if c != 0x130], "[^\0-įı-ſ]"
FOLDED = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PARTING = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
PIECE = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def numbers() -> defaultdict:
    """Numbers of words in the order they are first asked for."""
    return defaultdict(count().__next__)


def newest(words: dict, known: int) -> list[str]:
    """The words after the first ``known``."""
    return list(islice(reversed(words), len(words) - known))[::-1]


def parting() -> re.Pattern:
    """The pattern of ``PARTING`` for characters of ``PLAIN``, and a line feed as a part."""
    letters, numbers = ("".join(c for c in PLAIN if unicodedata.category(c)[0] == kind) for kind in "LN")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{BLANKS}{letters}{numbers}]+|\n")


def gathered(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids of all ranges, one range after another."""
    ends = np.cumsum(lengths)
    return ids[np.repeat(starts - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Encoder:
    """Token ids of many texts, each followed by ``END``."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        special = sorted((i, t.content) for i, t in added.items() if t.special)
        self.mark_id, self.mark = special[0] if special else (None, None)
        shape = json.loads(self.tokenizer.to_str())
        suffix = shape["model"].get("end_of_word_suffix")
        self.merges = None
        if suffix and shape["normalizer"] == FOLDED and shape["pre_tokenizer"] == PARTING and all(t.special for t in added.values()):
            self.merges = Tokenizer(self.tokenizer.model)
            self.merges.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocabulary = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
            self.parts_of = parting().findall
            self.whole = re.compile("|".join([OUTSIDE, *(re.escape(t.content) for t in added.values())])).finditer
        self.forget()

    def forget(self) -> None:
        # The line feed stands for the end of a text, and of a word among parts: no word has one.
        self.words, self.ids, self.at = numbers(), np.array([END], np.uint32), np.array([0, 1], np.int64)
        self.parts, self.part_ids, self.part_at = numbers(), np.zeros(0, np.uint32), np.zeros(2, np.int64)
        self.words["\n"], self.parts["\n"]  # asked for first: number 0
        self.chars = 0

    def code_whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and how many each has. Words are encoded together, parted by a special token that none of them holds."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for start in range(0, len(words), TOGETHER):
            part = words[start:start + TOGETHER]
            joined = self.mark.join(part) if self.mark else ""
            if self.mark and joined.count(self.mark) == len(part) - 1:
                found = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
                marks = np.append(np.flatnonzero(found == self.mark_id), len(found))
                ids.append(found[found != self.mark_id])
                counts.append(np.diff(marks, prepend=-1) - 1)
            else:
                coded = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                ids.append(np.array([i for c in coded for i in c], np.uint32))
                counts.append(np.array([len(c) for c in coded], np.int64))
        return np.concatenate(ids), np.concatenate(counts)

    def code_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``code_whole`` for folded parts: the last token of each, and no other, ends with the suffix."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for start in range(0, len(parts), TOGETHER):
            group = parts[start:start + TOGETHER]
            found = np.array(self.merges.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[found])
            whole = len(ends) == len(group) and ends[-1] == len(found) - 1
            # Not so where a vocabulary lacks single bytes.
            found, sizes = (found, np.diff(ends, prepend=-1)) if whole else self.code_whole(group)
            ids.append(found)
            counts.append(sizes)
        return np.concatenate(ids), np.concatenate(counts)

    def code(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and how many each has, put together from parts."""
        if self.merges is None:
            return self.code_whole(words)
        text = "".join([f"{w}\n" for w in words])
        at = np.array([m.start() for m in self.whole(text)], np.int64)
        whole = np.unique(np.searchsorted(np.cumsum([len(w) + 1 for w in words]), at, side="right"))
        if len(whole):
            words = list(words)
            apart = [words[i] for i in whole]
            for i in whole:
                words[i] = ""
            text = "".join([f"{w}\n" for w in words])
        found, known = self.parts_of(text.lower()), len(self.parts)
        order = np.fromiter(map(self.parts.__getitem__, found), np.int64, len(found))
        coded, counts = self.code_parts(newest(self.parts, known))
        self.part_ids = np.concatenate([self.part_ids, coded])
        self.part_at = np.concatenate([self.part_at, self.part_at[-1] + np.cumsum(counts, dtype=np.int64)])
        lengths = np.diff(self.part_at)[order]
        ids = gathered(self.part_ids, self.part_at[order], lengths)
        ends = np.cumsum(lengths)[order == 0]
        lengths = np.diff(ends, prepend=0)
        if len(whole):
            coded, counts = self.code_whole(apart)
            starts = ends - lengths
            starts[whole], lengths[whole] = len(ids) + np.cumsum(counts) - counts, counts
            ids = gathered(np.concatenate([ids, coded]), starts, lengths)
        return ids, lengths

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (with the end)."""
        if len(self.words) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self.forget()
        known, found, sizes = len(self.words), [], []
        for text in texts:
            # The short way parts at four control characters as well, which are no blanks for the vocabulary.
            words = text.split() if not any(c in text for c in PARTED) else text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            found += words
            found.append("\n")
            sizes.append(len(words) + 1)
        order = np.fromiter(map(self.words.__getitem__, found), np.int64, len(found))
        new = newest(self.words, known)
        self.chars += sum(map(len, new))
        coded, counts = self.code(new)
        self.ids = np.concatenate([self.ids, coded])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(counts, dtype=np.int64)])
        length = np.diff(self.at)[order]
        ids = gathered(self.ids, self.at[order], length)
        return ids, np.concatenate([[0], np.cumsum(length)[np.cumsum(sizes) - 1]]) if texts else np.zeros(1, np.int64)


def encoded(encode: Encoder, unit: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """As the encoder gives it, for a unit of any size: steps are encoded one by one and only their ids are kept."""
    ids, sizes = [], [np.zeros(1, np.int64)]
    for step in by_size(iter(unit), lambda r: len(r[1]), STEP):
        found, at = encode([t for _, t in step])
        ids.append(found)
        sizes.append(np.diff(at))
    return np.concatenate(ids), np.cumsum(np.concatenate(sizes))


def combinations(lengths: np.ndarray, window: int = WINDOW) -> list[tuple[int, ...]]:
    """Sets of two or three of the lengths that fill the window exactly, longest first."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    pairs = [(int(a), int(window - a)) for a in lengths if 2 * a >= window and there[window - a]]
    triples = []
    for a in lengths[(3 * lengths >= window)]:
        second = lengths[(lengths <= a) & (2 * lengths >= window - a) & (lengths < window - a)]
        second = second[there[window - a - second]]
        for b in second[np.unique(np.linspace(0, len(second) - 1, TRIPLES).astype(int))] if len(second) else ():
            triples.append((int(a), int(b), int(window - a - b)))
    return pairs + triples


def repeats(sets: list[tuple[int, ...]], histogram: np.ndarray) -> list[int]:
    """How often to use each set: non-negative least squares by coordinate descent, rounded within the histogram."""
    rest, uses = histogram.astype(float).tolist(), [0.0] * len(sets)
    counted = [tuple((x, s.count(x)) for x in set(s)) for s in sets]
    for _ in range(SWEEPS):
        for i, s in enumerate(counted):
            change = max(-uses[i], sum(m * rest[x] for x, m in s) / sum(m * m for _, m in s))
            if change:
                uses[i] += change
                for x, m in s:
                    rest[x] -= m * change
    left, out = histogram.tolist(), [0] * len(sets)
    for i in sorted(range(len(sets)), key=lambda i: (-uses[i], i)):
        out[i] = max(0, min([int(uses[i] + 0.5), *(left[x] // m for x, m in counted[i])]))
        for x, m in counted[i]:
            left[x] -= m * out[i]
    return out


def packed(lengths: np.ndarray, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) over documents of these lengths."""
    out = [[(doc, at, window)] for doc in np.flatnonzero(lengths >= window).tolist()
           for at in range(0, int(lengths[doc]) - window + 1, window)]
    rest = lengths % window
    waiting: dict[int, list[int]] = {}
    for doc in np.flatnonzero(rest).tolist():
        waiting.setdefault(int(rest[doc]), []).append(doc)
    base = (lengths - rest).tolist()
    histogram = np.bincount(rest[rest > 0], minlength=window + 1)
    sets = combinations(np.flatnonzero(histogram)[::-1], window)
    for lengths_in, times in zip(sets, repeats(sets, histogram), strict=True):
        for _ in range(times):
            docs = [(waiting[x].pop(), x) for x in lengths_in]
            out.append([(doc, base[doc], x) for doc, x in docs])
    # (length, document, start) of the residual, largest last.
    left = sorted((x, doc, base[doc]) for x, docs in waiting.items() for doc in docs)
    now, free = [], window
    while left:
        at = bisect_right(left, (free, np.inf, 0)) - 1
        size, doc, start = left.pop(max(at, 0))
        take = min(size, free)
        now.append((doc, start, take))
        if take < size:
            insort(left, (size - take, doc, start + take))
        free -= take
        if not free:
            out.append(now)
            now, free = [], window
    held = window - free
    while held:
        want = 1 << (held.bit_length() - 1)
        held -= want
        part = []
        while want:
            doc, start, size = now.pop(0)
            take = min(size, want)
            part.append((doc, start, take))
            if take < size:
                now.insert(0, (doc, start + take, size - take))
            want -= take
        out.append(part)
    return out


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents."""
    rows = docs.select(id_col, docs[text_col].cast("string").alias("text"))
    schema = StructType([rows.schema[0]] + [StructField(c, LongType()) for c in PIECE])

    def run(batches):
        encode, sequence = Encoder(tokenizer), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = ((i, t.as_py() or "") for i, t in enumerate(batch.column(1)))
            for unit in by_size(texts, lambda r: len(r[1]), UNIT):
                ids, at = encoded(encode, unit)
                pieces = []
                for parts in packed(np.diff(at)):
                    offset = 0
                    for doc, start, size in parts:
                        low = int(at[doc]) + start
                        code = zlib.crc32(ids[low:low + size].astype("<u4").tobytes())
                        pieces.append((unit[doc][0], start, size, code, int(at[doc + 1] - at[doc]), sequence, offset))
                        offset += size
                    sequence += 1
                columns = list(zip(*pieces, strict=True))
                owner = batch.column(0).take(pa.array(columns[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([owner] + [pa.array(c, pa.int64()) for c in columns[1:]], names=schema.names)
        del encode
        give_back()

    return rows.mapInArrow(run, schema)


def public_vocabulary() -> str:
    """The vocabulary file's place; the same on every node."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_pack")
def op9(spark, sf_dir):
    """All documents packed into sequences of at most 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"), public_vocabulary())
