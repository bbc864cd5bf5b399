"""Best match of a name among the names of its block, by the weighted score and above a cutoff.

No pair is scored that cannot pass the cutoff, and no pair that can is missed. A score above the cutoff means that one of
its forms passes, and each form leaves a trace that two names share. Let S be the total length of the two texts that a form
compares and t the ratio it needs. An insertion or deletion takes part in at most two letter pairs of its own text and breaks
one of the other's, so texts with padded ends that pass share more than S/2 + 1 - 1.5 * (1 - t) * S letter pairs.

* plain, sorted and distinct words: letter pairs by that bound, and the lengths must allow the ratio. Pairs at blanks do not
  depend on the order of the words, so this covers both sides with their shared words in front.
* shared words alone against a side: they take a share of t / (2 - t) of the shorter side, so it sends its rarest words
  until the rest is less than that.
* a shared word, where one name is at least half as long again.
* windows, where one name is at least half as long again: the shorter name shares letter pairs with the window by the same
  bound without padding, S/2 - 1 - 1.5 * (1 - t) * S. Names too short for that bound meet on a letter.

What only names of unequal length share is sent where the block has a name that much longer or shorter. The best match is
looked for at falling cutoffs: a name that has a match above one has its best and is not compared further.

Letter pairs are numbered by occurrence, so shared ones are counted as multisets. Every name sends only its rarest pairs, as
many as the bound leaves (a prefix filter; the longer side of a window sends all), and pairs that meet are counted in
full before they are scored, and so are their letters: a form has at most as many in common as both names hold. Names that occur on both sides are settled before all that, at score 1.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions import similarity as sim
from rankloom.operators.windows import best_row
from rankloom.storage import counted, shuffled, stage

LEAST_CUTOFF = 2 / 3
#: Scores above which best matches are looked for, one after the other, before the cutoff.
LEVELS = (0.94, 0.86)


def short_size(cutoff: float) -> int:
    """Names up to this length may pass by a window without sharing a letter pair."""
    share = cutoff / sim.WINDOW
    return math.ceil((2.0 - share) / (3.0 * share - 2.0)) - 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used; functions of array elements would repeat it."""
    return F.transform(F.array(value), use)[0]


def _so_far(values: Column, x: Column, i: Column) -> Column:
    """How often the value at place ``i`` has come up to there."""
    return F.size(F.filter(F.slice(values, F.lit(1), i + 1), lambda y: y == x))


def letters_of(text: Column) -> Column:
    """The letters of a text without its blanks, as their codes, numbered by occurrence."""
    def codes(solid: Column) -> Column:
        return F.filter(F.transform(F.sequence(F.lit(1), F.length(solid) + 1), lambda i: F.ascii(F.substring(solid, i, F.lit(1)))), lambda c: c > 0)

    def numbered(found: Column) -> Column:
        return F.transform(found, lambda x, i: F.shiftleft(x.cast("long"), 32) + _so_far(found, x, i))

    return _let(_let(F.regexp_replace(text, r"\s", ""), codes), numbered)


def letter_pairs(text: Column, ends: tuple[str, str] = ("\x02", "\x03")) -> Column:
    """Letter pairs of the text between its ``ends``, numbered by occurrence."""
    def cut(padded: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2)))

    def numbered(pairs: Column) -> Column:
        return F.transform(pairs, lambda x, i: F.concat(x, _so_far(pairs, x, i).cast("string")))

    return _let(_let(F.concat(F.lit(ends[0]), text, F.lit(ends[1])), cut), numbered)


def shared_at_least(total: Column, share: float, padded: bool = True) -> Column:
    """Letter pairs that two texts of this total length share at least if their ratio passes ``share``; one or more."""
    more_than = total * (0.5 - 1.5 * (1.0 - share)) + (1.0 if padded else -1.0)
    return F.greatest(F.floor(more_than + 1e-9).cast("int") + 1, F.lit(1))


def least_total(size: Column, share: float) -> Column:
    """Total length of a text of this size and the shortest one it can reach ``share`` with."""
    return size * (2.0 / (2.0 - share))


def _forms(name: Column) -> dict[str, Column]:
    return {"plain": name, "sorted": F.array_join(sim.words(name), " "), "distinct": F.array_join(F.array_distinct(sim.words(name)), " ")}


def _entries(df: DataFrame, keys: Sequence[str], name_col: str) -> DataFrame:
    """Distinct names with a number, their forms' letter pairs and their words; staged, so that the numbers stay."""
    # By number: by their size, which is small for the work that they are, the names would be one task.
    named = df.select(*keys, F.col(name_col).alias("name")).where(F.length("name") > 0).distinct().repartition(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    forms = _forms(F.col("name"))
    return stage(named.select(
        F.monotonically_increasing_id().alias("id"), *keys, "name", F.length("name").alias("size"), F.array_distinct(sim.words(F.col("name"))).alias("words"),
        letters_of(F.col("name")).alias("letters"),
        *[letter_pairs(f, ("\x02", "\x03") if k == "plain" else (" ", " ")).alias(k) for k, f in forms.items()], *[F.length(f).alias(f"{k}_size") for k, f in forms.items()]), "match-names")


def _reachable(entries: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Names whose block has others, with ``shortest`` and ``longest`` of these."""
    sizes = others.groupBy(*keys).agg(F.min("size").alias("shortest"), F.max("size").alias("longest"))
    return entries.join(counted(stage(sizes, "match-sizes")), keys)


def _word_share(cutoff: float) -> float:
    """Share of the shorter side that shared words alone must exceed."""
    share = cutoff / sim.WORDS
    return share / (2.0 - share)


def _traces(entries: DataFrame, keys: Sequence[str], cutoff: float, left: bool) -> DataFrame:
    """(id, size, words_size, keys, kind, trace, weight, rest): what a name shares with every name it can match.

    Common traces whose weights add up to at most ``rest`` need not be sent.
    """
    inside, around = f"in {'right' if left else 'left'}", f"in {'left' if left else 'right'}"
    # The lengths at which a name of the block lets this one be the shorter or the longer side of a window.
    shorter, longer = F.col("longest") >= F.col("size") * sim.UNEQUAL, F.col("size") >= F.col("shortest") * sim.UNEQUAL
    always, ones = F.lit(True), F.lit(1)
    kinds = []
    for form in ("plain", "sorted", "distinct"):
        share = cutoff if form == "plain" else cutoff / sim.WORDS
        kinds.append((form, F.col(form), shared_at_least(least_total(F.col(f"{form}_size"), share), share) - ones, always))
    if cutoff < sim.WORDS:
        kinds.append((f"words {inside}", F.col("words"), F.col("distinct_size") * _word_share(cutoff) + 1 - 1e-9, always))
        kinds.append((f"words {around}", F.col("words"), F.lit(0), always))
    if cutoff < sim.WINDOW * sim.WORDS:
        kinds.append(("word", F.col("words"), F.lit(0), shorter | longer))
    # Windows: the shorter name of one side meets all of the longer names of the other.
    for form in ("plain", "sorted"):
        scale = sim.WINDOW if form == "plain" else sim.WINDOW * sim.WORDS
        if cutoff < scale:
            need = shared_at_least(least_total(F.col(f"{form}_size"), cutoff / scale), cutoff / scale, False)
            kinds.append((f"{form} {inside}", F.col(form), need - ones, shorter))
            kinds.append((f"{form} {around}", F.col(form), F.lit(0), longer))
    listed = F.array(*[F.struct(F.lit(k).alias("kind"), F.when(test, t).alias("traces"), n.cast("double").alias("rest")) for k, t, n, test in kinds])
    return entries.select("id", "size", F.col("distinct_size").alias("words_size"), *keys, F.explode(listed).alias("k")).select(
        "id", "size", "words_size", *keys, "k.kind", "k.rest", F.explode("k.traces").alias("trace")).withColumn(
        "weight", F.when(F.col("kind").startswith("words "), F.length("trace") + 1).otherwise(1))


def _rarest(traces: DataFrame, counts: DataFrame) -> DataFrame:
    """The traces that a name sends. Its traces are few; the staged counts let the join split a trace of very many names."""
    common = Window.partitionBy("id", "kind").orderBy(F.desc("n"), F.desc("trace")).rowsBetween(Window.unboundedPreceding, 0)
    sent = traces.join(counts, "trace").withColumn("so_far", F.sum("weight").over(common)).where("so_far > rest")
    return sent.drop("so_far", "rest", "weight", "n")


def _letters(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    return entries.select("id", *keys, F.explode(F.array_distinct(F.split("name", ""))).alias("trace")).where("trace <> ''")


def candidate_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], cutoff: float) -> DataFrame:
    """(keys, left_name, right_name): every pair of different names of a block whose score can pass ``cutoff``."""
    if cutoff <= LEAST_CUTOFF:
        raise ValueError("at this cutoff two names may pass without sharing a letter pair")
    keys = list(keys)
    reach = [_reachable(left, right, keys), _reachable(right, left, keys)]
    traces = [_traces(reach[0], keys, cutoff, True), _traces(reach[1], keys, cutoff, False)]
    counts = counted(stage(traces[0].unionByName(traces[1]).groupBy("trace").agg(F.count("*").alias("n")), "match-counts"))
    a, b = (stage(_rarest(t, counts), "match-traces").withColumnsRenamed({"id": f"{side}_id", "size": f"{side}_size", "words_size": f"{side}_words_size"})
            for t, side in zip(traces, ("left", "right"), strict=True))
    met = a.join(shuffled(b), [*keys, "kind", "trace"]).where(
        F.when(F.col("kind") == "words in right", F.col("right_words_size") >= F.col("left_words_size"))
        .when(F.col("kind") == "words in left", F.col("left_words_size") >= F.col("right_words_size"))
        .when(F.col("kind") == "word", F.greatest("left_size", "right_size") >= F.least("left_size", "right_size") * sim.UNEQUAL)
        .when(F.col("kind").endswith("in right"), F.col("right_size") >= F.col("left_size") * sim.UNEQUAL)
        .when(F.col("kind").endswith("in left"), F.col("left_size") >= F.col("right_size") * sim.UNEQUAL).otherwise(True))
    found = met.select("left_id", "right_id")
    short = (F.col("size") <= short_size(cutoff)) & (F.col("longest") >= F.col("size") * sim.UNEQUAL)
    for few, all_names, ids in ((reach[0], right, ("left_id", "right_id")), (reach[1], left, ("right_id", "left_id"))):
        letters = _letters(few.where(short), keys).withColumnRenamed("id", ids[0])
        found = found.unionByName(letters.join(shuffled(_letters(all_names, keys).withColumnRenamed("id", ids[1])), [*keys, "trace"]).select("left_id", "right_id"))

    def side(df: DataFrame, tag: str, with_keys: bool) -> DataFrame:
        kept = [c for c in df.columns if c not in keys and c != "id"]
        return df.select(F.col("id").alias(f"{tag}_id"), *(keys if with_keys else []), *[F.col(c).alias(f"{tag}_{c}") for c in kept])

    both = found.distinct().join(shuffled(side(left, "left", True)), "left_id").join(shuffled(side(right, "right", False)), "right_id")
    return both.where((F.col("left_name") != F.col("right_name")) & _can_pass(cutoff)).select(*keys, "left_name", "right_name")


def _can_pass(cutoff: float) -> Column:
    """Whether the shared letters, letter pairs and words of a pair allow a score above the cutoff."""
    blanks = [F.col(f"{side}_size") - F.size(f"{side}_letters") for side in ("left", "right")]
    letters = F.size(F.array_intersect("left_letters", "right_letters")) + F.least(*blanks)

    def enough(form: str, share: float) -> Column:
        a, b = F.col(f"left_{form}_size"), F.col(f"right_{form}_size")
        return (F.least(a, b, letters) * 2.0 > (a + b) * share - 1e-9) & (
            F.size(F.array_intersect(f"left_{form}", f"right_{form}")) >= shared_at_least(a + b, share))

    shorter, longer = F.least("left_size", "right_size"), F.greatest("left_size", "right_size")
    word = F.arrays_overlap("left_words", "right_words")
    share = cutoff / sim.WORDS
    together = F.aggregate(F.array_intersect("left_words", "right_words"), F.lit(-1), lambda n, w: n + F.length(w) + 1)
    words = F.lit(cutoff < sim.WORDS) & (together > F.least("left_distinct_size", "right_distinct_size") * _word_share(cutoff) - 1e-9)
    near = words | enough("sorted", share) | enough("distinct", share)
    pairs = F.arrays_overlap("left_plain", "right_plain") | F.arrays_overlap("left_sorted", "right_sorted")
    scale = F.when(longer <= shorter * sim.FAR, sim.WINDOW).otherwise(sim.FAR_WINDOW)
    far = (scale > cutoff) & (word | pairs | (shorter <= short_size(cutoff)))
    return enough("plain", cutoff) | F.when(longer < shorter * sim.UNEQUAL, near).otherwise(far)


def best_matches(left: DataFrame, right: DataFrame, keys: Sequence[str], cutoff: float = 0.7, name_col: str = "team_name") -> DataFrame:
    """(keys, left_name, right_name, score): for each name on the left the best name of its block on the right.

    Only scores above ``cutoff`` count; ties go to the smaller name on the right. A name that the right has as well is
    its own match.
    """
    inner = [f"_key{i}" for i in range(len(keys))]  # a key may be called like a column in here
    a, b = (_entries(df.select(*[F.col(k).alias(i) for k, i in zip(keys, inner, strict=True)], name_col), inner, name_col) for df in (left, right))
    names = shuffled(b.select(*inner, "name"))
    same = a.select(*inner, "name").join(names, [*inner, "name"]).select(
        *inner, F.col("name").alias("left_name"), F.col("name").alias("right_name"), F.lit(1.0).alias("score"))
    open_names = stage(a.join(names, [*inner, "name"], "left_anti").select(*a.columns), "match-open")
    found = [same]
    for level in (*[x for x in LEVELS if x > cutoff], cutoff):
        pairs = stage(candidate_pairs(open_names, b, inner, level), "match-pairs")
        score = F.round(sim.weighted_score(F.col("left_name"), F.col("right_name")), 9)
        scored = stage(pairs.withColumn("score", score), "match-scores").where(F.col("score") > level)
        found.append(stage(best_row(scored, [*inner, "left_name"], [F.desc("score"), F.asc("right_name")]), "match-best"))
        settled = found[-1].select(*inner, F.col("left_name").alias("name"))
        open_names = stage(open_names.join(shuffled(settled), [*inner, "name"], "left_anti").select(*a.columns), "match-open")
    best = reduce(DataFrame.unionByName, found)
    return best.select(*[F.col(i).alias(k) for k, i in zip(keys, inner, strict=True)], "left_name", "right_name", "score")
