"""What changed between two builds of the master index, and merging builds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions import text
from rankloom.functions.strings import strip
from rankloom.operators.clean import require_columns
from rankloom.operators.matching import best_matches
from rankloom.operators.windows import best_row
from rankloom.schemas import COMPLETENESS_WEIGHTS, PROVIDER_PREFERENCE
from rankloom.storage import shuffled, stage

TEAM_KEY = ("team_name", "age_group", "gender", "state")
CELL = ("age_group", "gender", "state")
FEED_KEY = ("team_name", "age_group", "gender", "state", "source", "rank", "points")


def _absent(left: DataFrame, right: DataFrame, keys: Sequence[str], loose: bool = False) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; nulls equal nulls."""
    def key(c: str) -> Column:
        return F.lower(strip(F.col(c))) if loose else F.col(c)

    probe = right.select(*[key(c).alias(f"_{c}") for c in keys]).distinct()
    same = reduce(and_, [key(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    return left.join(probe, same, "left_anti")


def new_teams(
    new: DataFrame, baseline: DataFrame, keys: Sequence[str] = TEAM_KEY, normalize_keys: bool = False
) -> DataFrame:
    """Rows of ``new`` that the baseline lacks; exact text unless ``normalize_keys``."""
    require_columns(new, keys)
    require_columns(baseline, keys)
    return _absent(new, baseline, keys, normalize_keys)


def new_teams_by_provider(new: DataFrame, baseline: DataFrame) -> DataFrame:
    """New teams counted within each provider; providers without any show 0."""
    added = _absent(new, baseline, ["provider", *TEAM_KEY])
    counts = added.groupBy("provider").agg(F.count("*").alias("added"))
    return new.select("provider").distinct().join(counts, "provider", "left").select(
        "provider", F.coalesce("added", F.lit(0)).alias("added"), F.lit(0).alias("removed"), F.lit(0).alias("renamed")
    )


def compare_builds(new: DataFrame, old: DataFrame, key_cols: Sequence[str] = CELL) -> dict[str, DataFrame]:
    """Rows only in the new and only in the old build, by cell or by ``key_cols``."""
    require_columns(new, key_cols)
    require_columns(old, key_cols)
    return {"added": _absent(new, old, key_cols), "removed": _absent(old, new, key_cols)}


# ---------------------------------------------------------------- similar names

def similar_names(
    left: DataFrame, right: DataFrame, keys: Sequence[str], threshold: float, strict: bool = False,
    tokens: Callable[[Column], Column] = text.name_tokens,
) -> DataFrame:
    """Pairs of distinct names of the same block whose overlap of words (or other ``tokens``) reaches ``threshold``.

    (keys, left_name, right_name, score). Exact without comparing everyone in a
    block: two word sets that overlap enough share one of the rarest words of
    each, so each name is joined on that short prefix of rare words only. Names
    with the same text are one entry here, however many teams carry them. A block
    full of names that are nearly the same still has as many pairs as it has.
    """
    a, b = (_name_entries(df, keys, side, tokens) for df, side in ((left, "left"), (right, "right")))
    a, b = _ranked(a, b, keys)
    return _pairs_at(a, b, keys, threshold, strict).distinct()


def _name_entries(df: DataFrame, keys: Sequence[str], side: str, tokens: Callable[[Column], Column]) -> DataFrame:
    """Distinct names of a side that have words, with their word sets; staged."""
    named = df.select(*keys, F.col("team_name").alias(f"{side}_name")).where(F.col(f"{side}_name").isNotNull()).distinct()
    return stage(named.withColumn("_words", F.array_sort(F.array_distinct(tokens(F.col(f"{side}_name"))))).where(F.size("_words") > 0), "names")


def _ranked(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with their words from the rarest of the block on as ``_left`` and ``_right``; staged."""
    # Staged, so that the names with a frequent word can be split in the join.
    words = [df.select(*keys, F.explode("_words").alias("word")) for df in (a, b)]
    counts = stage(words[0].unionAll(words[1]).groupBy(*keys, "word").agg(F.count("*").alias("n")), "word_counts")

    def ranked(df: DataFrame, side: str) -> DataFrame:
        ordered = df.select(*keys, f"{side}_name", F.explode("_words").alias("word")).join(counts, [*keys, "word"]).groupBy(*keys, f"{side}_name").agg(
            F.array_sort(F.collect_list(F.struct("n", "word"))).alias("_r"))
        return stage(ordered.select(*keys, f"{side}_name", F.col("_r.word").alias(f"_{side}")), "ranked-names")

    return ranked(a, "left"), ranked(b, "right")


def _pairs_at(a: DataFrame, b: DataFrame, keys: Sequence[str], threshold: float, strict: bool) -> DataFrame:
    """(keys, left_name, right_name, score) of ranked sides whose overlap reaches ``threshold``; a pair may come more than once."""
    # How many words the larger one of two sets must share decides which of its words it sends, so sets meet by their sizes:
    # the prefix for a set of the same size is shorter than the one for the smallest set that can reach the threshold.
    others = {"left": b, "right": a}

    def prefixes(df: DataFrame, side: str) -> DataFrame:
        other = "right" if side == "left" else "left"
        size = F.size(f"_{side}")
        sizes = stage(others[side].select(*keys, F.size(f"_{other}").alias(f"_{other}_size")).distinct(), "name-sizes")
        total = size + F.col(f"_{other}_size")
        share = F.ceil(total * F.lit(threshold / (1.0 + threshold)) - 1e-9)
        keep = (size - F.greatest(share, F.lit(1)) + 1).cast("int")
        near = (size >= F.col(f"_{other}_size") * threshold - 1e-9) & (F.col(f"_{other}_size") >= size * threshold - 1e-9)
        met = df.join(sizes, keys).where(near & (keep > 0)).withColumn(f"_{side}_size", size)
        return met.select("*", F.posexplode(F.slice(f"_{side}", F.lit(1), keep)).alias(f"_{side}_at", "_word"))

    la, lb = F.size("_left"), F.size("_right")
    pairs = prefixes(a, "left").join(prefixes(b, "right"), [*keys, "_word", "_left_size", "_right_size"])
    # Lengths too far apart cannot reach the threshold. Behind the first shared word, the rest of either side must suffice.
    pairs = pairs.where((la >= lb * threshold - 1e-9) & (lb >= la * threshold - 1e-9) & (
        F.least(la - F.col("_left_at"), lb - F.col("_right_at")) >= (la + lb) * (threshold / (1.0 + threshold)) - 1e-9))
    shared = F.size(F.array_intersect("_left", "_right"))
    scored = pairs.select(*keys, "left_name", "right_name", (la + lb).alias("_both"), shared.alias("_shared")).withColumn(
        "score", F.col("_shared") / (F.col("_both") - F.col("_shared")))
    return scored.where(F.col("score") > threshold if strict else F.col("score") >= threshold).drop("_both", "_shared")


#: Overlaps at which best matches are looked for, one after the other, before the threshold.
LEVELS = (0.85, 0.75, 0.65)


def best_similar(
    left: DataFrame, right: DataFrame, keys: Sequence[str], threshold: float, tokens: Callable[[Column], Column] = text.name_tokens,
) -> DataFrame:
    """(keys, left_name, right_name, score): for each name on the left the most similar one of its block above ``threshold``.

    Ties go to the smaller name on the right. Exact, and without the pairs of a block: names with the same words are
    settled first. The others are compared at falling overlaps; a name that finds any match at one of them has found its
    best and is not compared further, so the long prefixes of a low threshold are those of few names.
    """
    keys = list(keys)
    a, b = (_name_entries(df, keys, side, tokens) for df, side in ((left, "left"), (right, "right")))
    same = a.join(b.groupBy(*keys, "_words").agg(F.min("right_name").alias("right_name")), [*keys, "_words"]).select(
        *keys, "left_name", "right_name", F.lit(1.0).alias("score")).where(F.col("score") > threshold)
    found = [stage(same, "same-words")]
    open_names, b = _ranked(a.join(found[0], [*keys, "left_name"], "left_anti"), b, keys)
    for level in (*[x for x in LEVELS if x > threshold], threshold):
        pairs = _pairs_at(open_names, b, keys, level, level == threshold)
        found.append(stage(best_row(pairs, [*keys, "left_name"], [F.desc("score"), F.asc("right_name")]), "best-names"))
        open_names = open_names.join(found[-1], [*keys, "left_name"], "left_anti")
    return reduce(DataFrame.unionByName, found)


#: Ways to compare names: what they are cut into (none: the weighted score), and what a rename must exceed.
SCORERS = {"letters": (text.trigrams, 0.5), "words": (text.name_tokens, 0.7), "weighted": (None, 0.7)}


def renamed_teams(new: DataFrame, old: DataFrame, threshold: float | None = None, key_cols: Sequence[str] = CELL,
                  scorer: str = "letters") -> DataFrame:
    """Best old name above the threshold for each new name, in cells whose team counts differ.

    ``scorer`` is letters (groups of three, which forgives typing errors), words, or weighted (the best of plain, sorted,
    set and window forms, see ``operators.matching``).

    Cells of equal size are skipped. Ties go to the smaller old name. Every team
    row with that name appears, next to the first old row of the matched name.
    """
    keys = list(key_cols)
    tokens, usual = SCORERS[scorer]
    threshold = usual if threshold is None else threshold
    # Staged: both builds are read several times.
    used = [*keys, "team_name", *[c for c in ("rank", "points") if c in old.columns and c in new.columns]]
    new, old = (stage(build.select(*used), "build") for build in (new, old))
    sizes_new = new.groupBy(*keys).agg(F.count("*").alias("_n_new"))
    sizes_old = old.groupBy(*keys).agg(F.count("*").alias("_n_old"))
    uneven = sizes_new.join(sizes_old, keys).where("_n_new <> _n_old").select(*keys)
    sides = [build.join(uneven, keys, "left_semi") for build in (new, old)]
    if tokens is None:
        best = best_matches(*sides, keys, threshold)
    else:
        best = best_similar(*sides, keys, threshold, tokens)
    extra = [c for c in ("rank", "points") if c in old.columns and c in new.columns]
    first_old = best_row(
        old.select(*keys, F.col("team_name").alias("right_name"), *[F.col(c).alias(f"old_{c}") for c in extra]),
        [*keys, "right_name"], [F.col(f"old_{c}").asc_nulls_last() for c in extra] or [F.lit(1)],
    )
    rows = new.select(*keys, F.col("team_name").alias("left_name"), *[F.col(c).alias(f"new_{c}") for c in extra])
    return rows.join(shuffled(best), [*keys, "left_name"]).join(shuffled(first_old), [*keys, "right_name"]).select(
        F.col("right_name").alias("old_team_name"), F.col("left_name").alias("new_team_name"), *keys,
        (F.col("score") * 100).alias("similarity_score"),
        *[f"{side}_{c}" for c in extra for side in ("old", "new")],
    )


# ---------------------------------------------------------------- merging

def completeness(columns: Sequence[str], weights: Mapping[str, float] = COMPLETENESS_WEIGHTS) -> Column:
    """Weighted share of the known fields that hold something."""
    present = [(c, w) for c, w in weights.items() if c in columns]
    filled = sum(
        (F.when(F.coalesce(strip(F.col(c).cast("string")), F.lit("")) != "", w).otherwise(0.0) for c, w in present),
        start=F.lit(0.0),
    )
    total = sum(w for _, w in present)
    return filled / total if total else F.lit(0.0)


def provider_priority(preference: Mapping[str, int] = PROVIDER_PREFERENCE) -> Column:
    case = None
    for name, value in preference.items():
        test = F.col("provider") == name
        case = F.when(test, value) if case is None else case.when(test, value)
    return F.lit(0) if case is None else case.otherwise(0)


def resolve_conflicts(df: DataFrame, tie_break: Sequence[str] = ("source_url",)) -> DataFrame:
    """One row per team id: most complete, then preferred feed; all its feeds in ``providers``."""
    order = [F.round(completeness(df.columns), 9).desc(), provider_priority().desc(),
             *[F.col(c).asc_nulls_last() for c in tie_break]]
    best = best_row(df.where(F.col("team_id").isNotNull()), ["team_id"], order)
    feeds = df.groupBy("team_id").agg(F.sort_array(F.collect_set("provider")).alias("providers"))
    return best.join(feeds, "team_id")


def dedupe_feed(df: DataFrame) -> DataFrame:
    """One row per team and feed entry, the first by its other columns."""
    return best_row(df, FEED_KEY, [])


def dedupe_prefer_id(df: DataFrame) -> DataFrame:
    """One row per name, age, gender and state: the smallest team id, rows without one last."""
    return best_row(df, TEAM_KEY, [F.col("team_id").asc_nulls_last()])


def merge_with_baseline(new: DataFrame, baseline: DataFrame, prefer: Sequence[str] = ()) -> DataFrame:
    """Baseline plus one new row per team id it does not have: the first by ``prefer``, then by all columns.

    New rows without a team id are all kept.
    """
    known = baseline.select("team_id").where("team_id IS NOT NULL").distinct()
    unknown = new.where("team_id IS NOT NULL").join(known, "team_id", "left_anti").select(*new.columns)
    fresh = best_row(unknown, ["team_id"], [F.col(c).asc_nulls_last() for c in prefer])
    return baseline.unionByName(fresh.unionByName(new.where("team_id IS NULL")), allowMissingColumns=True)


def merge_summary(df: DataFrame) -> DataFrame:
    """Totals, coverage, multi-feed share and completeness of merged teams."""
    multi = F.count_if(F.size("providers") > 1)
    score = completeness(df.columns)
    return df.agg(
        F.count("*").alias("total_teams"), F.countDistinct("team_id").alias("unique_team_ids"),
        F.countDistinct("provider").alias("providers"), F.countDistinct("state").alias("states_covered"),
        F.countDistinct("age_group").alias("age_groups"), F.countDistinct("gender").alias("genders"),
        multi.alias("multi_provider_teams"),
        F.coalesce(multi * 100.0 / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("multi_provider_pct"),
        F.avg(score).alias("avg_completeness"), F.min(score).alias("min_completeness"),
        F.max(score).alias("max_completeness"),
    )


def top_counts(df: DataFrame, cols: Sequence[str], n: int = 5) -> DataFrame:
    """(dimension, value, teams): the ``n`` largest values of each column."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("p")).select("p.*").where("value IS NOT NULL")
    counts = pairs.groupBy("dimension", "value").agg(F.count("*").alias("teams"))
    window = Window.partitionBy("dimension").orderBy(F.desc("teams"), "value")
    return counts.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def delta_trend(history: DataFrame) -> DataFrame:
    """One row over build history: totals, net growth, growth from first to last, averages per build."""
    n = F.count("*")
    first, last = F.min_by("teams_total", "timestamp"), F.max_by("teams_total", "timestamp")
    return history.agg(
        n.alias("total_builds"), F.sum("added").alias("total_added"), F.sum("removed").alias("total_removed"),
        F.sum("renamed").alias("total_renamed"), (F.sum("added") - F.sum("removed")).alias("net_growth"),
        F.when((n > 1) & (first > 0), (last - first) * 100.0 / first).otherwise(0.0).alias("growth_rate_percent"),
        (F.sum("added") / n).alias("avg_added_per_build"), (F.sum("removed") / n).alias("avg_removed_per_build"),
    )
