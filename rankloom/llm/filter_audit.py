"""Filter interaction audit by a recursive query (operator 12).

Each text is judged once by all filters: its failures are the bits of a mask, and documents become counts per part and
mask, at most 2^n cells a part for n filters. A recursive common table expression then starts from the masks with an
empty prefix and extends every prefix with each unused letter, carrying the bits applied so far; a level emits, for each
mask, whether that step removes it, finds it removed already, or keeps it. Joined with the cells, the levels give the
counts of every prefix; an order of all letters reads its steps off its prefixes. The recursion sees masks, not
documents or parts, so its size is fixed: (number of prefixes) x 2^n rows, about 10,000 for five filters. Six filters
stay below Spark's limit of a million rows; more are refused.

The filter on repeated texts compares SHA-256 digests: the smallest id of each digest is found with partial sums, and rows
meet it on digest and id, so a text that a third of all rows share is never one group. Texts are read once.

Defined cases: a null text is empty; a null part is the empty string; an empty text has no words, fails A and does not
fail B to D; a row without id fails no comparison of ids and repeats of the smallest id are all first; a labelled
document counts as good or toxic if any of its labels says so; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import query, table, text_or_empty
from rankloom.storage import stage

#: Most filters whose prefixes and masks stay below the row limit of a recursive query.
MOST_FILTERS = 6


def text_rules(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of a text, by letter."""
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": count < 200,
        "B": distinct.cast("long") * 100 < count.cast("long") * 50,
        "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") * 100 > F.length(text).cast("long") * 3,
        "D": text.rlike(r"[#$%&*|]"),
    }


def mask_cells(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """(part, mask, docs, good, toxic): documents by the filters they fail, A in bit 0; the bit after the rules marks repeated texts."""
    text = docs.select(
        "doc_id", F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text_or_empty().alias("text"))
    split = text.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    rules = text_rules(F.col("text"), F.col("words"))
    mask = sum([F.when(rule, 1 << i).otherwise(0) for i, rule in enumerate(rules.values())], F.lit(0))
    judged = stage(split.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask")), "filter-masks")
    first = judged.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    repeated = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return judged.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left").withColumn(
        "mask", F.col("mask") + F.when(repeated, 1 << len(rules)).otherwise(0)).groupBy("part", "mask").agg(
        F.count("*").alias("docs"), F.count_if(F.col("good") == 1).alias("good"), F.count_if(F.col("bad") == 1).alias("toxic"))


LEVELS = """
WITH RECURSIVE level(mask, prefix, letter, step, before, applied) AS (
  SELECT mask, '' AS prefix, '' AS letter, 0 AS step, 0 AS before, 0 AS applied FROM {masks}
  UNION ALL
  SELECT mask, concat(prefix, next.letter), next.letter, step + 1, applied, applied | next.bit
  FROM (SELECT mask, prefix, step, applied, explode(filter({filters}, f -> (f.bit & applied) = 0)) AS next FROM level)
)
SELECT mask, prefix, letter, step, (mask & applied) = 0 AS kept, (mask & before) = 0 AND (mask & applied) <> 0 AS removed,
  (mask & before) <> 0 AND (mask & (applied - before)) <> 0 AS redundant, mask = applied - before AS unique_fail
FROM level WHERE step > 0
"""


def step_metrics(cells: DataFrame, letters: str) -> DataFrame:
    """(part, prefix, letter, step, kept, removed, ...) of the last step of every prefix, from the levels of the recursion."""
    if len(letters) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters")
    filters = "array(" + ", ".join(f"named_struct('letter', '{c}', 'bit', {1 << i})" for i, c in enumerate(letters)) + ")"
    levels = cells.sparkSession.sql(LEVELS.replace("{filters}", filters), masks=cells.select("mask").distinct())

    def counted(flag: str, what: str = "docs") -> Column:
        return F.coalesce(F.sum(F.when(F.col(flag), F.col(what))), F.lit(0))

    return cells.join(levels, "mask").groupBy("part", "prefix", "letter", "step").agg(
        counted("kept").alias("kept"), counted("removed").alias("removed"), counted("redundant").alias("redundant"),
        counted("unique_fail").alias("unique_fails"), counted("removed", "good").alias("good_lost"),
        counted("removed", "toxic").alias("toxic_lost"))


def audit(cells: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of all ``letters`` and step, with each filter's removals summed over all orders."""
    # Staged: the recursion runs once, and both the orders and their steps are read from its result.
    steps = stage(step_metrics(stage(cells, "filter-cells"), letters), "filter-steps")
    orders = steps.where(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    places = F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")
    rows = orders.select("part", "filter_order", places).withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
    rows = rows.join(steps, ["part", "prefix", "step"])
    share = rows.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return rows.join(share, ["part", "letter"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        *[F.col(c).cast("long").alias(c) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])


@query("op12_filter_audit", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
first AS (SELECT text, min(doc_id) AS first_id FROM words GROUP BY 1),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY 1),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS mask
  FROM words JOIN first USING (text) LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM judged GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
prefixes AS (
  SELECT '' AS prefix, '' AS letter, 0 AS before, 0 AS applied, 0 AS step
  UNION ALL
  SELECT prefix || l.letter, l.letter, applied, applied + l.bit, step + 1 FROM prefixes JOIN letters l ON (applied & l.bit) = 0),
rows AS (
  SELECT part, o.prefix AS filter_order, p.step, p.letter,
    sum(CASE WHEN mask & p.applied = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & p.before = 0 AND mask & p.applied <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & p.before <> 0 AND mask & (p.applied - p.before) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = p.applied - p.before THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & p.before = 0 AND mask & p.applied <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & p.before = 0 AND mask & p.applied <> 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM prefixes o JOIN prefixes p ON o.step = 5 AND p.step > 0 AND starts_with(o.prefix, p.prefix) CROSS JOIN cells GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM rows""")
def op12(spark, sf_dir):
    """Five filters over all documents, in all 120 orders."""
    return audit(mask_cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "ABCDE")
