"""Name-similarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom import adapters as A
from rankloom.catalog.base import query, rounded
from rankloom.catalog.links import jaccard_sql
from rankloom.catalog.sql import scored_sql, tokens
from rankloom.functions import text
from rankloom.operators import clean, delta, identity, matching

# Two names per part: the product name and a reordered or altered variant.
PAIRS = """
SELECT p_partkey, p_name AS a, CASE p_partkey % 4 WHEN 0 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) WHEN 1 THEN p_name || ' jr'
  WHEN 2 THEN lower(p_type) || ' ' || split_part(p_name, ' ', 2) ELSE p_brand END AS b FROM part"""


def _pairs(spark, sf):
    k = F.col("p_partkey") % 4
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    other = F.when(k == 0, F.concat(word(2), F.lit(" "), word(1))).when(k == 1, F.concat("p_name", F.lit(" jr"))).when(
        k == 2, F.concat(F.lower("p_type"), F.lit(" "), word(2))).otherwise(F.col("p_brand"))
    return A.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("a"), other.alias("b"))


def _sorted_sql(c: str) -> str:
    return f"array_to_string(list_sort(string_split({c}, ' ')), ' ')"


# Longest common subsequence as a fold over the characters of x: each step keeps the running maximum row.
RATIO_SQL = f"""
WITH p AS ({PAIRS}), d AS (SELECT DISTINCT a, b, {_sorted_sql('a')} AS x, {_sorted_sql('b')} AS y FROM p),
l AS (SELECT a, b, x, y, list_reduce(string_split(x, ''), lambda row, ch: list_transform(range(1, length(y) + 2), lambda j:
        CASE WHEN j = 1 THEN 0 ELSE list_max(list_transform(range(2, j + 1), lambda i: greatest(row[i], row[i - 1] + CASE WHEN y[i - 1] = ch THEN 1 ELSE 0 END))) END),
        list_transform(range(0, length(y) + 1), lambda z: 0)) AS last FROM d),
s AS (SELECT a, b, 2.0::DOUBLE * last[length(y) + 1] / (length(x) + length(y)) AS score FROM l)
"""


@query("u01_token_sort_ratio", RATIO_SQL + "SELECT p_partkey, p.a, p.b, round(score, 6) AS score FROM p JOIN s USING (a, b)")
def u01(spark, sf):
    p = _pairs(spark, sf)
    return rounded(p.select("p_partkey", "a", "b", text.token_sort_ratio(F.col("a"), F.col("b")).alias("score")), "score")


@query("u01_containment_fallback", f"""
SELECT p_partkey, CASE WHEN lower(trim(a)) = lower(trim(b)) THEN 1.0 WHEN contains(lower(trim(a)), lower(trim(b))) OR contains(lower(trim(b)), lower(trim(a))) THEN 0.8 ELSE 0.0 END::DOUBLE AS score
FROM ({PAIRS}) p""")
def u01_containment(spark, sf):
    return _pairs(spark, sf).select("p_partkey", text.containment_score(F.col("a"), F.col("b")).alias("score"))


@query("u02_edit_similarity", f"SELECT p_partkey, round(1 - levenshtein(a, b)::DOUBLE / greatest(length(a), length(b)), 6) AS score FROM ({PAIRS}) p")
def u02(spark, sf):
    return rounded(_pairs(spark, sf).select("p_partkey", text.edit_similarity(F.col("a"), F.col("b")).alias("score")), "score")


# For every altered name the most similar product name of its size and kind.
_BLOCKED = f"SELECT p.p_size AS size, p.p_type AS kind, q.a, q.b FROM ({PAIRS}) q JOIN part p USING (p_partkey)"


@query("u02_best_match", f"""
WITH n AS ({_BLOCKED}), l AS (SELECT DISTINCT size, kind, b FROM n), r AS (SELECT DISTINCT size, kind, a FROM n),
s AS ({scored_sql("SELECT size, kind, l.b AS a, r.a AS b FROM l JOIN r USING (size, kind) WHERE l.b <> r.a")})
SELECT size, kind, left_name, right_name, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY size, kind, left_name ORDER BY round(score, 9) DESC, right_name) AS rn FROM (
    SELECT size, kind, a AS left_name, b AS right_name, score FROM s UNION ALL SELECT size, kind, b, a, 1.0 FROM l JOIN r USING (size, kind) WHERE l.b = r.a) u
  WHERE round(score, 9) > 0.7) x WHERE rn = 1""")
def u02_best(spark, sf):
    parts = A.table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("size"), F.col("p_type").alias("kind"))
    named = _pairs(spark, sf).join(parts, "p_partkey")
    sides = [named.select("size", "kind", F.col(c).alias("team_name")) for c in ("b", "a")]
    return rounded(matching.best_matches(*sides, ["size", "kind"], 0.7), "score")


@query("u03_token_jaccard", f"SELECT p_partkey, round({jaccard_sql(f'list_distinct({tokens(chr(97))})', f'list_distinct({tokens(chr(98))})')}, 6) AS score FROM ({PAIRS}) p")
def u03(spark, sf):
    return rounded(_pairs(spark, sf).select("p_partkey", text.name_similarity(F.col("a"), F.col("b")).alias("score")), "score")


@query("u04_likely_same_pairs", f"""
SELECT a.state, a.gender, a.age_group, a.team_name AS left_name, b.team_name AS right_name, round({jaccard_sql('a.w', 'b.w')}, 6) AS score
FROM (SELECT DISTINCT state, gender, age_group, team_name, list_distinct({tokens('team_name')}) AS w FROM master) a
JOIN (SELECT DISTINCT state, gender, age_group, team_name, list_distinct({tokens('team_name')}) AS w FROM master) b USING (state, gender, age_group)
WHERE {jaccard_sql('a.w', 'b.w')} >= 0.6 AND a.team_name < b.team_name""")
def u04(spark, sf):
    m = clean.migrate_master(A.feed(spark, sf), "2001-11-05T00:00:00").where("team_id IS NOT NULL")
    found = delta.similar_names(m, m, ["state", "gender", "age_group"], 0.6)
    return rounded(found.where("left_name < right_name"), "score")


@query("u04_likely_same_flag", f"""
SELECT p_partkey, {jaccard_sql(f'list_distinct({tokens(chr(97))})', f'list_distinct({tokens(chr(98))})')} >= 0.7 AS same FROM ({PAIRS}) p""")
def u04_flag(spark, sf):
    return _pairs(spark, sf).select("p_partkey", text.likely_same(F.col("a"), F.col("b")).alias("same"))


def _audit(spark, sf):
    """Parts as identities: the product name, with one alias each."""
    ids = _pairs(spark, sf).select(
        F.col("p_partkey").cast("string").alias("team_id"), F.col("a").alias("canonical_name"), F.array("b").alias("aliases"),
        F.date_format(F.date_sub(F.lit("2001-11-05").cast("date"), (F.col("p_partkey") % 30).cast("int")), "yyyy-MM-dd").alias("updated_at"))
    return identity.audit_aliases(ids)


@query("d23_alias_audit", RATIO_SQL + """
SELECT p_partkey::VARCHAR AS team_id, p.a AS canonical_name, p.b AS alias, round(score, 6) AS similarity_score, score < 0.85 AS review_flag FROM p JOIN s USING (a, b)""")
def d23(spark, sf):
    audit = identity.audit_report(_audit(spark, sf))
    return rounded(audit.select("team_id", "canonical_name", "alias", "similarity_score", "review_flag"), "similarity_score")


@query("d24_weekly_review", RATIO_SQL + """
SELECT count(*) FILTER (score < 0.85) AS flagged_count, count(DISTINCT p_partkey) FILTER (p_partkey % 30 <= 7) AS new_teams_this_week, count(*) AS total_entries,
       round(avg(score), 3) AS avg_similarity FROM p JOIN s USING (a, b)""")
def d24(spark, sf):
    return identity.weekly_review(_audit(spark, sf), F.lit("2001-11-05").cast("date"))


@query("d24_lowest_similarity", RATIO_SQL + """
SELECT p_partkey::VARCHAR AS team_id, round(score, 6) AS similarity_score FROM p JOIN s USING (a, b) WHERE score < 0.85
ORDER BY score, p_partkey::VARCHAR, p.b LIMIT 10""")
def d24_lowest(spark, sf):
    return rounded(identity.lowest_similarity(_audit(spark, sf)).select("team_id", "similarity_score"), "similarity_score")
