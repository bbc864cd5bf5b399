"""Map the driver's test tables to games and teams (for queries, tests and the benchmark only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.games import result_code
from rankloom.schemas import US_STATES

STATES_BY_NATION = US_STATES[:25]
# Feed states by nation: plain, regional, foreign, missing and malformed codes.
FEED_STATES = ("AZ", "CA", "CAS", "CAN", "TXN", "TX", "NY", "NYE", "MEX", "ON", "FL", "GA", "OH", "PAE", "PA",
               "WA", "OR", "CO", "UT", "NV", "", None, "X", "USA", "IL")
FEED_GENDERS = ("Male", "F", "m", "1.0", "female", "0", "X")
FEED_PROVIDERS = ("GotSport", "Modular11", "AthleteOne")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def as_of(spark: SparkSession, sf_dir: str) -> str:
    """Day after the newest ship date: one value, from one column."""
    newest = table(spark, sf_dir, "lineitem").agg(F.date_add(F.max(F.to_date("l_shipdate")), 1)).first()[0]
    return newest.isoformat()


def game_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a game of its supplier.

    Some suppliers play rarely (their dates are spread out), some stopped long
    ago; some opponents are missing, unknown, have a ``.0`` tail or an alias.
    """
    lines, suppliers = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    n = suppliers.agg(F.count("*")).scalar()
    newest = lines.agg(F.max(F.to_date("l_shipdate"))).scalar()
    kind = F.col("l_suppkey") % 10
    spread = F.when(kind == 3, 12).when(kind == 4, 6).when(kind == 5, 4).otherwise(1)
    shipped = F.to_date("l_shipdate")
    back = F.datediff(newest, shipped) * (spread - 1) + F.when(kind == 6, 200).otherwise(0)
    opp = F.col("l_partkey") % n
    opp_text = opp.cast("string")
    pk = F.col("l_partkey")
    opp_id = (
        F.when(pk % 37 == 0, F.lit(None).cast("string"))
        .when(pk % 41 == 0, F.concat(F.lit("X"), opp_text))
        .when(pk % 43 == 0, F.concat(opp_text, F.lit(".0")))
        .when(pk % 47 == 0, F.concat(F.lit("A"), opp_text))
        .otherwise(opp_text)
    )
    gf = F.when(F.col("l_quantity") >= 49, 15).otherwise(F.col("l_quantity").cast("int") % 8).cast("double")
    ga = ((F.col("l_partkey") + F.col("l_linenumber")) % 6).cast("double")
    sk = F.col("s_suppkey")
    return (
        lines.where(opp != F.col("l_suppkey"))
        .join(suppliers, F.col("l_suppkey") == sk)
        .select(
            F.col("l_suppkey").cast("string").alias("team_id_master"),
            opp_id.alias("opponent_id_master"),
            F.col("s_name").alias("team"),
            F.concat(F.lit("Supplier#"), F.lpad(opp_text, 9, "0")).alias("opponent"),
            F.when(sk % 6 != 0, F.concat(F.lit("Club "), (F.col("s_nationkey") % 7).cast("string"))).alias("club"),
            pick(STATES_BY_NATION, F.col("s_nationkey")).alias("state"),
            F.when(sk % 2 == 0, "M").otherwise("F").alias("gender"),
            F.concat(F.lit("U"), (10 + sk % 9).cast("string")).alias("age_group"),
            F.date_sub(shipped, back.cast("int")).alias("date"),
            gf.alias("gf"), ga.alias("ga"),
            F.when(F.col("l_linestatus") == "O", "H").otherwise("A").alias("home_away"),
            result_code(gf, ga).alias("result"),
            F.concat(F.lit("2001 Cup "), F.col("l_returnflag")).alias("competition"),
        )
    )


def game_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games as raw feed rows: all text, some scores and dates damaged."""
    g = game_norm(spark, sf_dir)
    day = F.date_format("date", "yyyy-MM-dd")
    gf_text = F.col("gf").cast("int").cast("string")
    return g.select(
        F.lit("feed").alias("provider"),
        F.concat(F.lit("S"), "team_id_master").alias("team_id_source"),
        "team_id_master",
        F.col("team").alias("team_name"),
        F.col("club").alias("club_name"),
        F.col("opponent").alias("opponent_name"),
        F.col("opponent_id_master").alias("opponent_id"),
        "age_group", "gender", "state",
        F.when(F.dayofmonth("date") == 31, "not a date").otherwise(day).alias("game_date"),
        "home_away",
        F.when(F.col("gf") == 7, F.lit(None).cast("string")).when(F.col("gf") == 6, "n/a").otherwise(gf_text).alias("goals_for"),
        F.col("ga").cast("int").cast("string").alias("goals_against"),
        "result", "competition",
        F.concat(F.lit("Field "), F.col("ga").cast("int").cast("string")).alias("venue"),
        F.when(F.col("ga") == 5, "Mesa").otherwise("").alias("city"),
        F.concat(F.lit("https://feed.example.com/teams/"), "team_id_master").alias("source_url"),
        F.concat(day, F.lit("T10:00:00Z")).alias("scraped_at"),
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias id -> team id for the even suppliers."""
    sk = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").where(sk % 2 == 0).select(
        F.concat(F.lit("A"), sk.cast("string")).alias("alias_id"), sk.cast("string").alias("canonical_id")
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw team rows of three feeds; every fourth also appears in the next feed."""
    ck = F.col("c_custkey")
    copies = F.explode(F.when(ck % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = table(spark, sf_dir, "customer").withColumn("copy", copies)
    name = F.concat(
        F.initcap(F.lower("c_mktsegment")), F.lit(" FC District "), (ck % 13).cast("string"),
        F.lit(" Squad "), F.expr("c_custkey div 2").cast("string"),
    )
    provider = pick(FEED_PROVIDERS, (ck + F.col("copy")) % 3)
    return rows.select(
        F.when(ck % 101 == 0, F.lit(None).cast("string")).when(ck % 103 == 0, "  ").otherwise(name).alias("team_name"),
        F.concat(F.lit("U"), (8 + F.expr("c_custkey div 2") % 12).cast("string")).alias("age_group"),
        pick(FEED_GENDERS, F.expr("c_custkey div 2") % 7).alias("gender"),
        pick(FEED_STATES, F.col("c_nationkey")).alias("state"),
        F.when(ck % 5 != 0, F.concat(ck.cast("string"), F.lit(".0"))).alias("team_id"),
        (ck % 500).cast("int").alias("rank"),
        F.floor("c_acctbal").cast("long").alias("points"),
        F.concat(provider, F.lit(" Rankings")).alias("source"),
        provider.alias("provider"),
        F.when(ck % 3 == 0, F.concat(F.lit("Club "), (ck % 11).cast("string"))).alias("club_name"),
        F.concat(F.lit("https://feed.example.com/team/"), ck.cast("string")).alias("url"),
        F.date_format(F.date_sub(F.lit("2001-11-05").cast("date"), (ck % 300).cast("int")), "yyyy-MM-dd").alias("last_seen_active_date"),
        ck.alias("custkey"), F.col("copy").cast("int").alias("copy"),
    )
