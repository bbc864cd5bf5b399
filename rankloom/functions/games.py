"""Expressions on single game records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom.functions.strings import strip


def flexible_date(text: Column) -> Column:
    """First of year-month-day, month/day/year, month/day/short year, then any ISO timestamp.

    Short years run from 1969 to 2068.
    """
    clean = strip(text)
    short = F.when(clean.rlike("/[0-9]{2}$"), F.try_to_date(clean, "M/d/yy"))
    return F.coalesce(
        F.try_to_date(clean, "yyyy-MM-dd"),
        F.when(clean.rlike("/[0-9]{4}$"), F.try_to_date(clean, "M/d/yyyy")),
        F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short),
        clean.try_cast("timestamp").cast("date"),
    )


def iso_date(text: Column) -> Column:
    """Date part of ISO text; null when it does not parse.

    The cast reads plain days as well. One short expression: filters on it are copied below joins and must stay small enough
    to be compiled.
    """
    return text.try_cast("timestamp").cast("date")


def result_code(goals_for: Column, goals_against: Column) -> Column:
    return (
        F.when(goals_for.isNull() | goals_against.isNull(), "U")
        .when(goals_for > goals_against, "W")
        .when(goals_for < goals_against, "L")
        .otherwise("D")
    )


def parse_result_text(text: Column) -> Column:
    """Struct (goals_for, goals_against, home_away, result) from text like ``W 3-1 (H)``."""
    up = F.upper(strip(F.coalesce(text, F.lit(""))))
    pattern = r"([0-9]+)\s*[-:]\s*([0-9]+)"
    side = F.when(F.contains(up, F.lit("(H)")), "H").when(F.contains(up, F.lit("(A)")), "A").otherwise("H")
    head = F.substring(up, 1, 1)
    return F.struct(
        F.regexp_extract(up, pattern, 1).try_cast("int").alias("goals_for"),
        F.regexp_extract(up, pattern, 2).try_cast("int").alias("goals_against"),
        side.alias("home_away"),
        F.when(head.isin("W", "L", "D"), head).otherwise("U").alias("result"),
    )


def opponent_from_title(title: Column, team_name: Column, fallback: Column) -> Column:
    """The side of ``A vs. B`` that is not the team; else the given name; else Unknown."""
    parts = F.split(title, " vs\\. ")
    left, right = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    other = F.when(F.contains(left, team_name), right).when(F.contains(right, team_name), left)
    named = F.when(F.size(parts) == 2, other)
    named = F.when(named != "", named)
    return F.coalesce(named, fallback, F.lit("Unknown"))
