"""Identifiers: gender, age, deterministic team id, canonical ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.strings import strip


def gender_code(raw: Column) -> Column:
    """M or F; null for anything that is neither."""
    text = F.lower(strip(raw.cast("string")))
    return F.when(text.isin("m", "male", "1", "1.0"), "M").when(text.isin("f", "female", "0", "0.0"), "F")


def age_number(raw: Column) -> Column:
    """First run of digits as a whole number from 10 to 18; null otherwise."""
    digits = F.regexp_extract(raw.cast("string"), "([0-9]+)", 1)
    age = digits.try_cast("int")
    return F.when(age.between(10, 18), age)


def team_id(name: Column, state: Column, age: Column, gender: Column) -> Column:
    """Twelve hex digits that depend on name, state, age and gender only.

    Null when one of the parts is missing or not valid.
    """
    clean_name = F.lower(strip(name))
    clean_state = F.upper(strip(state))
    number, code = age_number(age), gender_code(gender)
    valid = (
        clean_name.isNotNull() & (clean_name != "") & (F.length(clean_state) == 2)
        & number.isNotNull() & code.isNotNull()
    )
    text = F.concat_ws("|", clean_name, clean_state, number.cast("string"), code)
    return F.when(valid, F.substring(F.sha1(text.cast("binary")), 1, 12))


def reject_reason(name: Column, state: Column, age: Column, gender: Column) -> Column:
    """Why ``team_id`` would be null, or null when it would not."""
    clean_state = F.coalesce(strip(state), F.lit(""))
    return (
        F.when(age_number(age).isNull(), "age")
        .when(gender_code(gender).isNull(), "gender")
        .when(F.coalesce(strip(name), F.lit("")) == "", "name")
        .when(clean_state == "", "state_empty")
        .when(F.length(clean_state) != 2, "state_length")
    )


def canonical_id(raw: Column) -> Column:
    """Trimmed id text without the ``.0`` a float column leaves behind; blank is null."""
    text = F.regexp_replace(strip(raw.cast("string")), "\\.0$", "")
    return F.when(text != "", text)


def spread_null(key: Column, *by: str) -> Column:
    """Join key whose missing values differ from row to row: they match nothing and do not pile up in one task."""
    return F.coalesce(key, F.concat(F.lit("\x00"), F.xxhash64(*by).cast("string")))


def resolve_alias(df: DataFrame, col: str, aliases: DataFrame | None) -> DataFrame:
    """Replace ``col`` by its canonical id, through ``aliases`` (alias_id, canonical_id) if given."""
    df = df.withColumn(col, canonical_id(F.col(col)))
    if aliases is None:
        return df
    pairs = aliases.select(F.col("alias_id").alias("_alias"), F.col("canonical_id").alias("_target"))
    return (
        df.join(pairs, F.col(col) == F.col("_alias"), "left")
        .withColumn(col, F.coalesce("_target", col))
        .drop("_alias", "_target")
    )
