"""Registered queries against their SQL in DuckDB.

By default a few queries of each kind run; RANKLOOM_ALL_QUERIES=1 runs all of
them, RANKLOOM_SF picks the data set.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from rankloom.catalog import load

SF = os.environ.get("RANKLOOM_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SAMPLE = ("a11_match_history_payload", "a14_page_game_entry", "b11_team_id", "b29_text_redaction", "c02_fallback_link", "c11_renamed_teams",
          "c13_integrity_report", "d07_validation_report", "d10_age_gender_cube", "e03_outlier_guard", "g04_components_of_a_week",
          "r13_ranking", "s06_running_totals", "u04_likely_same_pairs")
NAMES = sorted(load().SQL) if os.environ.get("RANKLOOM_ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return str(v)
    return repr(float(v) + 0.0) if isinstance(v, (int, float)) else str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = load().QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted(tuple(_cell(v) for v in r) for r in df.select(*columns).collect())
    relation = duck.sql(load().SQL[name])
    assert sorted(relation.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(tuple(_cell(v) for v in r) for r in duck.sql(f"SELECT {picked} FROM relation").fetchall())
    assert found == expected


def test_every_query_has_sql_and_every_sql_a_query():
    assert set(load().QUERIES) == set(load().SQL) <= set(entry.oracle_sql()) and set(load().QUERIES) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "component_size" in df.columns
