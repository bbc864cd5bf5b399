"""Physical plans keep the shape the jobs are designed for."""

import pytest
from pyspark.sql import functions as F

from rankloom import adapters as A
from rankloom.operators import delta, link
from rankloom.operators.windows import best_row
from rankloom.plans import ranking as R

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_selection_limits_each_team_before_the_shuffle(spark):
    text = plan(R.select_games(A.game_norm(spark, SF), R.run_spec("2001-11-05")))
    assert "Partial" in text.split("WindowGroupLimit", 1)[1] and text.count("WindowGroupLimit") == 2
    # One shuffle by team serves the limit, the outlier guard and the weights.
    assert text.count("Exchange hashpartitioning(team_id_master") == 1
    assert "l_extendedprice" not in text.split("FileScan", 1)[1]


def test_filters_reach_the_partitioned_scan(spark, tmp_path):
    path = str(tmp_path / "games")
    A.game_norm(spark, SF).write.partitionBy("state", "gender", "age_group").parquet(path)
    games = spark.read.parquet(path).where((F.col("state") == "AL") & (F.col("gender") == "M"))
    text = plan(R.within_window(games, F.lit("2001-11-05").cast("date"), 365).select("team_id_master", "gf"))
    scan = text[text.index("FileScan"):]
    assert "PartitionFilters: [isnotnull(state" in scan and "GreaterThanOrEqual(date" in scan
    assert "ga:double" not in scan[scan.index("ReadSchema"):]


def test_best_row_is_limited_before_the_shuffle(spark):
    text = plan(best_row(A.feed(spark, SF), ["team_name"], [F.asc("custkey")]))
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("make", [
    lambda s: delta.new_teams(A.feed(s, SF), A.feed(s, SF)),
    lambda s: R.schedule_strength(
        s.createDataFrame([("baseline", "1", "2")], "scenario string, team_id_master string, opponent_id_master string"),
        s.createDataFrame([("baseline", "1", 1.0, 1.0)], "scenario string, team_id_master string, sao_shrunk double, sad_shrunk double"),
        R.run_spec("2001-11-05"), A.aliases(s, SF)),
    lambda s: link.id_overlap(A.game_norm(s, SF), s.createDataFrame([("1",)], "team_id_master string")),
])
def test_no_nested_loops(spark, make):
    text = plan(make(spark))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
