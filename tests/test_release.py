"""Release checks and staged tables, each case that must fail among them."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tessarea.operators import release
from tessarea.operators.expect import ExpectationError
from tessarea.operators.neighbours import neighbour_graph
from tessarea.operators.stage import Stage


@pytest.fixture(scope="module")
def grid(spark):
    """A 12 x 12 grid; the left half is of one source. Values are even but for a step at the middle in ``seam``."""
    rows = [(12 * i + j, 40 + i / 100, -75 + j / 100, "a" if j < 6 else "b", 50.0 + (i * 7 + j * 5) % 6, (20.0 if j < 6 else 400.0) + (i * 7 + j * 5) % 6) for i in range(12) for j in range(12)]
    return spark.createDataFrame(rows, "id long, lat double, lon double, source string, even double, seam double").cache()


def kinds():
    return {"same": F.col("a_source") == F.col("b_source"), "cross": F.col("a_source") != F.col("b_source")}


def test_jumps_between_sources(grid):
    pairs = release.each_once(neighbour_graph(grid.select("id", "lat", "lon"), 4), 5.0)
    check = lambda value: release.jumps("seam", release.pair_gaps(grid, pairs, value, kinds(), ["source"]), "same", 3.0, 0.5, 5, 20)
    assert release.require(["seam"], check("even"))["seam"] > 0
    with pytest.raises(ExpectationError, match="cross"):
        release.require(["seam"], check("seam"))
    with pytest.raises(ExpectationError, match="nothing to compare"):
        release.require(["seam", "other"], check("even"))
    with pytest.raises(ExpectationError, match="nothing to compare"):
        release.require(["seam"], release.jumps("seam", release.pair_gaps(grid, pairs.limit(0), "even", kinds(), ["source"]), "same", 3.0, 0.5, 5, 20))


def test_flat_groups_and_implausible_rates(grid):
    flat = grid.withColumns({"v": F.when(F.col("source") == "a", 7.0).otherwise(F.col("id").cast("double")), "one": F.lit(1.0)})
    rows = {r.subject: r.breach for r in release.flatness("flat", flat, "source", "v", "one", 5, 10.0, 0.1, 1.0).collect()}
    assert rows == {"a": True, "b": False}
    people = grid.withColumns({"count": F.when(F.col("source") == "a", 3).otherwise(900), "people": F.lit(1000)})
    rows = {r.subject: r.breach for r in release.plausible("county", people, "source", "count", "people", 10.0, 20_000.0).collect()}
    assert rows == {"a": False, "b": True}
    hot = grid.withColumns({"v": F.when(F.col("id") == 5, 9_000.0).otherwise(F.col("even")), "people": F.when(F.col("id") == 5, 1.0).otherwise(500.0)})
    assert {r.subject for r in release.hotspots("hot", hot, "v", "people", 1.5).filter("breach").collect()} == {"5", "all"}
    assert not release.hotspots("hot", grid.withColumn("people", F.lit(500.0)), "even", "people", 3.0).filter("breach").count()


def test_shared_borders(spark):
    box = lambda x, y: [[(x, y), (x + 1.0, y), (x + 1.0, y + 1), (x, y + 1.0)]]
    table = spark.createDataFrame([(i, box(float(i % 3), float(i // 3))) for i in range(6)], "id long, rings array<array<struct<x: double, y: double>>>")
    found = {(r.id, r.id2): r.border for r in release.sharing_borders(table).collect()}
    assert found == {(0, 1): 1.0, (1, 2): 1.0, (3, 4): 1.0, (4, 5): 1.0, (0, 3): 1.0, (1, 4): 1.0, (2, 5): 1.0}


ROWS = [(1, "x", 0.4, 5.0, 5.0), (2, "x", 0.6, 1.0, 1.0), (3, "y", 1.0, 2.0, 2.0), (4, "bad", 0.0, 0.0, 0.0)]


def stage(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "id long, unit string, share double, left double, right double")
    made = Stage(df, ["id"]).drop("quarantine", F.col("unit") == "bad", 1).rule("positive", F.col("share") > 0).unique("ids", ["id"])
    return made.sums_to("shares", ["unit"], "share", 1.0, 1e-9).balanced("mass", ["unit"], "left", "right").within("small", ["unit"], "left", 100.0)


def test_a_sound_table_is_published(spark, tmp_path):
    path = str(tmp_path / "table")
    assert stage(spark).publish(path) == {"rows": 3, "quarantine": 1}
    assert spark.read.parquet(path).count() == 3
    assert stage(spark).publish(path)["rows"] == 3 and os.listdir(tmp_path) == ["table"]


@pytest.mark.parametrize(
    ("rows", "name"),
    [
        ([*ROWS, (3, "z", 1.0, 0.0, 0.0)], "ids"),
        ([*ROWS, (5, "y", 0.5, 0.0, 0.0)], "shares"),
        ([*ROWS, (6, "z", 1.0, 3.0, 4.0)], "mass"),
        ([*ROWS, (7, "z", 1.0, 300.0, 300.0)], "small"),
        ([*ROWS, (8, None, None, 0.0, 0.0)], "positive"),
        ([*ROWS, (9, "bad", 0.0, 0.0, 0.0)], "quarantine"),
        (ROWS[:3], "quarantine"),
    ],
)
def test_a_broken_table_is_not(spark, tmp_path, rows, name):
    path = str(tmp_path / "table")
    stage(spark).publish(path)
    with pytest.raises(ExpectationError, match=name):
        stage(spark, rows).publish(path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["table"]


def test_a_filter_that_was_not_run_is_found(spark, tmp_path):
    made, seen = stage(spark), Observation("witness")
    made.df = spark.createDataFrame(ROWS, "id long, unit string, share double, left double, right double").observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("unit") == "bad").alias("met"))
    made.watched = [("quarantine", seen)]
    with pytest.raises(ExpectationError, match="not run"):
        made.publish(str(tmp_path / "table"))
