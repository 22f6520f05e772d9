"""Checks over tables and runs, and recoding by a table, on their odd cases."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.functions.text import recode_by_table
from tillroll.operators import checks
from tillroll.operators.ranking import previous_in_group


def test_orphans_are_keys_without_a_row(spark):
    table = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(2,), (2,), (None,)], "d int")
    assert [tuple(r) for r in checks.orphans(table, "k", dim, "d").collect()] == [(1, 2)]
    assert checks.orphans(table.limit(0), "k", dim, "d").count() == 0


def test_the_row_before_equals_a_lag_over_the_group(spark):
    rnd = random.Random(4)
    data = [(k, o, rnd.choice((None, 1, 2, 3))) for k in ("hot", "cold", None) for o in rnd.sample(range(900), 400 if k == "hot" else 6)]
    df = spark.createDataFrame(data, "k string, o int, v int")
    got = previous_in_group(df, ["k"], ["o"], [F.shiftright("o", 4)], "v")
    want = df.withColumn("_previous", F.lag("v").over(Window.partitionBy("k").orderBy("o")))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_jumps_compare_with_the_version_before(spark):
    rows = [("a", 1, "1.00"), ("a", 3, "3.00"), ("a", 4, "9.01"), ("a", 5, "3.00"), ("a", 6, None), ("b", 1, "9.00")]
    versions = spark.createDataFrame(rows, "stock_code string, version int, p string").selectExpr("stock_code", "version", "cast(p AS decimal(10,2)) AS unit_price")
    assert [(r["stock_code"], r["version"]) for r in checks.price_jumps(versions).orderBy("version").collect()] == [("a", 4), ("a", 5)]


def test_volume_is_compared_with_the_runs_before(spark):
    rows = [("r1", "t", 10), ("r2", "t", 31), ("r3", "t", 10), ("r3", "u", 4), ("r1", "v", 7), ("r2", "v", 14), ("r9", "t", None)]
    history = spark.createDataFrame(rows, "run_id string, table_name string, rows_total bigint")
    got = {r["table_name"]: (r["run_id"], r["rows_total"], r["usual_rows"], r["unusual"]) for r in checks.volume_changes(history).collect()}
    assert got == {"t": ("r3", 10, 20, False), "u": ("r3", 4, None, False), "v": ("r2", 14, 7, False)}
    assert checks.volume_changes(history, 60).filter("unusual").first()["table_name"] == "t"


def test_a_table_without_rows_is_stale(spark):
    rows = spark.sql("SELECT timestamp'2030-01-03 10:00:00' AS _ingested_at")
    got = checks.staleness({"a": rows, "b": rows.limit(0)}, F.lit("2030-01-05").cast("date"), 2).collect()
    assert [(r["table_name"], r["days"], r["stale"]) for r in sorted(got)] == [("a", 2, False), ("b", None, True)]


@pytest.mark.parametrize("most", [0, 100])
def test_recoding_by_a_table(spark, most):
    words = spark.createDataFrame([("x", "ex"), ("x", "an ex"), (None, "nothing"), ("y", None)], "k string, v string")
    df = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3), (None, 4)], "c string, k int")
    got = recode_by_table(df, "c", words, "k", "v", "out", most_entries=most)
    assert [tuple(r) for r in got.orderBy("k").collect()] == [("x", 1, "an ex"), ("y", 2, "y"), ("z", 3, "z"), (None, 4, None)]
    assert ("Join" in got._jdf.queryExecution().optimizedPlan().toString()) == (most == 0)
    other = recode_by_table(df, "c", words, "k", "v", "out", F.lit("?"), most_entries=most)
    assert [r["out"] for r in other.orderBy("k").collect()] == ["an ex", "?", "?", "?"]
    assert recode_by_table(df, "c", words.limit(0), "k", "v", "out", most_entries=most).count() == 4
