"""Disk of a run: lines are exchanged once, stored once, and a table is on disk twice at most."""

import os
import re

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tillroll.operators import sinks
from tillroll.functions.keys import packed_hex
from tillroll.operators.quality import Rule
from tillroll.operators.staging import Workspace
from tillroll.plans import clean, pipeline, schemas, star
from tillroll.plans.layers import Layers
from tillroll.session import child_names, pieces_of, shuffled_into, splits_of
from tillroll.sources import feeds

ROWS = schemas.ddl("k string, v int, m date")


def rows(spark, *data):
    return spark.createDataFrame(data, "k string, v int, m string").withColumn("m", F.to_date("m"))


def content(spark, path):
    return sorted((str(r["k"]), r["v"], str(r["m"])) for r in sinks.read_table(spark, path, ROWS).collect())


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_by_month_are_exchanged_once(spark, delivered):
    lines = ["1;x ;2;3/4/2031 10:00;7", "1;X;2;3/4/2031 10:00;7", "~;X;2;3/4/2031 10:00;7", "2;Y;;;", "2;Y;~;~;~", "3;X;1;1/1/2011 1:00;5|6", "3;X;1;1/1/2011 1:00|5;6"]
    bronze = delivered("orders", *lines).unionByName(delivered("orders", *lines[:2], load=2))
    files = feeds.files(spark, "orders")
    want = clean.clean_orders(bronze, files).withColumn("month", sinks.month_partition("invoice_ts")[1])
    for names, pieces in ((files, None), (None, None), (files, 5)):
        got = clean.orders_by_month(bronze, "month", names, pieces)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        assert physical(got).count("rangepartitioning(month") == 1 and set(re.findall(r"hashpartitioning\((\w+)#", physical(got))) <= {"_file"}
        assert "sha2" not in physical(got)[physical(got).index("rangepartitioning") :]


def test_a_merge_does_not_exchange_the_rows_of_the_table(spark, tmp_path, monkeypatch):
    path, written = str(tmp_path / "t"), []
    sinks.upsert(spark, rows(spark, ("a", 1, "2020-01-01"), ("b", 1, "2020-02-01"), ("c", 1, "2020-03-01"), (None, 1, "2020-03-01")), path, ROWS, ["k"], "m")
    add = sinks.add_parts
    monkeypatch.setattr(sinks, "add_parts", lambda df, *a: written.append(physical(df)) or add(df, *a))
    sinks.upsert(spark, rows(spark, ("b", 2, "2020-02-01"), ("d", 2, "2020-03-01"), (None, 2, "2020-03-01")), path, ROWS, ["k"], "m")
    assert len(written) == 2 and "BroadcastHashJoin" in written[1] and "partitioning(" not in written[1]
    assert content(spark, path) == [("None", 1, "2020-03-01"), ("None", 2, "2020-03-01"), ("a", 1, "2020-01-01"), ("b", 2, "2020-02-01"), ("c", 1, "2020-03-01"), ("d", 2, "2020-03-01")]


@pytest.mark.parametrize("most", [0, 1, 2, 100])
def test_a_merge_by_groups_of_partitions_is_the_merge(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(sinks, "BROADCAST_KEYS", most)
    path = str(tmp_path / "t")
    sinks.upsert(spark, rows(spark, *((f"{m}{i}", 1, f"2020-0{m}-01") for m in (1, 2, 3) for i in range(4)), ("n", 1, None)), path, ROWS, ["k"], "m")
    sinks.upsert(spark, rows(spark, ("10", 2, "2020-01-01"), ("11", 2, "2020-01-01"), ("30", 2, "2020-03-01"), ("n", 2, None), ("z", 2, "2020-04-01")), path, ROWS, ["k"], "m")
    got = {k: v for k, v, _ in content(spark, path)}
    assert len(content(spark, path)) == 14 and {k for k, v in got.items() if v == 2} == {"10", "11", "30", "n", "z"}


def test_groups_hold_every_partition_once():
    assert sinks.groups_up_to({"b": 2, None: 1, "a": 3, "c": 9, "d": 1}, 4) == [[None, "a"], ["b"], ["c"], ["d"]]
    assert sinks.groups_up_to({}, 4) == []


def test_a_refused_source_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, rows(spark, ("a", 1, "2020-01-01")), path, ROWS, ["k"], "m")
    with pytest.raises(ValueError, match="repeats the key"):
        sinks.upsert(spark, rows(spark, ("a", 2, "2020-01-01"), ("a", 3, "2020-01-01")), path, ROWS, ["k"], "m")
    assert content(spark, path) == [("a", 1, "2020-01-01")] and len([n for n in os.listdir(path) if n.startswith("_parts-")]) == 1


def test_a_table_is_on_disk_twice_at_most(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(3):
        sinks.replace(rows(spark, ("a", n, "2020-01-01")), path, ["m"], ["k"])
    assert len([n for n in os.listdir(path) if n.startswith("version-")]) == 2
    sinks.new_parts(spark, path)  # a new version is begun
    assert len([n for n in os.listdir(path) if n.startswith("version-")]) == 1 and content(spark, path) == [("a", 2, "2020-01-01")]


def test_a_load_is_made_alone(spark):
    layers = Layers(spark, SF001)
    for load in (1, 2):
        whole = layers.bronze("orders").filter(F.col("_source_file") == f"orders_{load}.csv")
        assert sorted(map(str, layers.delivery("orders", load).select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    assert "explode" not in physical(layers.delivery("orders", 2)).lower()


def test_splits_and_pieces_follow_the_bytes(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with splits_of(spark, 1000):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1000"
    with splits_of(spark, 1 << 50):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(128 << 20)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert pieces_of(spark, 1 << 20) is None and pieces_of(spark, 400 << 20) == 200


ORDERS = "no,code,n,when,who\n" + "".join(f"{i},K{i % 7},{i % 4},{1 + i % 9}/3/2030 9:00,{i % 5}\n" for i in range(200)) + "x,K1,1,44/3/2030 9:00,1\n"
PRICES = "code,name,price\n" + "".join(f"K{k},THING {k},{k + 1}.50\nK{k},,{k + 1}.25\n" for k in range(6))


def run_of(spark, tmp_path, monkeypatch, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(pipeline, name, value)
    landing, wh = tmp_path / "landing", pipeline.Warehouse(str(tmp_path / "wh"))
    for name, text in {"customers_1.csv": "id,land\n1,Peru\n", "products_1.csv": PRICES, "orders_1.csv": ORDERS}.items():
        landing.mkdir(exist_ok=True)
        (landing / name).write_text(text)
    run = pipeline.Run(spark, wh, str(landing), "r")
    run.run()
    return run


@pytest.mark.parametrize("sizes", [{}, {"GROUP_BYTES": 1}, {"GROUP_BYTES": 20_000, "LARGE_MONTH": 0}])
def test_the_fact_by_groups_of_months_is_the_fact(spark, tmp_path, monkeypatch, sizes):
    written, add = [], sinks.add_parts
    monkeypatch.setattr(sinks, "add_parts", lambda df, path, *a: written.append(path) or add(df, path, *a))
    run = run_of(spark, tmp_path, monkeypatch, **sizes)
    months = len(run.month_bytes("silver.orders"))
    of_fact = [p for p in written if p.endswith("gold/fact_sales")]
    assert months == 9 and (len(of_fact) == 1 if not sizes else len(of_fact) == 9 if sizes["GROUP_BYTES"] == 1 else 1 < len(of_fact) < 9)
    want = star.fact_sales(run.read("silver.orders").drop("invoice_month"), run.read("gold.dim_product"))
    good = want.filter("product_key IS NOT NULL AND line_amount IS NOT NULL")
    assert sorted(map(str, run.read("gold.fact_sales").select(*want.columns).collect())) == sorted(map(str, good.collect()))
    log = run.read("ops.run_log").filter("table_name = 'gold.fact_sales'").first()
    lost = run.read("dq.quarantine").filter("table_name = 'gold.fact_sales'")
    assert (log["rows_total"], log["rows_published"], log["rows_quarantined"]) == (want.count(), good.count(), lost.count()) and lost.count() > 0
    assert '"invoice_month":"2030-' in lost.first()["record"] and {tuple(r["failed_rules"]) for r in lost.collect()} == {("product_found",)}
    results = run.read("dq.results").filter("table_name = 'gold.fact_sales' AND rule = 'product_found'").first()
    assert (results["failed_rows"], results["total_rows"]) == (lost.count(), want.count())


def test_lines_are_stored_once_and_rejected_ones_go_to_quarantine(spark, tmp_path, monkeypatch):
    staged, stage = [], Workspace.stage
    monkeypatch.setattr(Workspace, "stage", lambda self, df, name: staged.append(name) or stage(self, df, name))
    run = run_of(spark, tmp_path, monkeypatch)
    assert not [n for n in staged if n in ("silver_orders", "gold_fact_sales", "source") or n.endswith("_month")]
    path = run.wh.path("silver.orders")
    folder = next(n for n in child_names(spark, path) if n.startswith("_parts-"))
    assert [n for n in child_names(spark, f"{path}/{folder}") if "=" in n] == ["_rejected=false"]
    record = run.read("dq.quarantine").filter("array_contains(failed_rules, 'invoice_ts_valid')").first()["record"]
    assert '"invoice_no":"X"' in record and "invoice_month" not in record and "_rejected" not in record
    assert run.read("silver.orders").filter("quantity = 0 OR invoice_ts IS NULL").isEmpty()


def test_a_table_without_good_rows_is_empty(spark, tmp_path):
    run = pipeline.Run(spark, pipeline.Warehouse(str(tmp_path)), str(tmp_path / "in"), "r")
    rows = spark.createDataFrame([(1,), (2,)], "a int").withColumn("invoice_month", F.to_date(F.lit("2030-01-01")))
    schema = schemas.ddl("a int, invoice_month date")
    path = run.wh.path("silver.orders")
    for rule, left in (("a > 0", 2), ("a > 5", 0)):
        out = run.publish_months("silver.orders", [rows], (Rule("r", rule),), ["a"], ["a"], lambda folder: sinks.switch_parts(spark, path, folder, whole=True))
        assert (out.rows, out.rows - out.quarantined) == (2, left) and sinks.read_table(spark, path, schema).count() == left
    assert sinks.merge_parts(spark, path, "_parts-none", schema, ["a"], "invoice_month") == []


def test_keys_are_packed_and_other_texts_stay(spark, silver):
    texts = ["00ff" * 16, "00FF", "abc", "", "K1", "zz", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(packed_hex("t").alias("b")).collect()
    assert [None if r["b"] is None else r["b"].hex() for r in got] == ["00ff" * 16, None, None, "", None, None, None]


def test_exchanges_have_pieces_that_adaptive_execution_may_join(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with shuffled_into(spark, 77):
        assert spark.conf.get(name) == "77"
    with shuffled_into(spark, 1):
        assert spark.conf.get(name) == spark.conf.get("spark.sql.shuffle.partitions")
    assert spark.conf.get(name, None) is None
