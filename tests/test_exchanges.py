"""What is exchanged and stored between the steps: narrow lines, once, in pieces that don't grow."""

import re

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tillroll.functions.keys import content_hash, joined_text
from tillroll.operators import sinks, staging
from tillroll.plans import clean, schemas
from tillroll.plans.layers import Layers
from tillroll.session import child_names
from tillroll.sources import feeds


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def below_exchanges(df) -> str:
    """The plan from its first exchange between aggregates on."""
    text = physical(df)
    return text[text.index("Exchange hashpartitioning") :]


def staged_names(spark):
    return sorted(n.rsplit("-", 1)[0] for n in child_names(spark, staging.session_workspace(spark).root))


def test_a_hash_of_joined_texts_is_the_hash_of_the_texts(spark):
    data = [("1", "X", "2", "3/4", "7"), (None, "X", None, "", None), ("", "a|b", "c", None, "d|"), (None,) * 5]
    df = spark.createDataFrame(data, "a string, b string, c string, d string, e string")
    got = df.select(content_hash("a", "b", "c", "d", "e").alias("x"), content_hash("a", "b", joined_text("c", "d", "e")).alias("y"))
    assert all(r["x"] == r["y"] for r in got.collect())


def test_lines_are_grouped_and_priced_before_they_are_hashed(spark, delivered):
    lines = clean.order_lines(delivered("orders", "1;x ;2;3/4/2031 10:00;7", "1;X;2;3/4/2031 10:00;7", "~;X;2;3/4/2031 10:00;7"))
    assert "sha2" not in below_exchanges(lines)
    assert lines.count() == 2 and lines.select("order_line_id").distinct().count() == 2
    fact = Layers(spark, SF001).fact_sales
    assert "sha2" not in below_exchanges(fact)


def test_the_feed_join_has_a_piece_for_so_many_bytes(spark, monkeypatch):
    monkeypatch.setattr(feeds, "PIECE_BYTES", 8000)
    pieces = feeds.stored_bytes(spark, SF001, "lineitem", "orders") // 8000
    assert pieces >= 8
    lines = feeds.raw_orders(spark, SF001)
    assert len(re.findall(rf"hashpartitioning\([lo]_orderkey#\d+L, {pieces}\)", lines._jdf.queryExecution().executedPlan().toString())) == 2
    assert lines.count() == Layers(spark, SF001).bronze("orders").count()


def test_shared_lines_and_fact_are_made_once(spark):
    staging.release(spark)
    shared, alone = Layers(spark, SF001).share_lines().share_fact(), Layers(spark, SF001)
    assert staged_names(spark) == ["dim_product", "fact_for_marts", "lines", "silver_products"]
    for name in ("silver.orders", "gold.fact_sales"):
        text = optimized(shared.tagged(name))
        assert "l_orderkey" not in text
        count = [F.count(F.lit(1)), F.count_if("_rejected"), F.sum(F.size("_rules_failed"))]
        assert shared.tagged(name).agg(*count).first() == alone.tagged(name).agg(*count).first()
    columns = ["order_line_id", "invoice_no", "invoice_ts", "customer_id", "quantity", "transaction_type"]
    assert sorted(map(str, shared.lines_for_fact.select(*columns).collect())) == sorted(map(str, alone.silver_orders.select(*columns).collect()))


PAIR = schemas.ddl("k string, v int")


def test_without_repeats_only_hashes_of_keys_are_exchanged(spark, monkeypatch):
    compared = []
    join = type(spark.range(0)).join
    monkeypatch.setattr(type(spark.range(0)), "join", lambda self, *a, **b: compared.append(a) or join(self, *a, **b))
    sinks.refuse_repeated_keys(spark.createDataFrame([("a", 1), ("b", 1), (None, 2), (None, 2)], PAIR), ["k"])
    assert not compared
    with pytest.raises(ValueError, match="repeats the key {'k': 'a'}"):
        sinks.refuse_repeated_keys(spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], PAIR), ["k"])
    assert compared


def test_stored_tables_finish_their_rows_after_the_exchange(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace(spark.createDataFrame([("a", 1), ("b", 2)], PAIR), path, ["v"], ["k"], lambda rows: rows.withColumn("k", F.upper("k")))
    assert sorted(r["k"] for r in sinks.read_table(spark, path, PAIR).collect()) == ["A", "B"]
    assert all(".zstd." in p for p in sinks.read_table(spark, path, PAIR).inputFiles())


def test_staged_tables_go_with_their_step_and_shuffles_with_their_job(spark):
    from tillroll.operators.staging import Workspace
    from tillroll.session import SHUFFLE_CLEANUP, path_exists, shuffles_removed

    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    with shuffles_removed(spark), Workspace(spark, "probe") as ws:
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        table = ws.stage(spark.range(3), "x")
        folder = table.inputFiles()[0].rsplit("/", 1)[0]
        assert path_exists(spark, folder)
        ws.drop("x")
        assert not path_exists(spark, folder)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def test_a_step_leaves_no_staged_rows(spark, tmp_path):
    from tillroll.plans import pipeline, rules

    run = pipeline.Run(spark, pipeline.Warehouse(str(tmp_path)), str(tmp_path / "in"), "r")
    with staging.Workspace(spark, "probe") as run.work:
        rows = spark.createDataFrame([(1, "Peru", "Peru"), (None, "Mali", "Mali")], schemas.DIM_CUSTOMER)
        out = run.publish("gold.dim_customer", rows, rules.DIM_CUSTOMER, run.replace("gold.dim_customer"))
        assert (out.rows, out.quarantined) == (2, 1) and child_names(spark, run.work.root) == []
    assert run.read("gold.dim_customer").count() == 1 and run.read("dq.quarantine").count() == 1


def test_what_is_parsed_is_not_asked_for_below_the_feed_join(spark):
    """A predicate on parsed text that is pushed down is evaluated per order and again per line."""
    layers = Layers(spark, SF001)
    for df in (layers.silver_orders, layers.lines_for_fact, layers.orders_for_anchor):
        plan = optimized(df)
        below = plan[plan.index("Join Inner") :].lower()
        assert "rlike" in plan.lower() and "rlike" not in below and "regexp_extract" not in below


def test_lines_go_to_pieces_by_size_before_they_are_parsed(spark, monkeypatch):
    whole = Layers(spark, SF001)
    assert whole.pieces is None
    monkeypatch.setattr(feeds, "PIECE_BYTES", 8000)
    cut = Layers(spark, SF001)
    n = cut.pieces
    assert n >= 8 and Layers(spark, SF001, {"orders": cut.bronze("orders")}).pieces is None
    for a, b in ((cut.silver_orders, whole.silver_orders), (cut.lines_for_fact, whole.lines_for_fact)):
        text = physical(a)
        assert len(re.findall(rf"hashpartitioning\(invoice_no#\d+, stock_code#\d+, {n}\)", text)) == 1
        assert len(re.findall(r"hashpartitioning\(invoice_no#", text)) == 1
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    monkeypatch.setattr(Layers, "fact_pieces", n)
    shared = cut.share_lines()
    assert f", {n})" in physical(shared.fact_sales)
    assert sorted(map(str, shared.fact_sales.collect())) == sorted(map(str, whole.fact_sales.collect()))


def test_equal_texts_of_other_parts_are_other_lines(spark, delivered):
    lines = ["1;X;1;1/1/2011 1:00;5|6", "1;X;1;1/1/2011 1:00|5;6", "1;X;1;1/1/2011 1:00;5|6", "2;X;1;1/1/2011 1:00;5"]
    bronze = delivered("orders", *lines)
    for df in (clean.order_lines(bronze), clean.clean_orders(bronze)):
        got = sorted((r["invoice_no"], str(r["invoice_ts"]), r["customer_id"]) for r in df.collect())
        assert got == [("1", "2011-01-01 01:00:00", None), ("1", "None", 6), ("2", "2011-01-01 01:00:00", 5)]


def test_marts_lines_without_text_give_the_same_marts(spark):
    narrow, wide = Layers(spark, SF001).share_lines(text=False), Layers(spark, SF001)
    assert clean.LINE_TEXT not in narrow._shared_lines.columns and "invoice_no" not in narrow._shared_lines.columns
    for name in ("price_vs_volume", "revenue_by_country"):
        assert sorted(map(str, getattr(narrow, name).collect())) == sorted(map(str, getattr(wide, name).collect()))


def test_last_month_of_the_fact_without_the_fact(spark, delivered):
    orders = delivered(
        "orders", "1;X;1;3/4/2031 10:00;7", "2;X;0;3/5/2031 10:00;7", "3;X;1;12/31/9999 10:00;7", "4;X;2000000000;3/6/2031 10:00;7", "5;Y;1;3/7/2031 10:00;7"
    )
    products = delivered("products", "X;THING;99999999.00")
    layers = Layers(spark, bronze={"orders": orders, "products": products}).share_instants()
    assert [n for n in staged_names(spark) if n == "instants"]
    got = layers.fact_for_last_month.agg(F.max("invoice_ts")).first()[0]
    assert got == layers.fact_sales.agg(F.max("invoice_ts")).first()[0] and got.year == 2031 and got.month == 3


def test_upsert_of_orders_reads_stored_lines(spark):
    layers = Layers(spark, SF001)
    stored = layers.stored_silver_orders
    assert "l_orderkey" not in optimized(stored)
    assert sorted(map(str, stored.collect())) == sorted(map(str, layers.silver_orders.collect()))
