"""Sinks and incremental ingest on local folders."""

import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillroll.operators import sinks
from tillroll.plans import schemas
from tillroll.sources import landing
from tillroll.streaming.ingest import (
    SILVER_ORDERS_BY_MONTH,
    ingest_available,
    read_bronze,
    stream_orders_to_silver,
)

SCHEMA = schemas.ddl("k string, v int, m date")


def rows(spark, data):
    return spark.createDataFrame(data, "k string, v int, m string").withColumn("m", F.to_date("m"))


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    target = rows(spark, [("a", 1, "2020-01-01"), ("b", 1, "2020-01-01"), ("c", 1, "2020-02-01")])
    target.write.partitionBy("m").parquet(path)
    untouched = sorted(p.name for p in (Path(path) / "m=2020-02-01").iterdir())
    source = rows(spark, [("b", 2, "2020-01-01"), ("d", 2, "2020-03-01")])
    sinks.upsert(spark, source, path, SCHEMA, ["k"], "m")
    got = sorted((r["k"], r["v"], str(r["m"])) for r in sinks.read_table(spark, path, SCHEMA).collect())
    assert got == [("a", 1, "2020-01-01"), ("b", 2, "2020-01-01"), ("c", 1, "2020-02-01"), ("d", 2, "2020-03-01")]
    assert sorted(p.name for p in (Path(path) / "m=2020-02-01").iterdir()) == untouched


def test_unpartitioned_upsert_and_null_keys_insert(spark, tmp_path):
    path = str(tmp_path / "u")
    schema = schemas.ddl("k string, v int")
    spark.createDataFrame([("a", 1), ("b", 1)], schema).write.parquet(path)
    sinks.upsert(spark, spark.createDataFrame([("a", 2), (None, 3)], schema), path, schema, ["k"])
    got = sorted(((r["k"] or ""), r["v"]) for r in sinks.read_table(spark, path, schema).collect())
    assert got == [("", 3), ("a", 2), ("b", 1)]


def test_missing_table_reads_empty(spark, tmp_path):
    assert sinks.read_table(spark, str(tmp_path / "none"), SCHEMA).count() == 0


HEADER = "InvoiceNo,StockCode,Quantity,InvoiceDate,CustomerID\n"


def test_landing_scan_keeps_padding_and_file_names(spark, tmp_path):
    (tmp_path / "orders_1.csv").write_text("\ufeff" + HEADER + "1,X ,2,3/4/2031 10:00,\n")
    (tmp_path / "other_1.csv").write_text("a,b\n1,2\n")
    got = landing.read_landing(spark, str(tmp_path), "orders_", schemas.BRONZE_ORDERS).collect()
    assert [(r["invoice_no"], r["stock_code"], r["customer_id"], r["_source_file"], r["_source_part"]) for r in got] == [
        ("1", "X ", None, "orders_1.csv", "")
    ]


def test_any_way_to_name_the_folder_finds_the_same_rows(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in box+[1] é%20"
    folder.mkdir()
    (folder / "orders_a b+c%.csv").write_text(HEADER + "1,X,2,3/4/2031 10:00,7\n")
    monkeypatch.chdir(tmp_path)
    plain = str(folder)
    ways = [plain, plain + "/", "file://" + plain, "file:" + plain, plain.replace("/in box", "//in box"), plain.replace("/in box", "/./in box")]
    for way in ways:
        got = landing.read_landing(spark, way, "orders_", schemas.BRONZE_ORDERS).collect()
        assert [(r["_source_file"], r["_row_id"]) for r in got] == [("orders_a b+c%.csv", 0)], way
        loaded = spark.createDataFrame([("orders_a b+c%.csv",)], "file string")
        assert landing.new_deliveries(spark, way, "orders_", loaded).count() == 0
        assert [r["file"] for r in landing.new_deliveries(spark, way, "orders_", loaded.limit(0)).collect()] == ["orders_a b+c%.csv"]


def test_rows_of_split_and_folder_deliveries_are_in_file_order(spark, tmp_path):
    big = [f"{i},X,1,3/4/2031 10:00,7" for i in range(3000)]
    folder = tmp_path / "orders_1.csv"
    folder.mkdir()
    (folder / "part-00000.csv").write_text(HEADER + "first,X,1,3/4/2031 10:00,7\n")
    (folder / "part-00001.csv").write_text(HEADER + "\n".join(big) + "\n")
    (folder / "part-00002.csv").write_text(HEADER + "last,X,1,3/4/2031 10:00,7\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        rows = landing.read_landing(spark, str(tmp_path), "orders_", schemas.BRONZE_ORDERS)
        got = rows.orderBy("_source_file", "_source_part", "_row_id").collect()
        assert rows.rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["invoice_no"] for r in got] == ["first", *map(str, range(3000)), "last"]


def stream(spark, folder, base, files=1000):
    bronze, checkpoint = str(base / "bronze"), str(base / "checkpoint")
    ingest_available(spark, folder, "orders_", schemas.BRONZE_ORDERS, bronze, checkpoint, files)
    return read_bronze(spark, bronze, schemas.BRONZE_ORDERS)


def test_a_stream_reads_each_delivery_once_at_any_age(spark, tmp_path):
    folder = tmp_path / "land ing"
    folder.mkdir()
    (folder / "orders_1.csv").write_text(HEADER + "1,X,2,3/4/2031 10:00,7\n2,Y,1,3/4/2031 10:00,7\n")
    (folder / "customers_1.csv").write_text("CustomerID,Country\n1,Peru\n")
    assert stream(spark, str(folder), tmp_path).count() == 2
    assert stream(spark, f"file://{folder}", tmp_path).count() == 2  # nothing new
    late = folder / "orders_0 late.csv"
    late.write_text(HEADER + "3,Z,5,3/5/2031 10:00,\n")
    os.utime(late, (time.time() - 30 * 86400,) * 2)
    got = stream(spark, str(folder), tmp_path).collect()
    assert sorted(r["_source_file"] for r in got) == ["orders_0 late.csv", "orders_1.csv", "orders_1.csv"]


def test_a_run_of_many_micro_batches_is_one_load(spark, tmp_path):
    folder = tmp_path / "landing" / "orders_1.csv"
    folder.mkdir(parents=True)
    for n in range(5):
        (folder / f"part-{n}.csv").write_text(HEADER + f"{n},X,2,3/4/2031 10:00,7\n")
    got = stream(spark, str(folder.parent), tmp_path, files=2).collect()
    assert len(got) == 5 and len({r["_ingested_at"] for r in got}) == 1
    assert {(r["_source_file"], r["_source_part"]) for r in got} == {("orders_1.csv", f"part-{n}.csv") for n in range(5)}


def test_a_broken_run_goes_on_with_its_load(spark, tmp_path):
    from tillroll.streaming.ingest import close_load, open_load

    first = open_load(spark, str(tmp_path / "c"))
    assert open_load(spark, str(tmp_path / "c")) == first
    close_load(spark, str(tmp_path / "c"))
    assert open_load(spark, str(tmp_path / "c")) > first


def test_streaming_silver_upsert_absorbs_replays(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "orders_1.csv").write_text(HEADER + "1,X,2,3/4/2031 10:00,7\n2,Y,1,4/4/2031 10:00,7\n3,Z,1,15/5/2031 14:48,7\n")
    paths = [str(tmp_path / n) for n in ("bronze", "silver", "ckpt")]
    stream_orders_to_silver(spark, str(folder), *paths)
    (folder / "orders_2.csv").write_text(HEADER + "1,x ,2,3/4/2031 10:00,7\n4,Y,5,4/5/2031 10:00,\n")
    stream_orders_to_silver(spark, str(folder), *paths)
    silver = sinks.read_table(spark, paths[1], SILVER_ORDERS_BY_MONTH)
    got = sorted((r["invoice_no"], r["_source_file"], str(r["invoice_month"])) for r in silver.collect())
    assert got == [
        ("1", "orders_2.csv", "2031-03-01"),  # replayed line replaced its first copy
        ("2", "orders_1.csv", "2031-04-01"),
        ("4", "orders_2.csv", "2031-04-01"),
    ]  # line 3 (day-first date) quarantined


PAIR = schemas.ddl("k string, v int")


def test_a_crash_before_the_switch_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.replace(spark.createDataFrame([("a", 1)], PAIR), path)

    def crash(*_):
        raise OSError("lost driver")

    monkeypatch.setattr(sinks, "_switch", crash)
    with pytest.raises(OSError, match="lost driver"):
        sinks.replace(spark.createDataFrame([("b", 2)], PAIR), path)
    assert [tuple(r) for r in sinks.read_table(spark, path, PAIR).collect()] == [("a", 1)]
    monkeypatch.undo()
    table = sinks.read_table(spark, path, PAIR)
    sinks.replace(table.withColumn("v", F.col("v") + 10), path)  # reads itself; removes the crash's rest
    assert [tuple(r) for r in sinks.read_table(spark, path, PAIR).collect()] == [("a", 11)]
    assert len([n for n in os.listdir(path) if n.startswith("version-")]) == 2  # current and the one before


def test_a_crash_between_months_leaves_the_old_table(spark, tmp_path, monkeypatch):
    """Two months are upserted; the driver dies when their rows are stored but the list is not switched."""
    path = str(tmp_path / "t")

    def content():
        return sorted((r["k"], r["v"], str(r["m"])) for r in sinks.read_table(spark, path, SCHEMA).collect())

    sinks.upsert(spark, rows(spark, [("a", 1, "2020-01-01"), ("b", 1, "2020-02-01"), ("c", 1, None)]), path, SCHEMA, ["k"], "m")
    before, source = content(), rows(spark, [("a", 2, "2020-01-01"), ("b", 2, "2020-02-01"), ("d", 2, "2020-03-01")])
    for name in ("_switch", "write_small"):
        monkeypatch.setattr(sinks, name, lambda *_: (_ for _ in ()).throw(OSError("lost driver")))
        with pytest.raises(OSError, match="lost driver"):
            sinks.upsert(spark, source, path, SCHEMA, ["k"], "m")
        monkeypatch.undo()
        assert content() == before
    reader = sinks.read_table(spark, path, SCHEMA)
    sinks.upsert(spark, source, path, SCHEMA, ["k"], "m")
    assert content() == [("a", 2, "2020-01-01"), ("b", 2, "2020-02-01"), ("c", 1, "None"), ("d", 2, "2020-03-01")]
    assert sorted((r["k"], r["v"]) for r in reader.collect()) == [("a", 1), ("b", 1), ("c", 1)]  # its files are kept
    for n in range(3, 6):
        sinks.upsert(spark, rows(spark, [("d", n, "2020-03-01")]), path, SCHEMA, ["k"], "m")
    assert content()[-1] == ("d", 5, "2020-03-01") and len([n for n in os.listdir(path) if n.startswith("_parts-")]) <= 4
    sinks.replace(sinks.read_table(spark, path, SCHEMA), path, ["m"], ["k"])
    assert len(content()) == 4


def test_small_files_become_one_and_appends_go_on(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(6):
        sinks.append(spark.createDataFrame([("a", n)], PAIR).coalesce(1), path)
    assert not sinks.compact(spark, path, PAIR, 6) and sinks.compact(spark, path, PAIR, 5)
    sinks.append(spark.createDataFrame([("b", 9)], PAIR).coalesce(1), path)
    got = sinks.read_table(spark, path, PAIR)
    assert sorted(r["v"] for r in got.collect()) == [0, 1, 2, 3, 4, 5, 9] and len(got.inputFiles()) == 2


def test_repeated_keys_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    twice = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 3)], PAIR)
    with pytest.raises(ValueError, match="repeats the key"):
        sinks.upsert(spark, twice, path, PAIR, ["k"])
    assert sinks.read_table(spark, path, PAIR).count() == 0
    sinks.upsert(spark, twice.filter("v <> 2"), path, PAIR, ["k"])
    assert sinks.read_table(spark, path, PAIR).count() == 3


def test_scratch_goes_to_the_folder_the_session_names(spark):
    from tillroll.operators.staging import Workspace
    from tillroll.session import child_names, shared_dir

    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")
    with Workspace(spark, "probe") as ws:
        assert ws.stage(spark.range(3), "x").count() == 3 and ws.root.startswith(shared_dir(spark))
        parent, name = ws.root.rsplit("/", 1)
        assert name in child_names(spark, parent)
    assert name not in child_names(spark, parent)


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from tillroll.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)


def test_upsert_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    rows(spark, [("a", 1, "2020-01-01"), ("c", 1, "2020-02-01")]).write.partitionBy("m").parquet(path)
    source = rows(spark, [("a", 2, "2020-01-01")])
    target = sinks.read_table(spark, path, SCHEMA)
    pruned = target.filter(sinks.in_partitions("m", sinks.partition_values(source, "m")))
    text = pruned._jdf.queryExecution().executedPlan().toString()
    # the partition filter is applied when listing files: m=2020-02-01 is never read
    assert "PartitionFilters: [isnotnull(m" in text and "= 2020-01-01)]" in text
    assert sorted(r["k"] for r in pruned.collect()) == ["a"]
