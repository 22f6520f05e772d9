"""Incremental landing ingest with Structured Streaming (exactly once per file).

The file source keeps the set of processed files in the query checkpoint, so a
delivery is read once no matter how often the job runs, and old deliveries are not
listed or read again. ``trigger(availableNow=True)`` processes whatever has landed and
stops. ``max_files_per_trigger`` only paces the work:

- A run is one load: all its micro-batches carry one ``_ingested_at``, so a delivery of many
  part files is never split into two loads. The instant is kept beside the checkpoint until the
  run has ended, so a run that takes up a broken one goes on with the same load.
- Files are picked up by name at any age (the source's default forgets old ones).
- Only the feed's own files are listed and read.

A replayed batch rewrites the same folder (its number is part of the path), so bronze has no
duplicates.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.operators import sinks
from tillroll.operators.quality import evaluate, published
from tillroll.operators.staging import Workspace
from tillroll.plans import clean, rules, schemas
from tillroll.session import child_names, folder_bytes, fs_path, pieces_of, remove_path, shuffles_removed
from tillroll.sources.landing import lineage, literal_glob, qualified, text_columns

ANY_AGE = "36500d"
LOAD_MARK = "open-load-"
INVOICE_MONTH = "invoice_month"
SILVER_ORDERS_BY_MONTH = schemas.with_column(schemas.SILVER_ORDERS, INVOICE_MONTH, "date")


def open_load(spark: SparkSession, folder: str) -> int:
    """Instant (microseconds) of the load that is under way, or of a new one."""
    open_ = [n for n in child_names(spark, folder) if n.startswith(LOAD_MARK)]
    if open_:
        return int(open_[0][len(LOAD_MARK) :])
    micros = time.time_ns() // 1000
    fs, mark = fs_path(spark, f"{folder}/{LOAD_MARK}{micros}")
    fs.create(mark, False).close()
    return micros


def close_load(spark: SparkSession, folder: str) -> None:
    for name in child_names(spark, folder):
        if name.startswith(LOAD_MARK):
            remove_path(spark, f"{folder}/{name}")


def _run_available(
    spark: SparkSession,
    landing_dir: str,
    prefix: str,
    bronze_schema: StructType,
    bronze_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int,
    then: Callable[[DataFrame, str], None] | None = None,
) -> None:
    """Write every micro-batch of new rows to its bronze folder, then pass it on as stored, with its folder."""
    loads = f"{checkpoint_path.rstrip('/')}-load"
    instant: Column = F.timestamp_micros(F.lit(open_load(spark, loads)))
    stream = (
        spark.readStream.schema(text_columns(bronze_schema))
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("maxFileAge", ANY_AGE)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(f"{literal_glob(qualified(spark, landing_dir))}/{literal_glob(prefix)}*.csv")
        .select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        found = lineage(spark, landing_dir, F.col("_path"), F.col("_start"))
        folder = f"{bronze_path.rstrip('/')}/batch={batch_id}"
        rows = batch.withColumns({**found, "_ingested_at": instant}).select(*bronze_schema.names)
        rows.write.mode("overwrite").parquet(folder, compression=sinks.CODEC)
        if then is not None:
            then(spark.read.schema(bronze_schema).parquet(folder), folder)

    (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    close_load(spark, loads)


def ingest_available(
    spark: SparkSession,
    landing_dir: str,
    prefix: str,
    bronze_schema: StructType,
    bronze_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int = 1000,
) -> None:
    """Append every not-yet-ingested ``<prefix>*.csv`` delivery to bronze, then stop."""
    _run_available(spark, landing_dir, prefix, bronze_schema, bronze_path, checkpoint_path, max_files_per_trigger)


def read_bronze(spark: SparkSession, bronze_path: str, bronze_schema: StructType) -> DataFrame:
    """All ingested rows (every batch folder)."""
    return sinks.read_table(spark, bronze_path, bronze_schema)


def stream_orders_to_silver(
    spark: SparkSession,
    landing_dir: str,
    bronze_path: str,
    silver_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int = 1000,
) -> None:
    """Orders deliveries -> bronze (append) -> silver (keyed upsert), per micro-batch.

    Lines are cleaned, deduplicated on the content key, checked, and upserted into the
    month-partitioned silver table: a replayed line replaces its earlier copy, a new line
    is inserted, and only the months the batch touches are rewritten. A repeated
    micro-batch upserts the same keys again, so the result does not change.
    """

    def to_silver(landed: DataFrame, folder: str) -> None:
        with Workspace(spark, "batch") as ws:
            # a batch has the names of max_files_per_trigger files at most; lines are not exchanged with them
            files = ws.stage(landed.select("_source_file").distinct().coalesce(1), "files")
            lines = clean.orders_by_month(landed, INVOICE_MONTH, files, pieces_of(spark, folder_bytes(spark, folder)))
            sinks.upsert(
                spark, published(evaluate(lines, rules.SILVER_ORDERS)), silver_path, SILVER_ORDERS_BY_MONTH, ["order_line_id"],
                INVOICE_MONTH, laid_out=clean.MONTH_ORDER,
            )

    with shuffles_removed(spark):
        _run_available(
            spark, landing_dir, "orders_", schemas.BRONZE_ORDERS, bronze_path, checkpoint_path, max_files_per_trigger, to_silver
        )
