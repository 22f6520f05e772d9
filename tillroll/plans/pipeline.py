"""Materialised run: landing -> bronze -> silver -> gold, with quality and run log.

A run does whatever its tables have not taken in yet, so a step that failed (or a driver that
died) is made up for by the next run. What a table has taken in is written to ``ops.state``
*after* its rows are stored:

1. bronze: deliveries that ``ops.ingested_files`` does not list are appended as one load (a folder
   of its own) and then listed. A load folder that is not listed is the rest of a broken run
   and is removed.
2. silver: the bronze loads that the table has not taken in are cleaned, checked and upserted
   (orders: only the touched invoice months are rewritten). Repeating a load changes nothing:
   a replayed line has the same key, a customer's newest load gives its country, a products
   delivery is a full snapshot.
3. gold: dimensions and marts are rebuilt from the stored tables. The fact notes the content of
   the price dimension that it was priced with and the loads it holds: if the dimension is
   another one it is rebuilt, else only the months of the loads it lacks. The monthly
   aggregates note the last change of the fact that they follow.

``publish`` writes the tagged rows once to the shared folder and counts all rules while it does
(``DataFrame.observe``), then appends ``dq/results`` and ``dq/quarantine`` and writes the good
rows. Tables by month, of a row a line, are written once (``publish_months``): the good rows where they stay,
the rejected ones beside them until they are in quarantine; the fact is priced a group of months at a time, so
that what is exchanged at once does not grow with the lines. Whole tables are replaced atomically, and so are the touched months of a table, all at once.
What a step staged is removed when it ends, what a step that failed staged when the run ends, and the
files of a job's shuffles with the job. A table whose inputs did not succeed is SKIPPED; the
rest still run. Each table's line of the run log is written as it finishes. The operational tables
get a file or more a run; a run ends by folding what nobody needs apart any more and by putting
their files together, so that the thousandth run reads as much as the hundredth.
"""

from __future__ import annotations

import json
import time
import traceback
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.operators import sinks
from tillroll.operators.quality import REJECTED, RULES_FAILED, Rule, evaluate, observed, observed_results, published, quarantined
from tillroll.operators.schema import conform
from tillroll.operators.staging import Workspace
from tillroll.plans import clean, marts, rules, schemas, star
from tillroll.session import child_names, folder_bytes, path_exists, pieces_of, remove_path, shuffled_into, shuffles_removed
from tillroll.sources import landing

FEEDS = {
    "customers": ("customers_", schemas.BRONZE_CUSTOMERS),
    "products": ("products_", schemas.BRONZE_PRODUCTS),
    "orders": ("orders_", schemas.BRONZE_ORDERS),
}
INGEST_DAY, LOAD_ID, INVOICE_MONTH = "ingest_day", "load_id", "invoice_month"

BRONZE_STORED = {
    n: schemas.with_column(schemas.with_column(s, INGEST_DAY, "date"), LOAD_ID, "string") for n, (_, s) in FEEDS.items()
}
ORDERS_STORED = schemas.with_column(schemas.SILVER_ORDERS, INVOICE_MONTH, "date")
FACT_STORED = schemas.with_column(schemas.FACT_SALES, INVOICE_MONTH, "date")

STORED_TABLES = {
    **{f"bronze.{n}": s for n, s in BRONZE_STORED.items()},
    "silver.customers": schemas.SILVER_CUSTOMERS,
    "silver.products": schemas.SILVER_PRODUCTS,
    "silver.orders": ORDERS_STORED,
    "gold.dim_customer": schemas.DIM_CUSTOMER,
    "gold.dim_product": schemas.DIM_PRODUCT,
    "gold.fact_sales": FACT_STORED,
    "gold.sales_by_customer_month": schemas.SALES_BY_CUSTOMER_MONTH,
    "gold.units_by_version_month": schemas.UNITS_BY_VERSION_MONTH,
    "gold.top_countries_by_customers": schemas.TOP_COUNTRIES_BY_CUSTOMERS,
    "gold.revenue_by_country": schemas.REVENUE_BY_COUNTRY,
    "gold.price_vs_volume": schemas.PRICE_VS_VOLUME,
    "gold.top_price_drops": schemas.TOP_PRICE_DROPS,
    "dq.results": schemas.DQ_RESULTS,
    "dq.quarantine": schemas.DQ_QUARANTINE,
    "ops.run_log": schemas.RUN_LOG,
    "ops.ingested_files": schemas.INGESTED_FILES,
    "ops.state": schemas.STATE,
}

# what a table is built from: a table is skipped when one of these failed in the same run
DEPENDS_ON = {
    "bronze.customers": (),
    "bronze.products": (),
    "bronze.orders": (),
    "silver.customers": ("bronze.customers",),
    "silver.products": ("bronze.products",),
    "silver.orders": ("bronze.orders",),
    "gold.dim_customer": ("silver.customers",),
    "gold.dim_product": ("silver.products", "silver.orders"),
    "gold.fact_sales": ("silver.orders", "gold.dim_product"),
    "gold.sales_by_customer_month": ("gold.fact_sales",),
    "gold.units_by_version_month": ("gold.fact_sales",),
    "gold.top_countries_by_customers": ("gold.dim_customer",),
    "gold.revenue_by_country": ("gold.sales_by_customer_month", "gold.dim_customer"),
    "gold.price_vs_volume": ("gold.units_by_version_month", "gold.dim_product"),
    "gold.top_price_drops": ("gold.sales_by_customer_month", "gold.dim_product"),
}


MONTHLY = ("gold.sales_by_customer_month", "gold.units_by_version_month")
#: Operational tables of some rows a run.
COMPACTED = ("dq.results", "ops.run_log", "ops.ingested_files")
#: Bytes of stored orders that are priced at once (whole months, one at least), and those for a partition of that join.
GROUP_BYTES, PIECE_BYTES = 1 << 30, 8 << 20
#: Months of so many stored bytes are written as the join leaves them: each of its tasks has enough of each for a file.
LARGE_MONTH = 32 << 20
#: Deliveries of which the names may be broadcast (some 100 bytes each).
FEW_NAMES = 50_000


def instant(micros: int) -> Column:
    """An instant, whatever the session's time zone."""
    return F.timestamp_micros(F.lit(micros))


def now_micros() -> int:
    return time.time_ns() // 1000


def in_months(months: Sequence[str | None]) -> Column:
    """Literal filter on the month partitions (pruned at file listing)."""
    return sinks.in_partitions(INVOICE_MONTH, [None if m is None else F.lit(m).cast("date") for m in months])


@dataclass
class Warehouse:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name.replace('.', '/')}"

    def read(self, spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
        return sinks.read_table(spark, self.path(name), schema or STORED_TABLES[name])

    def register(self, spark: SparkSession) -> list[str]:
        """A temporary view ``<layer>_<table>`` of every stored table, as it is now: nothing of the
        caller's catalog is touched. Returns the views' names."""
        views = []
        for name in STORED_TABLES:
            if path_exists(spark, self.path(name)):
                views.append(name.replace(".", "_"))
                self.read(spark, name).createOrReplaceTempView(views[-1])
        return views


@dataclass
class Outcome:
    """How a step ended: rows it has seen, and how many of them were quarantined."""

    rows: int | None = None
    quarantined: int | None = 0
    status: str = "SUCCESS"
    message: str | None = None


@dataclass(frozen=True)
class Taken:
    """The loads a table has taken in: all up to one, and some after it."""

    upto: str
    loads: frozenset[str]

    def __contains__(self, load: str) -> bool:
        return load <= self.upto or load in self.loads


class Run:
    """One run. ``observer(step, phase)`` is called when a step starts ("start") and when its rows
    are stored but not yet noted as taken in ("stored")."""

    def __init__(
        self,
        spark: SparkSession,
        warehouse: Warehouse,
        landing_dir: str,
        run_id: str,
        observer: Callable[[str, str], None] | None = None,
    ):
        self.spark, self.wh, self.landing_dir, self.run_id = spark, warehouse, landing_dir, run_id
        self.observer = observer or (lambda step, phase: None)
        self.micros = now_micros()
        self.load = f"{self.micros:020d}"
        self.outcomes: dict[str, Outcome] = {}
        self.modes: dict[str, str] = {}
        self.work: Workspace

    # ------------------------------------------------------------ what has been taken in

    def read(self, name: str) -> DataFrame:
        return self.wh.read(self.spark, name)

    def notes(self, table: str) -> list[dict]:
        """What the table has taken in so far, oldest first (a few rows per run)."""
        rows = self.read("ops.state").filter(F.col("table_name") == table).orderBy("seq").collect()
        return [json.loads(r["detail"]) | {"seq": r["seq"]} for r in rows]

    def note(self, table: str, **detail) -> None:
        self.observer(table, "stored")
        row = self.spark.range(1).select(
            F.lit(table).alias("table_name"), F.lit(now_micros()).alias("seq"),
            F.lit(json.dumps(detail)).alias("detail"), instant(now_micros()).alias("committed_at"),
        )
        sinks.append(row, self.wh.path("ops.state"))

    def loads_of(self, feed: str) -> dict[str, int]:
        """Loads of a feed in bronze: load id -> instant (one per run that found deliveries)."""
        rows = self.read("ops.ingested_files").filter(F.col("feed") == feed).select("load_id").distinct().collect()
        return {r["load_id"]: int(r["load_id"]) for r in rows}

    def taken_in(self, table: str) -> Taken:
        notes = self.notes(table)
        upto = max((n["upto"] for n in notes if n.get("upto")), default="")
        return Taken(upto, frozenset(load for n in notes for load in n["loads"]))

    def fold(self) -> None:
        """Notes that no table has to tell apart any more become one a table. Every step takes in all
        that is pending, so what a table holds is all loads up to one."""
        fact, follows = self.taken_in("gold.fact_sales"), [n["follows"] for t in MONTHLY for n in self.notes(t)[-1:]]
        followed = min(follows) if len(follows) == len(MONTHLY) else -1
        folded = []
        for table in DEPENDS_ON:
            notes = self.notes(table)
            if table in MONTHLY:
                old, rest = notes[:-1], notes[-1:]
            elif table == "gold.fact_sales":
                old, rest = [n for n in notes if n["seq"] <= followed], [n for n in notes if n["seq"] > followed]
            else:
                done = [table != "silver.orders" or all(load in fact for load in n["loads"]) for n in notes]
                old, rest = [n for n, d in zip(notes, done) if d], [n for n, d in zip(notes, done) if not d]
            if old and table not in MONTHLY:
                upto = max([load for n in old for load in n["loads"]] + [n.get("upto", "") for n in old])
                rest = [old[-1] | {"loads": [], "months": [], "upto": upto}, *rest]
            folded += [(table, n["seq"], json.dumps({k: v for k, v in n.items() if k != "seq"})) for n in rest]
        if folded:
            rows = self.spark.createDataFrame(folded, "table_name string, seq bigint, detail string")
            sinks.replace(rows.withColumn("committed_at", F.timestamp_micros("seq")).coalesce(1), self.wh.path("ops.state"))

    # ------------------------------------------------------------ one table

    def publish(self, name: str, df: DataFrame, table_rules: tuple[Rule, ...], write: Callable[[DataFrame], None]) -> Outcome:
        tagged, seen = observed(evaluate(df, table_rules), table_rules, f"{self.run_id} {name}")
        tagged = self.work.stage(tagged, name.replace(".", "_"))
        got = seen.get
        self.record(name, got, table_rules, tagged)
        write(published(tagged))
        self.work.drop(name.replace(".", "_"))
        return Outcome(got["rows"], got["rejected"])

    def record(self, name: str, got: dict, table_rules: tuple[Rule, ...], tagged: DataFrame | None) -> None:
        """The counts go to ``dq/results``, the rejected rows of ``tagged`` to ``dq/quarantine``."""
        if table_rules:
            results = observed_results(self.spark, got, table_rules, name)
            stamped = results.withColumns({"run_id": F.lit(self.run_id), "checked_at": instant(self.micros)})
            sinks.append(conform(stamped, schemas.DQ_RESULTS).coalesce(1), self.wh.path("dq.results"))
        if got["rejected"]:
            bad = quarantined(tagged, name, self.run_id).withColumn("quarantined_at", instant(self.micros))
            sinks.append(bad, self.wh.path("dq.quarantine"), ["table_name"])

    def publish_months(
        self, name: str, parts: Iterable[DataFrame], table_rules: tuple[Rule, ...], order: Sequence[str], columns: Sequence[str], switch: Callable[[str], None]
    ) -> Outcome:
        """``publish`` of a table by month, the rows of ``parts`` one after the other: tagged rows are written once,
        into a folder of the table, good and rejected apart. ``switch`` is given the folder of the good ones. Only a
        rejected row needs the names of its rules, beside the ``columns`` that go to quarantine."""
        path, got = self.wh.path(name), Counter()
        folder = sinks.new_parts(self.spark, path)
        for n, df in enumerate(parts):
            tagged, seen = observed(evaluate(df, table_rules), table_rules, f"{self.run_id} {name} {n}")
            rows = tagged.withColumn(RULES_FAILED, F.when(F.col(REJECTED), F.col(RULES_FAILED)))
            sinks.add_parts(rows.sortWithinPartitions(REJECTED, INVOICE_MONTH, *order), path, folder, [REJECTED, INVOICE_MONTH])
            got.update(seen.get)
        rejected, bad = f"{path}/{folder}/{REJECTED}=true", None
        if got["rejected"]:
            stored = self.spark.read.schema(StructType([f for f in rows.schema if f.name != REJECTED])).parquet(rejected)
            bad = stored.select(*columns, RULES_FAILED, F.lit(True).alias(REJECTED))
        self.record(name, got, table_rules, bad)
        remove_path(self.spark, rejected)
        switch(f"{folder}/{REJECTED}=false")
        return Outcome(got["rows"], got["rejected"])

    def replace(self, name: str) -> Callable[[DataFrame], None]:
        return lambda good: sinks.replace(good, self.wh.path(name))

    # ------------------------------------------------------------ layers

    def bronze(self, feed: str) -> Outcome:
        self.remove_unlisted_loads(feed)
        rows = take_in(self.spark, self.wh, feed, self.landing_dir, self.micros, self.work, lambda: self.observer(f"bronze.{feed}", "stored"))
        return Outcome(rows)

    def remove_unlisted_loads(self, feed: str) -> None:
        listed = self.loads_of(feed)
        for load, folder in self.load_folders(feed):
            if load not in listed:
                remove_path(self.spark, folder)

    def load_folders(self, feed: str) -> list[tuple[str, str]]:
        """(load, folder) of what is stored of a feed."""
        path = self.wh.path(f"bronze.{feed}")
        days = [f"{path}/{day}" for day in child_names(self.spark, path) if day.startswith(f"{INGEST_DAY}=")]
        return [(folder.partition("=")[2], f"{day}/{folder}") for day in days for folder in child_names(self.spark, day)]

    def silver(self, feed: str) -> Outcome:
        name = f"silver.{feed}"
        held = self.taken_in(name)
        pending = sorted(load for load in self.loads_of(feed) if load not in held)
        new = self.read(f"bronze.{feed}").filter(sinks.in_partitions(LOAD_ID, pending)).drop(INGEST_DAY, LOAD_ID)
        schema, path = STORED_TABLES[name], self.wh.path(name)
        months: list = []
        if feed == "orders":
            size = sum(folder_bytes(self.spark, folder) for load, folder in self.load_folders(feed) if load in pending)
            df = clean.orders_by_month(new, INVOICE_MONTH, self.names_of(feed, pending), pieces_of(self.spark, size))

            def merge(folder: str) -> None:
                months.extend(sinks.merge_parts(self.spark, path, folder, schema, ["order_line_id"], INVOICE_MONTH))

            out = self.publish_months(name, [df], rules.BY_TABLE[name], clean.MONTH_ORDER, schemas.SILVER_ORDERS.names, merge)
        else:
            df, keys = (clean.clean_customers(new), ["customer_id"]) if feed == "customers" else (clean.clean_products(new), ["stock_code", "version"])

            def write(good: DataFrame) -> None:
                sinks.upsert(self.spark, good, path, schema, keys, stored=True)

            out = self.publish(name, df, rules.BY_TABLE[name], write)
        if pending:
            self.note(name, loads=pending, months=[str(m) for m in months])
        return out

    def names_of(self, feed: str, loads: list[str]) -> DataFrame | None:
        """(_source_file) of the loads' deliveries, if they are few enough to be broadcast."""
        listed = self.read("ops.ingested_files").filter((F.col("feed") == feed) & F.col("load_id").isin(loads))
        names = listed.select(F.col("file").alias("_source_file"))
        return names if names.count() <= FEW_NAMES else None

    def dim_customer(self) -> Outcome:
        df = star.dim_customer(self.read("silver.customers"))
        return self.publish("gold.dim_customer", df, rules.DIM_CUSTOMER, self.replace("gold.dim_customer"))

    def dim_product(self) -> Outcome:
        df = star.dim_product(self.read("silver.products"), self.read("silver.orders").drop(INVOICE_MONTH))
        return self.publish("gold.dim_product", df, rules.DIM_PRODUCT, self.replace("gold.dim_product"))

    def prices(self) -> str:
        """Fingerprint of the price dimension's content (order does not matter)."""
        dim = self.read("gold.dim_product")
        got = dim.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*dim.columns)).alias("x")).first()
        return f"{got['n']}:{got['x']}"

    def fact_sales(self) -> Outcome:
        name, path = "gold.fact_sales", self.wh.path("gold.fact_sales")
        orders, prices = self.read("silver.orders"), self.prices()
        notes, held = self.notes(name), self.taken_in(name)
        new = [n for n in self.notes("silver.orders") if any(load not in held for load in n["loads"])]
        pending = sorted({load for n in new for load in n["loads"]})
        months = sorted({m for n in new for m in n["months"]})
        full = not notes or notes[-1]["prices"] != prices
        sizes = self.month_bytes("silver.orders")
        groups = sinks.groups_up_to({m: size for m, size in sizes.items() if full or m in months}, GROUP_BYTES) or [[]]
        order = ["invoice_no"]
        month = sinks.month_partition("invoice_ts")[1]

        def priced(group: list) -> DataFrame:
            lines = orders.filter(in_months(group)).drop(INVOICE_MONTH)
            large = sum(sizes[m] for m in group) >= LARGE_MONTH * max(len(group), 1)
            fact = star.fact_sales(lines, self.read("gold.dim_product"), lay_out=None if large else by_month)
            return fact.withColumn(INVOICE_MONTH, month)

        def by_month(rows: DataFrame) -> DataFrame:
            return sinks.clustered_by(rows.withColumn(INVOICE_MONTH, month), INVOICE_MONTH, [*order, "_key"])

        def switch(folder: str) -> None:
            sinks.switch_parts(self.spark, path, folder, whole=full)

        self.modes[name] = "full" if full else "months"
        most = max(sum(sizes[m] for m in group) for group in groups)
        with shuffled_into(self.spark, most // PIECE_BYTES):
            out = self.publish_months(name, map(priced, groups), rules.FACT_SALES, order, FACT_STORED.names, switch)
        if full or pending:
            self.note(name, loads=pending, prices=prices, months=None if full else months)
        return out

    def month_bytes(self, name: str) -> dict[str | None, int]:
        """Stored bytes of each month of a table."""
        sizes = sinks.partition_bytes(self.spark, self.wh.path(name))
        return {None if "HIVE_DEFAULT" in n else n.partition("=")[2]: size for n, size in sizes.items()}

    def monthly(self, table: str) -> Outcome:
        """Monthly aggregates of the fact: the months that changed since the last one taken in."""
        name, path = f"gold.{table}", self.wh.path(f"gold.{table}")
        build, key = {
            "sales_by_customer_month": (marts.sales_by_customer_month, "customer_id"),
            "units_by_version_month": (marts.units_by_version_month, "product_key"),
        }[table]
        last = max((n["follows"] for n in self.notes(name)), default=-1)
        changes = [n for n in self.notes("gold.fact_sales") if n["seq"] > last]
        full = last < 0 or any(n["months"] is None for n in changes)
        fact = self.read("gold.fact_sales")
        if not full:
            months = sorted({m for n in changes for m in n["months"]})
            fact = fact.filter(in_months(months))

        def switch(folder: str) -> None:
            sinks.switch_parts(self.spark, path, folder, whole=full)

        self.modes[name] = "full" if full else "months"
        rows = sinks.clustered_by(build(fact, INVOICE_MONTH), INVOICE_MONTH, [key])
        out = self.publish_months(name, [rows], (), [key], rows.columns, switch)
        if changes:
            self.note(name, follows=changes[-1]["seq"])
        return out

    def mart(self, table: str) -> Outcome:
        """The marts read the maintained monthly aggregates, not the fact."""
        sales, units = self.read("gold.sales_by_customer_month"), self.read("gold.units_by_version_month")
        dim_c, dim_p = self.read("gold.dim_customer"), self.read("gold.dim_product")
        if table == "top_countries_by_customers":
            df = marts.top_countries_by_customers(dim_c)
        elif table == "revenue_by_country":
            per_customer = sales.groupBy("customer_id").agg(F.sum("revenue").alias("revenue"))
            df = marts.revenue_by_country(None, dim_c, per_customer.filter("revenue IS NOT NULL"))
        elif table == "price_vs_volume":
            df = marts.price_vs_volume(None, dim_p, units.groupBy("product_key").agg(F.sum("units").alias("units")))
        else:
            df = marts.top_price_drops(sales, dim_p, ts="last_invoice_ts")
        name = f"gold.{table}"
        return self.publish(name, df, rules.BY_TABLE[name], self.replace(name))

    def build(self, name: str) -> Outcome:
        layer, table = name.split(".")
        if layer in ("bronze", "silver"):
            return getattr(self, layer)(table)
        if table in ("dim_customer", "dim_product", "fact_sales"):
            return getattr(self, table)()
        return self.monthly(table) if table.endswith("_month") else self.mart(table)

    # ------------------------------------------------------------ run

    def log(self, name: str, started: int, out: Outcome) -> None:
        good = None if out.rows is None else out.rows - out.quarantined
        bad = None if out.rows is None else out.quarantined
        row = (self.run_id, name, name.split(".")[0], out.status, out.rows, good, bad, out.message)
        frame = self.spark.createDataFrame([row], StructType(schemas.RUN_LOG.fields[:-2]))
        frame = frame.withColumn("started_at", instant(started)).withColumn("finished_at", instant(now_micros()))
        sinks.append(frame.coalesce(1), self.wh.path("ops.run_log"))

    def outcome_of(self, name: str) -> Outcome:
        """The step's outcome; an error is one too."""
        missing = [i for i in DEPENDS_ON[name] if self.outcomes[i].status != "SUCCESS"]
        if missing:
            return Outcome(status="SKIPPED", message=f"needs {', '.join(missing)}")
        try:
            self.observer(name, "start")
            return self.build(name)
        except Exception as exc:  # noqa: BLE001 - kept as data, raised when all steps have had their turn
            traceback.print_exc()
            return Outcome(status="FAILED", message="".join(traceback.format_exception_only(exc)).strip())

    def run(self) -> str:
        with shuffles_removed(self.spark), Workspace(self.spark, f"run-{self.load}") as self.work:
            for name in DEPENDS_ON:
                started = now_micros()
                self.outcomes[name] = self.outcome_of(name)
                self.log(name, started, self.outcomes[name])
        open_ = sorted(n for n, out in self.outcomes.items() if out.status != "SUCCESS")
        if open_:
            raise RuntimeError(f"run {self.run_id}: failed or skipped: {open_}")
        self.fold()
        for name in COMPACTED:
            sinks.compact(self.spark, self.wh.path(name), STORED_TABLES[name])
        return self.run_id


def take_in(
    spark: SparkSession, wh: Warehouse, feed: str, landing_dir: str, micros: int, work: Workspace, stored: Callable[[], None] = lambda: None
) -> int | None:
    """The deliveries of a feed that ``ops.ingested_files`` does not list, appended to bronze as one load
    and then listed. The new names are found by an anti join and stored once; the driver is given
    them some thousands at a time, to name the paths of a scan. Returns the rows of the load."""
    prefix, schema = FEEDS[feed]
    listed = wh.read(spark, "ops.ingested_files").filter(F.col("feed") == feed)
    names = work.stage(landing.new_deliveries(spark, landing_dir, prefix, listed), "new_deliveries")
    load, found = f"{micros:020d}", 0
    day = spark.range(1).select(F.to_date(instant(micros)).cast("string")).first()[0]
    for page in landing.pages_of_names(names):
        rows = landing.read_deliveries(spark, landing_dir, page, schema, instant(micros))
        seen = Observation()
        # the load's one folder: a write by partition would sort the rows of each task by it
        folder = f"{wh.path(f'bronze.{feed}')}/{INGEST_DAY}={day}/{LOAD_ID}={load}"
        sinks.append(rows.observe(seen, F.count(F.lit(1)).alias("rows")), folder)
        found += seen.get["rows"]
    stored()
    lines = names.select(F.lit(feed).alias("feed"), "file", F.lit(load).alias("load_id"), instant(micros).alias("ingested_at"))
    if not names.isEmpty():
        sinks.append(lines.coalesce(1), wh.path("ops.ingested_files"))
    return found


def run_pipeline(
    spark: SparkSession,
    warehouse_root: str,
    landing_dir: str,
    run_id: str,
    observer: Callable[[str, str], None] | None = None,
) -> str:
    return Run(spark, Warehouse(warehouse_root), landing_dir, run_id, observer).run()
