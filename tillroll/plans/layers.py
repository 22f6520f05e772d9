"""The whole model as DataFrames: feeds -> bronze -> silver -> gold.

``Layers`` wires the pure functions together. Every published table is
``published(evaluate(table, rules))`` of its inputs' *published* rows, exactly as a
materialised pipeline would read them. The pipeline (``plans.pipeline``) writes the same
DataFrames layer by layer instead.

Pass ``bronze`` DataFrames to run the model on other inputs (tests, CSV landing).

What runs a job, and what doesn't: silver tables, dim_customer and the marts' own plans
are lazy. With ``stage=True`` two small tables that several branches of one plan read are
written once, when a table below them is first asked for: published products (numbered in
two passes) and dim_product. The fact is lazy too, and each mart reads only the columns it
needs of it; ``share_fact()`` writes those columns once for callers that build several marts, and
``share_lines()`` the checked lines for callers that read them several times (for their counts, the
newest month and the fact).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import sinks
from tillroll.operators.asof import asof_join
from tillroll.operators.quality import REJECTED, RULES_FAILED, evaluate, published
from tillroll.operators.schema import conform
from tillroll.plans import clean, marts, rules, schemas, star
from tillroll.session import fs_path
from tillroll.sources import feeds


MART_COLUMNS = [
    "customer_id", "product_key", "quantity", "line_amount", "transaction_type", "is_revenue", "invoice_ts",
]


class Layers:
    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str | None = None,
        bronze: dict[str, DataFrame] | None = None,
        stage: bool = True,
    ) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._bronze = dict(bronze or {})
        self._given = frozenset(self._bronze)
        self.stage = stage

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        return sinks.stage(df, name) if self.stage else df

    # inputs of downstream layers

    @property
    def orders_for_anchor(self) -> DataFrame:
        """Published orders as far as ``max(invoice_ts)`` can tell: the rule-checked lines
        *without* dedup (a max is unchanged by removing duplicates: copies share
        every typed field and rule outcome), i.e. one scan and a partial max."""
        if "_instants" in self.__dict__:
            return self._instants
        if "_shared_lines" in self.__dict__:
            return published(self._shared_lines)
        tagged = evaluate(clean.typed_lines(self.bronze("orders")), rules.SILVER_ORDERS)
        # a rejected line stays, without its time: a filter would be pushed below the joins of the feed
        return tagged.select("stock_code", F.when(~F.col(REJECTED), F.col("invoice_ts")).alias("invoice_ts"), "quantity")

    @property
    def _derived(self) -> bool:
        """Whether the orders feed is the one that is derived from the driver tables."""
        return self.sf_dir is not None and "orders" not in self._given

    @cached_property
    def pieces(self) -> int | None:
        return feeds.order_pieces(self.spark, self.sf_dir) if self._derived else None

    @cached_property
    def fact_pieces(self) -> int | None:
        """Partitions of the join of lines and stored versions, where these are more than Catalyst broadcasts."""
        if not self.pieces or not self.stage:
            return None
        most = int(self.spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b"))
        folder = self.dim_product_for_gold.inputFiles()[0].rsplit("/", 1)[0]
        fs, path = fs_path(self.spark, folder)
        return self.pieces if fs.getContentSummary(path).getLength() > max(most, 0) else None

    @property
    def lines_for_fact(self) -> DataFrame:
        """Published order lines without their lineage, which no fact carries, and with their text."""
        if "_shared_lines" in self.__dict__:
            return clean.with_key(published(self._shared_lines))
        return published(evaluate(clean.order_lines(self.bronze("orders"), self.pieces), rules.SILVER_ORDERS))

    @cached_property
    def products_for_dim(self) -> DataFrame:
        return self._staged(self.silver_products, "silver_products")

    @cached_property
    def dim_product_for_gold(self) -> DataFrame:
        return self._staged(self.dim_product, "dim_product")

    @property
    def fact_for_marts(self) -> DataFrame:
        if "_shared_fact" in self.__dict__:
            return published(self._shared_fact)
        if "_shared_lines" in self.__dict__ and clean.LINE_TEXT not in self._shared_lines.columns:
            priced = star.priced_amounts(published(self._shared_lines), self.dim_product_for_gold, self.fact_pieces)
            return published(evaluate(priced, rules.FACT_SALES))
        return self.fact_sales

    @property
    def fact_for_last_month(self) -> DataFrame:
        """The fact as far as ``max(invoice_ts)`` can tell: the newest published line of each code
        and month that has a price. Validity begins and ends with months (but for the end of time), so the lines of a
        code and month all have a price or none has; copies change no maximum, so none is removed first. Only
        quantities of over 100,000,000 may have no amount that a price's eight digits fit: they stand alone."""
        if "_shared_fact" in self.__dict__:
            return self.fact_for_marts
        month = star.month_of(F.col("invoice_ts")).alias("_month")
        after = (F.col("invoice_ts") >= star.ntz(star.END_OF_TIME)).alias("_after")
        huge = F.when(F.abs(F.col("quantity").cast("long")) > 100_000_000, F.col("quantity")).alias("_huge")
        newest = self.orders_for_anchor.groupBy("stock_code", month, after, huge).agg(F.max("invoice_ts").alias("invoice_ts"))
        joined = asof_join(newest, self.dim_product_for_gold, "stock_code", "invoice_ts", how="inner")
        amount = (F.col("f._huge") * F.col("v.unit_price")).try_cast("decimal(18,2)")
        return joined.filter(F.col("f._huge").isNull() | amount.isNotNull()).select("f.invoice_ts")

    @property
    def fact_sales_with_text(self) -> DataFrame:
        """The fact before its lines get their key and type: with their stock code and text."""
        tagged = evaluate(star.priced_lines(self.lines_for_fact, self.dim_product_for_gold, self.fact_pieces), rules.FACT_SALES)
        return published(tagged)

    def share_fact(self) -> Layers:
        """Write the columns of the fact that the marts read, and how its rows met the rules, once for all
        of them (a job)."""
        self._shared_fact = sinks.stage(self.tagged_fact_sales.select(*MART_COLUMNS, RULES_FAILED, REJECTED), "fact_for_marts")
        return self

    def share_lines(self, text: bool = True) -> Layers:
        """Write the distinct lines, and how they met the rules, once for all that is made of them (a job).
        Without what follows from the rest: key and transaction type. Without ``text``, for marts alone: the type
        in place of the invoice number and the text, from which no more keys are made."""
        tagged = evaluate(clean.order_lines(self.bronze("orders"), self.pieces), rules.SILVER_ORDERS)
        rest = ("order_line_id", "transaction_type") if text else ("order_line_id", "invoice_no", clean.LINE_TEXT)
        self._shared_lines = sinks.stage(tagged.drop(*rest), "lines")
        return self

    def share_instants(self) -> Layers:
        """Write what the newest months are found by, of every line and without removing copies (a job)."""
        self._instants = sinks.stage(self.orders_for_anchor, "instants")
        return self

    def bronze(self, name: str) -> DataFrame:
        if name not in self._bronze:
            if self.sf_dir is None:
                raise ValueError(f"no bronze {name!r} and no sf_dir to derive it from")
            self._bronze[name] = feeds.FEEDS[name](self.spark, self.sf_dir)
        return self._bronze[name]

    def delivery(self, name: str, load: int) -> DataFrame:
        """The rows of one load of a feed; of the derived orders nothing else is made."""
        if name == "orders" and self._derived:
            return feeds.raw_orders(self.spark, self.sf_dir, load)
        return self.bronze(name).filter(F.col("_source_file") == f"{name}_{load}.csv")

    # ------------------------------------------------------------ tagged (all rows)

    @cached_property
    def tagged_customers(self) -> DataFrame:
        return evaluate(clean.clean_customers(self.bronze("customers")), rules.SILVER_CUSTOMERS)

    @cached_property
    def tagged_products(self) -> DataFrame:
        return evaluate(clean.clean_products(self.bronze("products")), rules.SILVER_PRODUCTS)

    @cached_property
    def tagged_orders(self) -> DataFrame:
        files = feeds.files(self.spark, "orders") if self._derived else None
        return evaluate(clean.clean_orders(self.bronze("orders"), files, self.pieces), rules.SILVER_ORDERS)

    @cached_property
    def tagged_dim_customer(self) -> DataFrame:
        return evaluate(star.dim_customer(self.silver_customers), rules.DIM_CUSTOMER)

    @cached_property
    def tagged_dim_product(self) -> DataFrame:
        return evaluate(
            star.dim_product(self.products_for_dim, self.orders_for_anchor), rules.DIM_PRODUCT
        )

    @cached_property
    def tagged_fact_sales(self) -> DataFrame:
        return evaluate(
            star.fact_sales(self.lines_for_fact, self.dim_product_for_gold, self.fact_pieces), rules.FACT_SALES
        )

    @cached_property
    def tagged_top_countries(self) -> DataFrame:
        return evaluate(
            marts.top_countries_by_customers(self.dim_customer), rules.TOP_COUNTRIES_BY_CUSTOMERS
        )

    @cached_property
    def tagged_revenue_by_country(self) -> DataFrame:
        return evaluate(
            marts.revenue_by_country(self.fact_for_marts, self.dim_customer),
            rules.REVENUE_BY_COUNTRY,
        )

    @cached_property
    def tagged_price_vs_volume(self) -> DataFrame:
        return evaluate(
            marts.price_vs_volume(self.fact_for_marts, self.dim_product_for_gold),
            rules.PRICE_VS_VOLUME,
        )

    @cached_property
    def tagged_top_price_drops(self) -> DataFrame:
        return evaluate(
            marts.top_price_drops(self.fact_for_last_month, self.dim_product_for_gold),
            rules.TOP_PRICE_DROPS,
        )

    # ------------------------------------------------------------ published

    @property
    def silver_customers(self) -> DataFrame:
        return published(self.tagged_customers)

    @property
    def stored_silver_orders(self) -> DataFrame:
        """``silver_orders`` for readers that read them several times: written once without key and type (a job)."""
        files = feeds.files(self.spark, "orders") if self._derived else None
        lines = evaluate(clean.with_key(clean.newest_lines(self.bronze("orders"), files, self.pieces)), rules.SILVER_ORDERS)
        stored = sinks.stage(published(lines).drop("order_line_id", "transaction_type"), "silver_orders")
        return conform(clean.keyed(stored), schemas.SILVER_ORDERS)

    @property
    def silver_products(self) -> DataFrame:
        return published(self.tagged_products)

    @property
    def silver_orders(self) -> DataFrame:
        return published(self.tagged_orders)

    @property
    def dim_customer(self) -> DataFrame:
        return published(self.tagged_dim_customer)

    @property
    def dim_product(self) -> DataFrame:
        return published(self.tagged_dim_product)

    @property
    def fact_sales(self) -> DataFrame:
        return published(self.tagged_fact_sales)

    @property
    def top_countries_by_customers(self) -> DataFrame:
        return published(self.tagged_top_countries)

    @property
    def revenue_by_country(self) -> DataFrame:
        return published(self.tagged_revenue_by_country)

    @property
    def price_vs_volume(self) -> DataFrame:
        return published(self.tagged_price_vs_volume)

    @property
    def top_price_drops(self) -> DataFrame:
        return published(self.tagged_top_price_drops)

    # name -> (layer, tagged attribute, rules), in build order
    TABLES = {
        "silver.customers": ("silver", "tagged_customers", rules.SILVER_CUSTOMERS),
        "silver.products": ("silver", "tagged_products", rules.SILVER_PRODUCTS),
        "silver.orders": ("silver", "tagged_orders", rules.SILVER_ORDERS),
        "gold.dim_customer": ("gold", "tagged_dim_customer", rules.DIM_CUSTOMER),
        "gold.dim_product": ("gold", "tagged_dim_product", rules.DIM_PRODUCT),
        "gold.fact_sales": ("gold", "tagged_fact_sales", rules.FACT_SALES),
        "gold.top_countries_by_customers": (
            "gold", "tagged_top_countries", rules.TOP_COUNTRIES_BY_CUSTOMERS,
        ),
        "gold.revenue_by_country": ("gold", "tagged_revenue_by_country", rules.REVENUE_BY_COUNTRY),
        "gold.price_vs_volume": ("gold", "tagged_price_vs_volume", rules.PRICE_VS_VOLUME),
        "gold.top_price_drops": ("gold", "tagged_top_price_drops", rules.TOP_PRICE_DROPS),
    }

    def tagged(self, table_name: str) -> DataFrame:
        """The tagged rows of one table (builds only what that table needs), of shared tables only the
        columns that are shared."""
        shared = {"silver.orders": "_shared_lines", "gold.fact_sales": "_shared_fact"}.get(table_name)
        if shared in self.__dict__:
            return self.__dict__[shared]
        return getattr(self, self.TABLES[table_name][1])
