"""Landing folder: delivered CSV files -> bronze rows.

A delivery is a file ``<prefix>*.csv`` directly below the landing folder, or a folder of that
name that holds part files (a dataset as Spark writes it). Source columns are read by
position as nullable strings; a byte-order mark in the header is harmless.

The folder may be given in any form that Spark accepts (``file:///``, relative, with spaces or
doubled slashes): it is qualified by its file system, and a row's delivery is what stands below
it in the row's own file path, decoded. A row from anywhere else is an error, never dropped.

Bronze metadata:
- ``_source_file``: name of the delivery
- ``_source_part``: path of the part file inside the delivery ('' for a plain file)
- ``_row_id``:      place in the part: byte offset of the split plus the row's number in it.
                    A split has no more rows than bytes, so the order of
                    ``(_source_file, _source_part, _row_id)`` is the order of the delivery,
                    however Spark packs splits into tasks
- ``_ingested_at``: one instant per load
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.session import child_names, fs_path

_ROWS_OF_A_TASK = (1 << 33) - 1  # monotonically_increasing_id: the row number in its task


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with scheme and absolute path, as Hadoop writes it."""
    fs, path = fs_path(spark, folder)
    return fs.makeQualified(path).toString()


def literal_glob(path: str) -> str:
    """A path that Spark's globbing takes literally."""
    return re.sub(r"([][{}*?\\])", r"\\\1", path)


def _encoded(spark: SparkSession, folder: str) -> str:
    """The folder as it begins a file's ``_metadata.file_path``, slashes after the scheme made one."""
    _, path = fs_path(spark, qualified(spark, folder))
    return re.sub(r"^([A-Za-z][\w+.-]*):/+", r"\1:/", path.toUri().toString().rstrip("/"))


def _decoded(c: Column) -> Column:
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def lineage(spark: SparkSession, landing_dir: str, file_path: Column, block_start: Column) -> dict[str, Column]:
    """The lineage columns of a row, from where it was read."""
    folder = _encoded(spark, landing_dir) + "/"
    path = F.regexp_replace(file_path, r"^([A-Za-z][\w+.-]*):/+", "$1:/")
    below = F.when(F.startswith(path, F.lit(folder)), F.substring(path, len(folder) + 1, F.length(path))).otherwise(
        F.raise_error(F.concat(F.lit(f"not below the landing folder {folder}: "), path)).cast("string")
    )
    name = F.substring_index(below, "/", 1)
    return {
        "_source_file": _decoded(name),
        "_source_part": _decoded(F.substring(below, F.length(name) + 2, F.length(below))),
        "_row_id": block_start + F.monotonically_increasing_id().bitwiseAND(_ROWS_OF_A_TASK),
    }


def text_columns(bronze_schema: StructType) -> str:
    """DDL of the source columns of a bronze table: all text."""
    return ", ".join(f"`{name}` string" for name in bronze_schema.names if name[0] != "_")


def deliveries(spark: SparkSession, landing_dir: str, prefix: str) -> list[str]:
    """Names of the ``<prefix>*.csv`` deliveries in the folder (a listing, no content is read)."""
    return [n for n in child_names(spark, landing_dir) if n.startswith(prefix) and n.endswith(".csv")]


def read_deliveries(
    spark: SparkSession, landing_dir: str, names: Sequence[str], bronze_schema: StructType, ingested_at: Column
) -> DataFrame:
    """S1/S3/S4/S5: the rows of the named deliveries; other files are not read."""
    columns = text_columns(bronze_schema)
    if not names:
        return spark.createDataFrame([], bronze_schema)
    folder = qualified(spark, landing_dir)
    raw = (
        spark.read.schema(columns)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .csv([literal_glob(f"{folder}/{n}") for n in names])
        .select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
    )
    found = lineage(spark, landing_dir, F.col("_path"), F.col("_start"))
    return raw.withColumns({**found, "_ingested_at": ingested_at}).select(*bronze_schema.names)


def read_landing(
    spark: SparkSession, landing_dir: str, prefix: str, bronze_schema: StructType, ingested_at: Column | None = None
) -> DataFrame:
    """Every ``<prefix>*.csv`` delivery as bronze rows of one load."""
    instant = F.current_timestamp() if ingested_at is None else ingested_at
    return read_deliveries(spark, landing_dir, deliveries(spark, landing_dir, prefix), bronze_schema, instant)


def delivered(spark: SparkSession, landing_dir: str, prefix: str) -> DataFrame:
    """(file): names of the ``<prefix>*.csv`` deliveries that hold data, as a table. Spark lists the
    folder and no file is opened. A folder that does not exist, or is empty, has none."""
    source = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        found = source.load(literal_glob(qualified(spark, landing_dir)))
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "file string")
        raise
    path = found.select(F.col("_metadata.file_path").alias("_path"))
    name = lineage(spark, landing_dir, F.col("_path"), F.lit(0).cast("long"))["_source_file"]
    return path.select(name.alias("file")).filter(F.startswith("file", F.lit(prefix)) & F.endswith("file", F.lit(".csv"))).distinct()


def new_deliveries(spark: SparkSession, landing_dir: str, prefix: str, loaded: DataFrame) -> DataFrame:
    """S2/J7: (file) of the deliveries that ``loaded`` (file) does not list, whatever their age."""
    return delivered(spark, landing_dir, prefix).join(loaded.select("file"), "file", "left_anti")


def pages_of_names(names: DataFrame, page: int = 10_000) -> Iterator[list[str]]:
    """The names in order, a bounded number at a time (a scan is told its paths by the driver)."""
    rows = names.orderBy("file").toLocalIterator()
    while found := [r["file"] for r in islice(rows, page)]:
        yield found


def write_delivery(df: DataFrame, landing_dir: str, file_name: str) -> None:
    """Deliver source columns as a CSV dataset named ``file_name`` (padding kept), its part files packed. A
    packed file is read by one task, so ``df`` should have a partition for each task that is to read."""
    (
        df.write.mode("overwrite")
        .option("compression", "gzip")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(f"{landing_dir.rstrip('/')}/{file_name}")
    )
