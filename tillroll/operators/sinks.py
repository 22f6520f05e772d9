"""Table sinks on plain Parquet: append, atomic replace, keyed upsert.

No table format (Iceberg/Delta) is assumed, so:

- ``replace`` writes the new content to a folder of its own and then adds an empty file
  ``_current-<number>-<folder>``. Creating a file is atomic on every store, and readers take
  the highest number, so they see the old content or the new, never half of it. A crash
  before that leaves the table as it was.
- ``upsert`` of an unpartitioned table is a ``replace`` by the merged rows.
- ``upsert`` of a table partitioned by a column that a key never moves across (orders: the key
  hashes the invoice date text, so a line never changes month) rewrites only the partitions
  that the source touches: they are written to a folder of their own, then a list of every
  partition's folder (``_manifest-<id>.json``: partition values, bounded by the calendar), then
  the ``_current`` file that names the list. All partitions change at once.
- what a reader of the version before may still read is kept until the next version is begun;
  anything older goes.

A source must have one row per key: repeated keys are refused, as MERGE does. NULL keys match
nothing and are inserted. Read tables with ``read_table``, which follows ``_current``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.operators.schema import conform, empty
from tillroll.operators.staging import Workspace, session_workspace
from tillroll.session import child_names, folder_bytes, fs_path, path_exists, read_small, remove_path, splits_of, write_small
from tillroll.sources.landing import literal_glob

POINTER, MANIFEST = "_current-", "_manifest-"
#: Keys are hashes in hexadecimal, which the default codec leaves as long as they are.
CODEC = "zstd"
OWN = (POINTER, MANIFEST, "version-", "_parts-")
#: Keys of a source that are broadcast at once (some 100 bytes each). More go a group of partitions at a time.
BROADCAST_KEYS = 1 << 19
#: What a task of a merge reads of the target: it sorts these rows by partition.
SPLIT_BYTES = 32 << 20


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once in the session's workspace and read it back (lineage cut)."""
    return session_workspace(df.sparkSession).stage(df, name)


# ---------------------------------------------------------------- reading


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    names = [n[len(POINTER) :] for n in child_names(spark, path) if n.startswith(POINTER)]
    return sorted((int(n.split("-", 1)[0]), n.split("-", 1)[1]) for n in names)


def _current(spark: SparkSession, path: str) -> str:
    """What the table consists of now: a folder below it, a list of partitions' folders, or '' (the
    table's own path, if it was never replaced)."""
    pointers = _pointers(spark, path)
    return pointers[-1][1] if pointers else ""


def _below(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}" if name else path


def content_path(spark: SparkSession, path: str) -> str:
    """Folder of the current content of a table that is not a list of partitions' folders."""
    current = _current(spark, path)
    if current.startswith(MANIFEST):
        raise ValueError(f"{path} is a list of partitions, not one folder")
    return _below(path, current)


def partition_folders(spark: SparkSession, path: str, current: str | None = None) -> dict[str, str]:
    """Partition folder name (``month=...``) -> the folder below the table that it is in."""
    current = _current(spark, path) if current is None else current
    if current.startswith(MANIFEST):
        return json.loads(read_small(spark, _below(path, current)))
    return {n: current for n in child_names(spark, _below(path, current)) if "=" in n}


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S6: the table with its declared schema; empty if it does not exist.

    The explicit schema also stops partition values being re-inferred (a month
    partition would otherwise come back as a date or string).
    """
    current = _current(spark, path)
    reader = spark.read.schema(schema)
    if current.startswith(MANIFEST):
        found: dict[str, list[str]] = {}
        for name, folder in partition_folders(spark, path, current).items():
            found.setdefault(folder, []).append(literal_glob(f"{_below(path, folder)}/{name}"))
        if not found:
            return empty(spark, schema)
        parts = [reader.option("basePath", _below(path, f)).parquet(*names).select(*schema.names) for f, names in sorted(found.items())]
        return reduce(DataFrame.unionByName, parts)
    try:
        return reader.parquet(_below(path, current))
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, schema)
        raise


# ---------------------------------------------------------------- writing


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K1: add rows."""
    df.write.mode("append").partitionBy(*partition_by).parquet(content_path(df.sparkSession, path), compression=CODEC)


def compact(spark: SparkSession, path: str, schema: StructType, most_files: int = 64) -> bool:
    """An appended table's many small files become one, atomically, once there are over ``most_files``:
    for tables of some rows a run, whose readers would otherwise open a file a run."""
    files = [n for n in child_names(spark, content_path(spark, path)) if n.endswith(".parquet")]
    if len(files) > most_files:
        replace(read_table(spark, path, schema).coalesce(1), path)
    return len(files) > most_files


def replace(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), keys: Sequence[str] = (), finish: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """K2: full replace, atomic. ``df`` may read the table itself. With ``partition_by`` rows are
    clustered by (partition, keys) first, so that a task writes few partitions. ``finish`` makes the
    stored columns of the clustered rows (long ones that follow from others, as hashes, are not exchanged)."""
    spark = df.sparkSession
    _remove_all_but(spark, path, _current(spark, path))
    folder = f"version-{uuid.uuid4().hex[:12]}"
    rows = clustered_by(df, partition_by[0], keys) if partition_by else df
    rows = finish(rows) if finish else rows
    rows.write.partitionBy(*partition_by).parquet(_below(path, folder), compression=CODEC)
    _switch(spark, path, folder)


def _switch(spark: SparkSession, path: str, current: str) -> None:
    """Make ``current`` the table's content; the content before it stays for running readers until the
    next version is begun, anything older goes."""
    before = _pointers(spark, path)
    number = before[-1][0] + 1 if before else 1
    fs, pointer = fs_path(spark, _below(path, f"{POINTER}{number:012d}-{current}"))
    fs.create(pointer, False).close()
    _remove_all_but(spark, path, current, before[-1][1] if before else "")


def _remove_all_but(spark: SparkSession, path: str, *versions: str) -> None:
    """Remove what no version of these consists of."""
    kept = set().union(*(_names_of(spark, path, v) for v in versions))
    for name in child_names(spark, path):
        wanted = name.split("-", 2)[2] in versions if name.startswith(POINTER) else name in kept
        if not wanted:
            remove_path(spark, _below(path, name))


def _names_of(spark: SparkSession, path: str, current: str) -> set[str]:
    """Names directly below the table that a version of it consists of."""
    if not current:
        return {n for n in child_names(spark, path) if not n.startswith(OWN)}
    if not current.startswith(MANIFEST):
        return {current}
    folders = partition_folders(spark, path, current)
    return {current} | {folder.split("/")[0] or name for name, folder in folders.items()}


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J8: the state after MERGE: matched rows take the source row, the rest are kept,
    new source rows are inserted, nothing is deleted (lazy)."""
    source = source.select(*target.columns)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source)


def refuse_repeated_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Raises if a (non-NULL) key stands in several rows. Only keys whose 64-bit hash stands in several
    rows are compared themselves, so that without repeats only hashes are exchanged."""
    known = source.select(*keys).dropna().withColumn("_hash", F.xxhash64(*keys))
    shared = known.groupBy("_hash").count().filter("count > 1").select("_hash")
    if shared.isEmpty():
        return
    suspects = known.join(shared, "_hash", "left_semi").groupBy(*keys).count()
    found = suspects.filter("count > 1").drop("count").limit(1).collect()  # one row at most
    if found:
        raise ValueError(f"the source of an upsert repeats the key {found[0].asDict()}")


def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    partition_col: str | None = None,
    stored: bool = False,
    laid_out: Sequence[str] = (),
) -> None:
    """K3: keyed upsert into the Parquet table at ``path``. The source is computed once, unless it is read
    from stored files anyway (``stored``). With partitions its rows are written where they are to stay and
    read there; ``laid_out``: they are in ranges of (partition, these columns) already."""
    if partition_col is not None:
        rows, folder = conform(source, schema), new_parts(spark, path)
        if laid_out:
            rows = rows.sortWithinPartitions(partition_col, *laid_out)
        add_parts(rows if laid_out else clustered_by(rows, partition_col, keys), path, folder, [partition_col])
        merge_parts(spark, path, folder, schema, keys, partition_col)
        return
    with Workspace(spark, "upsert") as ws:
        source = conform(source, schema) if stored else ws.stage(conform(source, schema), "source")
        refuse_repeated_keys(source, keys)
        replace(merged(read_table(spark, path, schema), source, keys), path)


def new_parts(spark: SparkSession, path: str) -> str:
    """Name of a folder for partitions that are going to be the table's. What only readers of the version
    before the current one may still read goes first: a table is on disk twice at most."""
    _remove_all_but(spark, path, _current(spark, path))
    return f"_parts-{uuid.uuid4().hex[:12]}"


def add_parts(df: DataFrame, path: str, folder: str, partition_by: Sequence[str]) -> None:
    """Rows for the partitions below ``folder``, which are no content of the table yet."""
    df.write.mode("append").partitionBy(*partition_by).parquet(_below(path, folder), compression=CODEC)


def switch_parts(spark: SparkSession, path: str, folder: str, whole: bool = False) -> None:
    """Make the partitions below ``folder`` the table's, all at once; the other partitions stay, or go (``whole``)."""
    written = {n: folder for n in child_names(spark, _below(path, folder)) if "=" in n}
    if not written and not whole:
        remove_path(spark, _below(path, folder))
        return
    manifest = f"{MANIFEST}{uuid.uuid4().hex[:12]}.json"
    write_small(spark, _below(path, manifest), json.dumps(written if whole else partition_folders(spark, path) | written))
    _switch(spark, path, manifest)


def merge_parts(spark: SparkSession, path: str, folder: str, schema: StructType, keys: Sequence[str], partition_col: str) -> list:
    """MERGE with a source that is stored below ``folder``: the table's rows of the partitions that the source
    touches are added to it, but for those it has the key of, and the partitions are switched. The table's
    rows are not exchanged: they lie by partition, and the source's keys of a group of partitions are
    broadcast, up to BROADCAST_KEYS of them (a partition with more new keys than that is joined by an exchange).
    Returns the touched partitions' values."""
    if not path_exists(spark, _below(path, folder)):
        return []
    new = spark.read.schema(schema).parquet(_below(path, folder))
    try:
        refuse_repeated_keys(new, keys)
    except ValueError:
        remove_path(spark, _below(path, folder))
        raise
    touched = {r[0]: r[1] for r in new.groupBy(partition_col).count().collect()}  # one row a partition
    target = read_table(spark, path, schema)
    with splits_of(spark, SPLIT_BYTES):
        for values in groups_up_to(touched, BROADCAST_KEYS) if partition_folders(spark, path) else ():
            these = in_partitions(partition_col, values)
            known = new.filter(these).select(*keys)
            few = sum(touched[v] for v in values) <= BROADCAST_KEYS
            kept = target.filter(these).join(F.broadcast(known) if few else known, list(keys), "left_anti")
            add_parts(kept.select(*schema.names), path, folder, [partition_col])
    switch_parts(spark, path, folder)
    return list(touched)


def groups_up_to(sizes: dict, most: int) -> list[list]:
    """The keys of ``sizes`` in order (None first), in groups of up to ``most`` together or of one."""
    groups: list[list] = []
    room = 0
    for key in sorted(sizes, key=lambda k: (k is not None, k)):
        if not groups or sizes[key] > room:
            groups.append([])
            room = most
        groups[-1].append(key)
        room -= sizes[key]
    return groups


def overwrite_partitions(df: DataFrame, path: str, partition_col: str, keys: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of, all at once, and no others. Rows are
    range-partitioned by (partition, key): few files per partition, and a hot partition (one month
    with a third of all rows) is split over many tasks. ``df`` may read the table itself."""
    spark, folder = df.sparkSession, new_parts(df.sparkSession, path)
    add_parts(clustered_by(df, partition_col, keys), path, folder, [partition_col])
    switch_parts(spark, path, folder)


def partition_bytes(spark: SparkSession, path: str) -> dict[str, int]:
    """Partition folder name -> bytes of its files (a listing)."""
    return {n: folder_bytes(spark, f"{_below(path, folder)}/{n}") for n, folder in partition_folders(spark, path).items()}


def partition_values(df: DataFrame, partition_col: str) -> list:
    """Distinct partition values present in ``df`` (metadata: bounded by the number
    of partitions of the table, e.g. calendar months), to plan a pruned read."""
    return [r[0] for r in df.select(partition_col).distinct().collect()]


def in_partitions(partition_col: str, values: list) -> F.Column:
    """Literal partition filter: Spark prunes the other partitions at listing time
    (``PartitionFilters``), so untouched partitions are never read."""
    col = F.col(partition_col)
    known = [v for v in values if v is not None]
    cond = col.isin(known) if known else F.lit(False)
    return cond | col.isNull() if len(known) < len(values) else cond


def clustered_by(df: DataFrame, partition_col: str, keys: Sequence[str]) -> DataFrame:
    """Rows ordered into tasks by (partition value, key) ranges before a partitioned
    write: each task writes few partition values, no partition value is one task."""
    return df.repartitionByRange(partition_col, *keys)


def month_partition(ts: str, name: str = "invoice_month") -> tuple[str, F.Column]:
    """K5: the first day of the month of a timestamp as a partition column."""
    return name, F.trunc(F.to_date(F.col(ts)), "MM")
