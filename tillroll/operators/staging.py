"""Tables written to the shared folder for the length of a job, and their removal.

A staged table cuts the lineage (a lost executor re-reads files instead of redoing the
stages before) and gives later reads column pruning and exact sizes. Whoever stages
closes: ``with Workspace(...)`` where the result is finished inside, else the session's own
workspace, which ``release`` or the end of the application removes.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import remove_path, scratch_path


class Workspace:
    """A folder of staged tables below the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{scratch_path(spark, 'work')}-{name}"
        self.staged: dict[str, list[str]] = {}

    def path(self, name: str) -> str:
        """A path not used before."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, written once and read back."""
        path = self.path(name)
        self.staged.setdefault(name, []).append(path)
        df.write.parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove the tables staged under a name, which nobody reads any more."""
        for path in self.staged.pop(name, []):
            remove_path(self.spark, path)

    def close(self) -> None:
        remove_path(self.spark, self.root)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()


_SESSIONS: dict[str, Workspace] = {}


def session_workspace(spark: SparkSession) -> Workspace:
    """The workspace of results that stay lazy (a returned DataFrame may read it any time)."""
    app = spark.sparkContext.applicationId
    if app not in _SESSIONS:
        _SESSIONS[app] = Workspace(spark, "session")
        atexit.register(_at_exit, app)
    return _SESSIONS[app]


def release(spark: SparkSession) -> None:
    """Removes what the session staged; results that are still lazy can't be read afterwards."""
    workspace = _SESSIONS.pop(spark.sparkContext.applicationId, None)
    if workspace is not None:
        workspace.close()


def _at_exit(app: str) -> None:
    workspace = _SESSIONS.pop(app, None)
    if workspace is not None and workspace.spark.sparkContext._jsc is not None:
        workspace.close()
