"""Materialise a frame that one plan reads several times.

A journey's trigger (one day's new overdrafts, one web day's visitors, the
customers turning 26, one day's receipts) feeds several branches: worst row,
covers, propensities, exclusions.  Spark re-plans each reference with its own
pruned columns and pushed filters, so the branches rarely share an exchange
and every one of them would re-scan the daily partition and re-join the contracts
table.  ``reuse`` writes the frame once as Parquet into a folder of its own
below the shared checkpoint folder named by ``spark.checkpoint.dir`` (reliable
storage: the data survives the loss of the executors that computed it) and
reads it back.  The planner then knows the files' size, so a small trigger is
broadcast to the large tables' scans before these are shuffled; a checkpoint
would keep the size estimate of the plan that made it.

Life cycle: inside a :class:`Scope` the folders belong to it and are deleted
when it closes, after the result is written or when the run fails; outside of
one they go when the application ends.
"""

from __future__ import annotations

import os
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

# "files" (default) or "off" (keep the lineage; every reference recomputes).
REUSE_MODE = os.environ.get("RUMBO_REUSE", "files")

_SCOPE: ContextVar[Scope | None] = ContextVar("rumbo_reuse_scope", default=None)


class Scope:
    """Owns the folders that :func:`reuse` writes while it is open.

    ``with Scope(spark): ...`` around building *and* writing a result: its frames read the folders
    until then.  Scopes nest; the innermost owns.  ``close`` may be called twice.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folders, self._token = spark, [], None

    def __enter__(self) -> Scope:
        self._token = _SCOPE.set(self)
        return self

    def __exit__(self, *exc) -> None:
        if self._token is not None:
            _SCOPE.reset(self._token)
            self._token = None
        self.close()

    def close(self) -> None:
        while self.folders:
            _delete(self.spark, self.folders.pop())


def _target(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _target(spark, path)
    fs.delete(target, True)
    fs.cancelDeleteOnExit(target)


def scratch_folder(spark: SparkSession, label: str = "reuse") -> str:
    """A new folder name below the shared checkpoint folder, owned by the open scope or else by the application."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    # owned before it is written: a failed write leaves a folder too
    scope = _SCOPE.get()
    if scope is not None:
        scope.folders.append(path)
    fs, target = _target(spark, path)
    fs.deleteOnExit(target)
    return path


def reuse(df: DataFrame, mode: str | None = None) -> DataFrame:
    if (mode or REUSE_MODE) == "off":
        return df
    spark = df.sparkSession
    path = scratch_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
