"""Warehouse layout: banking tables as partitioned Parquet folders.

``WarehouseSources(spark, root)`` reads ``root/<table>`` with a declared
schema (partition columns keep their string / int types instead of being
re-inferred).  ``standin_warehouse`` writes each test-data stand-in once, when it is first read, into
that layout under the shared checkpoint folder (``spark.checkpoint.dir``):
the derivation runs once per data set, lineage is cut at a durable table
that survives executor loss, and every journey then reads only the partitions
it names (partition pruning + Parquet pushed filters), as it would in the
bank's warehouse.
"""

from __future__ import annotations

import hashlib
import os
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .marks import LoadMarks
from .newest import NewestValues, Partition, folder_partitions
from .standins import StandinSources

# table -> partition columns (the bank's partitioning; [] = unpartitioned).
LAYOUT: dict[str, list[str]] = {
    "account_balance": ["snapshot", "extractiondate"],
    "contracts": ["snapshot"],
    "holder_codes": ["snapshot"],
    "fund_contracts": ["snapshot"],
    "plan_contracts": ["snapshot"],
    "plan_operations": [],
    "payroll_contracts": ["snapshot"],
    "loans": ["snapshot"],
    "cards": ["snapshot"],
    "person_board": ["snapshot"],
    "customers_daily": ["dt"],
    "managers": ["snapshot"],
    "manager_contacts": ["snapshot"],
    "customer_attrs": ["snapshot"],
    "value_managers": ["snapshot"],
    "programme": [],
    "catalogue": [],
    "dictionary_attrs": ["snapshot"],
    "dictionary_values": ["snapshot"],
    "scores_a": ["extractiondate"],
    "scores_b": ["sessionid"],
    "model_thresholds": ["snapshot", "extractiondate"],
    "web_hits": ["dt", "fe_adobe_extraction_dia"],
    "receipts": ["snapshot"],
    "policies": ["snapshot"],
    "account_domiciliations": ["extractiondate"],
    "monthly_board": ["process_date"],
    "monthly_accounts": ["extractiondate"],
    "contracting_events": ["dt"],
    "payroll_amounts": ["snapshot"],
}
# Row-group size of the written files, near a storage block; tests set a small
# one so that few-MB tables still split over every core.
ROW_GROUP_BYTES = int(os.environ.get("RUMBO_ROW_GROUP_BYTES", str(128 * 1024 * 1024)))
# Tables sorted (within each written file) on the column their readers filter
# on, so row-group min/max statistics let Parquet skip most of each file.
# A sort of a task's rows costs memory and spills: columns that are only joined on get none, nor do
# receipts, whose rows come out of two joins.
SORT_BY = {"catalogue": ["extractiondate"], "programme": ["fevaig"], "customers_daily": ["fecha_derivado"]}


# Partition values that a writing task keeps open at once.  Up to so many, Spark writes the rows as
# they come; the rows of further values it sorts by value first.
OPEN_FILES = 100
_WRITING = threading.RLock()


@contextmanager
def _open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Writes inside keep up to ``most`` files a task open instead of sorting a task's rows by partition value."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    with _WRITING:
        before = spark.conf.get(key, None)
        spark.conf.set(key, str(most))
        try:
            yield
        finally:
            if before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


class WarehouseSources(NewestValues):
    """Banking tables read from ``root/<table>`` Parquet folders."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None,
                 marks: LoadMarks | None = None):
        self.spark, self.root, self.schemas, self.marks = spark, root.rstrip("/"), schemas or {}, marks
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            reader = self.spark.read
            if name in self.schemas:
                reader = reader.schema(self.schemas[name])
            self._cache[name] = reader.parquet(f"{self.root}/{name}")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in LAYOUT:
            raise AttributeError(name)
        return self.table(name)

    def partitions(self, name: str, equal=None) -> list[Partition]:
        return folder_partitions(self.spark, f"{self.root}/{name}", self.table(name).schema, equal)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _publish(spark: SparkSession, tmp: str, path: str) -> None:
    """Move ``tmp`` to ``path`` unless another writer got there first.

    If a concurrent build published in between, the rename lands inside the
    other table as a ``_``-prefixed folder (ignored by Spark's file listing)
    and is removed; the first complete build stands.
    """
    P = spark._jvm.org.apache.hadoop.fs.Path
    src, dst = P(tmp), P(path)
    fs = dst.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(dst):
        fs.rename(src, dst)
    nested = P(dst, src.getName())
    if fs.exists(nested):
        fs.delete(nested, True)
    if fs.exists(src):
        fs.delete(src, True)


def _signature(spark: SparkSession, sf_dir: str) -> str:
    """Data set + stand-in code version: changed files (wherever they lie) or a changed rule never read a stale build."""
    h = hashlib.sha1(sf_dir.rstrip("/").encode())
    here = os.path.dirname(os.path.abspath(__file__))
    for f in ("standins.py", "warehouse.py", "testdata.py"):
        with open(os.path.join(here, f), "rb") as fh:
            h.update(fh.read())
    target = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        found = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(target)]
        for name, size, changed in sorted(found):
            h.update(f"{name}:{size}:{changed // 1000}".encode())
    return h.hexdigest()[:16]


class StandinWarehouse(WarehouseSources):
    """The stand-in tables in the warehouse layout; each is written when it is first read."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        super().__init__(spark, root)
        self._standins, self._lock = StandinSources(spark, sf_dir), threading.RLock()

    def table(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._cache:
                self._write(name)
            return super().table(name)

    def partitions(self, name: str, equal=None) -> list[Partition]:
        self.table(name)
        return super().partitions(name, equal)

    def build_all(self) -> StandinWarehouse:
        for name in LAYOUT:
            self.table(name)
        return self

    def _write(self, name: str) -> None:
        df, parts = getattr(self._standins, name), LAYOUT[name]
        self.schemas[name] = df.schema
        path = f"{self.root}/{name}"
        if _exists(self.spark, f"{path}/_SUCCESS"):
            return
        # Each task writes the rows that it derives: no exchange, whatever a partition
        # value holds, and one file for each value and task.
        out = df.sortWithinPartitions(*SORT_BY[name]) if name in SORT_BY else df
        t0 = time.perf_counter()
        # Write to a private folder, then publish it with one directory rename
        # (atomic on HDFS and local disks): another process building the same
        # data set never sees, or overwrites, a half-written table.
        tmp = f"{self.root}/_inprogress-{uuid.uuid4().hex[:12]}-{name}"
        with _open_files(self.spark, OPEN_FILES):
            (out.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES)
             .partitionBy(*parts).parquet(tmp))
        _publish(self.spark, tmp, path)
        BUILD_SECONDS[name] = round(time.perf_counter() - t0, 3)


_BUILT: dict[tuple[str, str], StandinWarehouse] = {}
_LOCK = threading.Lock()
BUILD_SECONDS: dict[str, float] = {}


def standin_warehouse(spark: SparkSession, sf_dir: str, root: str | None = None) -> StandinWarehouse:
    """Open the stand-in warehouse for the tables in ``sf_dir``; one for each application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _BUILT or root is not None:
            folder = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/standin-warehouse/{_signature(spark, sf_dir)}"
            _BUILT[key] = StandinWarehouse(spark, sf_dir, folder)
        return _BUILT[key]
