"""Control table as a table: how far each source has been loaded, written by its loads.

The rules that read "the newest partition" through a control table need one
row a source: its newest complete load.  Here every load appends that row when it
has finished (:meth:`LoadMarks.append`), in a partition of its own
``(source, run_date)`` that a re-run of the load replaces, so running it twice
changes nothing; a load that failed before that has left no mark, and readers
go on with the one before.  :meth:`LoadMarks.newest` takes a source's greatest
mark not after the run date: no table is listed, opened or aggregated for it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .newest import folder_exists

SCHEMA = "mark string, rows long, source string, run_date date"


class LoadMarks:
    """Marks below ``path``: ``(source, run_date, mark, rows)``, one row for each load of a source."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def append(self, source: str, run_date: _dt.date, mark: str, rows: int | None = None) -> None:
        """Record that the load of ``run_date`` has brought ``source`` up to ``mark``."""
        self.append_all([(source, run_date, mark, rows)])

    def append_all(self, marks: Iterable[tuple[str, _dt.date, str, int | None]]) -> None:
        df = self.spark.createDataFrame([(m, n, s, d) for s, d, m, n in marks], SCHEMA).coalesce(1)
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "run_date").parquet(self.path))

    def control(self, as_of: _dt.date, at_most: str | None = None) -> DataFrame:
        """``(C1 source, C2 greatest mark)`` of the loads run up to ``as_of``, not beyond the mark ``at_most``."""
        known = self.read().filter(F.col("run_date") <= F.lit(as_of))
        if at_most is not None:
            known = known.filter(F.col("mark") <= F.lit(at_most))
        return known.groupBy(F.col("source").alias("C1")).agg(F.max("mark").alias("C2"))

    def newest(self, source: str, as_of: _dt.date, at_most: str | None = None) -> str | None:
        row = self.control(as_of, at_most).filter(F.col("C1") == source).first()
        return row["C2"] if row else None
