"""Output writer for journey datasets.

Each run writes one ``run_date`` partition with dynamic partition overwrite:
re-running a date (after a failed job or a lost executor) replaces exactly
that partition and nothing else, so runs are idempotent.

:func:`run_journey` builds and writes a journey inside one scope, so the
triggers that it has written for itself are gone when it returns or fails.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.observe import RuleMetrics
from ..operators.reuse import Scope


def write_run(df: DataFrame, path: str, as_of: _dt.date, fmt: str = "parquet",
              partition_col: str = "run_date") -> None:
    (df.withColumn(partition_col, F.lit(as_of))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).format(fmt).save(path))


def run_journey(spark: SparkSession, plan: Callable[..., DataFrame], src, as_of: _dt.date, path: str, **params) -> list[str]:
    """``plan(src, as_of, **params)`` written as the ``as_of`` partition; leaves no scratch folder behind.

    Logs and returns the warnings of the rules' run-time metrics.
    """
    with Scope(spark), RuleMetrics() as metrics:
        write_run(plan(src, as_of, **params), path, as_of)
        return metrics.report()
