"""Bucketed tables on the customer key: enrichments without shuffling the tables.

Every journey enriches a trigger with several tables by the customer's key
(reduce to the trigger's customers, aggregate, left join).  When the trigger is
too large to broadcast, each of these tables is shuffled by the same key in
every run.  :func:`write_bucketed` stores them once as catalog tables bucketed
and sorted by that key, all with the same number of buckets: their semi
joins, aggregates and joins then need no Exchange on the table side, and the
trigger is shuffled once to the same buckets.

A bucket is read by one task and AQE cannot split it, so a table whose key has
a heavy customer (``joins.heavy_keys`` at the number of buckets) is stored
without buckets; its joins keep the shuffle, which AQE can split.

:func:`write_bucketed` replaces a table as a whole, one after another: it runs between
journeys, not beside them.  The result is read through :class:`BucketedSources`,
a catalog source: journeys run on it unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import heavy_keys
from .registry import CatalogSources

# FIXED VALUES: customer key of the tables that enrichments join by customer.
CUSTOMER_KEY = {
    "contracts": "copemk", "person_board": "copemk", "customer_attrs": "copemk", "value_managers": "copemk",
    "loans": "copemk", "cards": "copemk", "policies": "copemk", "programme": "copemk",
    "payroll_contracts": "copemk", "payroll_amounts": "copemk", "account_domiciliations": "copemk", "monthly_accounts": "copemk",
    "scores_a": "idpers", "scores_b": "co_cliente", "monthly_board": "co_cliente", "contracting_events": "co_cliente",
    "customers_daily": "id_cliente", "web_hits": "id_cliente",
}
# Rows of a key below which it is no load for the task that reads its bucket.
HEAVY_ROWS = 1_000_000


class BucketedSources(CatalogSources):
    """The tables of ``base``, some of them replaced by bucketed catalog tables."""

    def __init__(self, spark: SparkSession, base, tables: Mapping[str, str]):
        super().__init__(spark)
        self.base, self.tables = base, dict(tables)

    def table(self, name: str) -> DataFrame:
        return super().table(name) if name in self.tables else getattr(self.base, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name == "base":
            raise AttributeError(name)
        return self.table(name)

    def partitions(self, name: str, equal=None):
        if name in self.tables:
            return super().partitions(name, equal)
        listed = getattr(self.base, "partitions", None)
        return listed(name, equal) if listed is not None else None


def bucket_count(df: DataFrame, rows_per_bucket: int = 2_000_000) -> int:
    """Buckets for a table, a power of two, so that tables of different counts still fit each other."""
    return 1 << max(0, (max(1, df.count()) - 1) // rows_per_bucket).bit_length()


def write_bucketed(src, database: str, buckets: int, tables: Sequence[str] = tuple(CUSTOMER_KEY),
                   partitioned_by: Mapping[str, Sequence[str]] | None = None, location: str | None = None,
                   heavy_rows: int = HEAVY_ROWS) -> BucketedSources:
    """Store ``tables`` of ``src`` in ``database``, bucketed by the customer's key, and return sources that read them.

    ``partitioned_by`` names the partition columns of each table, which stay its
    partitions.  Every partition has at most one file a bucket.
    """
    spark = getattr(src, tables[0]).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    stored = {}
    for name in tables:
        df, key, parts = getattr(src, name), CUSTOMER_KEY[name], list((partitioned_by or {}).get(name, ()))
        full = f"{database}.{name}"
        if heavy_keys(df, key, least_rows=heavy_rows):
            out = df.hint("rebalance", *parts) if parts else df.hint("rebalance")
            writer = out.write
        else:
            # the same hash as the buckets': each task writes one of them
            writer = df.repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(key)
        if parts:
            writer = writer.partitionBy(*parts)
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        writer.format("parquet").saveAsTable(full)
        stored[name] = full
    return BucketedSources(spark, src, stored)


def is_bucketed(spark: SparkSession, table: str) -> bool:
    """Whether the catalog has bucket columns for ``table``."""
    return any(c.isBucket for c in spark.catalog.listColumns(table))
