"""Reader for the driver's parquet test tables (explicit schemas, no inference)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _S, _D, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampNTZType()

SCHEMAS: dict[str, T.StructType] = {
    "region": T.StructType([T.StructField("r_regionkey", _I), T.StructField("r_name", _S)]),
    "nation": T.StructType([T.StructField("n_nationkey", _I), T.StructField("n_name", _S),
                            T.StructField("n_regionkey", _I)]),
    "customer": T.StructType([T.StructField("c_custkey", _L), T.StructField("c_name", _S),
                              T.StructField("c_nationkey", _I), T.StructField("c_acctbal", _D),
                              T.StructField("c_mktsegment", _S)]),
    "supplier": T.StructType([T.StructField("s_suppkey", _L), T.StructField("s_name", _S),
                              T.StructField("s_nationkey", _I), T.StructField("s_acctbal", _D)]),
    "part": T.StructType([T.StructField("p_partkey", _L), T.StructField("p_name", _S),
                          T.StructField("p_brand", _S), T.StructField("p_type", _S),
                          T.StructField("p_size", _I), T.StructField("p_retailprice", _D)]),
    "orders": T.StructType([T.StructField("o_orderkey", _L), T.StructField("o_custkey", _L),
                            T.StructField("o_orderstatus", _S), T.StructField("o_totalprice", _D),
                            T.StructField("o_orderdate", _TS), T.StructField("o_orderpriority", _S)]),
    "lineitem": T.StructType([T.StructField("l_orderkey", _L), T.StructField("l_partkey", _L),
                              T.StructField("l_suppkey", _L), T.StructField("l_linenumber", _I),
                              T.StructField("l_quantity", _D), T.StructField("l_extendedprice", _D),
                              T.StructField("l_discount", _D), T.StructField("l_tax", _D),
                              T.StructField("l_returnflag", _S), T.StructField("l_linestatus", _S),
                              T.StructField("l_shipdate", _TS)]),
    "events": T.StructType([T.StructField("event_id", _L), T.StructField("ts", _TS),
                            T.StructField("user_id", _L), T.StructField("event_type", _S),
                            T.StructField("value", _D), T.StructField("props", _S)]),
    "documents": T.StructType([T.StructField("doc_id", _L), T.StructField("text", _S),
                               T.StructField("lang", _S), T.StructField("source", _S),
                               T.StructField("n_chars", _L)]),
}

DEFAULT_SF_DIR = os.environ.get("RUMBO_SF_DIR", "/root/testdata/sf0.01")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; the declared schema avoids a footer-inference pass."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class TestTables:
    """Lazy accessor: ``TestTables(spark, dir).orders`` etc."""

    def __init__(self, spark: SparkSession, sf_dir: str = DEFAULT_SF_DIR):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read(self.spark, self.sf_dir, name)
