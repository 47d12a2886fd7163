"""Tiny synthetic bank: literal tables with the warehouse schemas."""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

from rumbo.sources.standins import StandinSources

DEFAULTS = {"xcoemp": 0, "cosiig": 10000, "snapshot": "LATEST", "idcoec": "0001"}


@cache
def _schemas(spark):
    src = StandinSources(spark, "/root/testdata/sf0.001")
    return src


class Bank:
    """``Bank(spark, balances=[...], contracts=[...])``; missing tables are empty."""

    def __init__(self, spark, **tables):
        self._spark = spark
        self._tables = tables
        self._cache = {}

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            schema = T.StructType([T.StructField(f.name, f.dataType, True)
                                   for f in getattr(_schemas(self._spark), name).schema.fields])
            rows = []
            for r in self._tables.get(name, []):
                full = {f.name: r.get(f.name, DEFAULTS.get(f.name)) for f in schema.fields}
                rows.append(tuple(full[f.name] for f in schema.fields))
            self._cache[name] = self._spark.createDataFrame(rows, schema)
        return self._cache[name]
