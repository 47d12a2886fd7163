"""Every registered query against its DuckDB oracle at sf0.01 (driver's gate)."""

import pytest

import __spark_entry__ as E
from rumbo.plans.registered import REGISTRY
from tools.compare import compare

KEYS = sorted(E.oracle_sql())


def test_every_key_has_an_oracle():
    """All bank queries; of the training-data ones only those that SQL can express (the others: tests/llm)."""
    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, sf_dir, key):
    res = compare(spark, sf_dir, [key], verbose=False)[key]
    assert res[0] == "OK", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "idcliente"
