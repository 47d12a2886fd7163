"""Heavy keys and salting, life cycle of reused triggers, sums that do not depend on order."""

import os
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rumbo.operators import agg, joins, reuse
from rumbo.plans import core, overdraft
from rumbo.session import ensure_checkpoint_dir
from rumbo.sources import sinks
from rumbo.sources.standins import AS_OF
from rumbo.sources.warehouse import standin_warehouse

SF = "/root/testdata/sf0.001"


def scratch(spark):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(root) if f.startswith("reuse-")}


def test_heavy_keys_are_found_with_their_rows(spark):
    rows = spark.range(0, 120_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None))
                                          .otherwise(F.col("id").cast("string")).alias("k"))
    (h,) = joins.heavy_keys(rows, "k")
    assert h.value == "hot" and abs(h.rows - 40_000) < 800 and h.parts == 4      # of 80,000 with a key, on 8 partitions
    assert joins.heavy_keys(rows.filter("k <> 'hot'"), "k") == []
    assert joins.heavy_keys(rows.limit(0), "k") == []
    assert joins.heavy_keys(rows.limit(3000), "k") == []                        # too few rows to matter


keys = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=15), st.lists(st.tuples(keys, st.integers(0, 2)), max_size=40))
def test_salted_join_equals_left_join(spark, left_rows, right_rows):
    """Every key with two rows counts as heavy; equal rows, null keys and keys of one side included."""
    left = spark.createDataFrame(left_rows, "k int, x int")
    right = spark.createDataFrame(right_rows, "rk int, y int")
    out = joins.left_join_skew_safe(left, right, [("k", "rk")], factor=0.01, least_rows=2)
    got = sorted(map(str, out.collect()))
    assert got == sorted(map(str, left.join(right, left.k == right.rk, "left").collect()))
    assert out.columns == ["k", "x", "rk", "y"]


def test_salted_join_over_text_and_number_keys(spark):
    left = spark.createDataFrame([("1", "a"), ("2", "b"), ("x", "c"), (None, "d")], "k string, x string")
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(3, 0)], "rk long, y int")
    out = joins.left_join_skew_safe(left.filter("k <> 'x' or k is null"), right, [("k", "rk")], factor=0.1, least_rows=10)
    assert out.count() == 50 + 2


def test_hot_rows_are_dealt_to_several_tasks(spark):
    left = spark.range(0, 100).select(F.col("id").alias("k"))
    right = spark.range(0, 60_000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 100).cast("long").alias("rk"),
                                          F.col("id").alias("y"))
    (h,) = joins.heavy_keys(right, "rk")
    dealt = right.filter("rk = 7").groupBy(F.pmod(F.xxhash64("rk", "y"), F.lit(h.parts))).count().collect()
    assert h.parts >= 4 and len(dealt) == h.parts and max(r["count"] for r in dealt) < 1.2 * 30_300 / h.parts
    out = joins.left_join_skew_safe(left, right, [("k", "rk")])
    assert out.count() == left.join(right, F.col("k") == F.col("rk"), "left").count()


def test_customer_core_writes_nothing_before_its_result(spark):
    before = scratch(spark)
    df = core.customer_core(standin_warehouse(spark, SF), AS_OF)
    assert scratch(spark) == before and df.count() > 0 and scratch(spark) == before


# ---- life cycle ----------------------------------------------------------------

def test_triggers_go_with_their_run(spark, tmp_path):
    src, before = standin_warehouse(spark, SF), scratch(spark)
    sinks.run_journey(spark, overdraft.overdraft_master, src, AS_OF, str(tmp_path / "out"))
    assert scratch(spark) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == overdraft.overdraft_master(src, AS_OF).count()


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    src, before = standin_warehouse(spark, SF), scratch(spark)
    with reuse.Scope(spark) as scope:
        df = overdraft.overdraft_master(src, AS_OF)
        assert len(scope.folders) >= 1 and scratch(spark) > before and df.count() >= 0
    assert scratch(spark) == before

    def broken(src, as_of):
        overdraft.overdraft_master(src, as_of)
        raise ValueError("no result")

    with pytest.raises(ValueError):
        sinks.run_journey(spark, broken, src, AS_OF, str(tmp_path / "out"))
    with pytest.raises(Exception):
        with reuse.Scope(spark):
            reuse.reuse(spark.range(10).select(F.raise_error(F.lit("while writing")).alias("x")), mode="files")
    assert scratch(spark) == before


def test_scopes_nest(spark):
    before = scratch(spark)
    with reuse.Scope(spark) as outer:
        a = reuse.reuse(spark.range(3), mode="files")
        with reuse.Scope(spark):
            b = reuse.reuse(a, mode="files")
            assert b.count() == 3
        assert len(outer.folders) == 1 and a.count() == 3 and len(scratch(spark) - before) == 1
    assert scratch(spark) == before


# ---- exact sums ------------------------------------------------------------------

def adversarial(n=400):
    """Amounts that cancel to one cent per key, so a sum of doubles has the wrong sign in some orders."""
    r = random.Random(3)
    rows = []
    for k in range(6):
        big = [r.choice([1e13, 3e12, 7e11, 0.1, 0.07]) * r.randint(1, 90) / 7 for _ in range(n)]
        big = [round(x, 2) for x in big]
        rows += [(k, x) for x in big] + [(k, -x) for x in big] + [(k, (-1) ** k * 0.01)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 8, 200])
def test_sums_do_not_depend_on_partitions(spark, partitions):
    rows = adversarial()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        df = spark.createDataFrame(rows, "k int, v double").repartition(partitions)
        signs = {r["k"]: r["f"] for r in agg.sum_sign_flag(df, "k", "v", "f").collect()}
        sums = {r["k"]: r["s"] for r in df.groupBy("k").agg(agg.exact_sum("v").alias("s")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert signs == {k: int(k % 2 == 0) for k in range(6)}
    assert sums == {k: Decimal(-1) ** k * Decimal("0.01") for k in range(6)}


def test_null_amounts_and_empty_groups(spark):
    df = spark.createDataFrame([(1, None), (2, None), (2, 0.1)], "k int, v double")
    assert {r["k"]: r["f"] for r in agg.sum_sign_flag(df, "k", "v", "f").collect()} == {1: 0, 2: 1}
