"""How the stand-in warehouse writes its tables: rows stay in the tasks that derive them."""

import datetime as dt
import glob
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rumbo.sources import warehouse
from rumbo.sources.standins import StandinSources
from rumbo.sources.warehouse import LAYOUT, StandinWarehouse

ORDERS, CUSTOMERS = 4_000, 300


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small test tables, orders over a year in no order; a few keys and days are null or repeated."""
    path = str(tmp_path_factory.mktemp("tables"))
    n = F.col("id")
    day = F.to_timestamp_ntz(F.date_add(F.lit(dt.date(2000, 8, 1)), (n * 7919 % 360).cast("int")).cast("string"))
    orders = spark.range(ORDERS).select(
        F.when(n % 97 != 0, n % (ORDERS - 50)).alias("o_orderkey"), (n % CUSTOMERS).alias("o_custkey"),
        F.element_at(F.array(*map(F.lit, "OFP")), (n % 3 + 1).cast("int")).alias("o_orderstatus"), (n * 100.0).alias("o_totalprice"),
        F.when(n % 101 != 0, day).alias("o_orderdate"),
        F.element_at(F.array(*map(F.lit, ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))), (n % 5 + 1).cast("int")).alias("o_orderpriority"))
    orders.repartition(4).write.parquet(f"{path}/orders.parquet")
    spark.range(CUSTOMERS).select(
        n.alias("c_custkey"), F.concat(F.lit("C"), n.cast("string")).alias("c_name"), (n % 25).cast("int").alias("c_nationkey"),
        (n * 31.5 - 900).alias("c_acctbal"),
        F.element_at(F.array(*map(F.lit, ("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"))), (n % 5 + 1).cast("int"))
        .alias("c_mktsegment")).write.parquet(f"{path}/customer.parquet")
    # order lines from the last key to the first
    spark.range(2 * ORDERS).coalesce(1).select(
        (ORDERS - 1 - F.floor(n / 2)).alias("l_orderkey"), (n * 13 % 40).alias("l_partkey"), n.alias("l_suppkey"), (n % 7).cast("int").alias("l_linenumber"),
        (n * 1.0).alias("l_quantity"), (n * 20.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate")).write.parquet(f"{path}/lineitem.parquet")
    spark.range(40).select(
        n.alias("p_partkey"), F.concat(F.lit("part "), n.cast("string")).alias("p_name"), F.concat(F.lit("Brand#"), (n % 25 + 1).cast("string")).alias("p_brand"),
        F.element_at(F.array(*map(F.lit, ("STANDARD", "PROMO"))), (n % 2 + 1).cast("int")).alias("p_type"), n.cast("int").alias("p_size"),
        (n * 1.0).alias("p_retailprice")).write.parquet(f"{path}/part.parquet")
    spark.range(900).select(
        n.alias("event_id"), F.to_timestamp_ntz(F.date_add(F.lit(dt.date(2024, 1, 1)), (n % 30).cast("int")).cast("string")).alias("ts"), (n % 25).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("view", "purchase"))), (F.floor(n / 30) % 2 + 1).cast("int")).alias("event_type"), (n * 1.5).alias("value"),
        F.lit("p").alias("props")).write.parquet(f"{path}/events.parquet")
    return path


def built(spark, tables, tmp_path):
    return StandinWarehouse(spark, tables, str(tmp_path / "root"))


def stages_of(spark, run) -> int:
    """Stages of the jobs that ``run`` starts."""
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setLocalProperty("spark.jobGroup.id", group)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    return sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group))


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("name", ["account_domiciliations", "monthly_accounts", "monthly_board", "contracting_events",
                                  "contracts", "policies", "programme", "plan_operations", "catalogue"])
def test_projected_tables_are_written_without_an_exchange(spark, tables, tmp_path, name):
    wh = built(spark, tables, tmp_path)
    assert stages_of(spark, lambda: wh.table(name)) == 1
    assert rows(wh.table(name)) == rows(getattr(StandinSources(spark, tables), name))


def test_rows_of_one_partition_value_come_from_several_tasks(spark, tables, tmp_path):
    conf = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "16k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        built(spark, tables, tmp_path).table("account_domiciliations")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # no task holds all rows of the greatest value
    assert len(glob.glob(f"{tmp_path}/root/account_domiciliations/extractiondate=20240130/*.parquet")) > 1


def test_more_partition_values_than_open_files_give_the_same_rows(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse, "OPEN_FILES", 2)
    wh = built(spark, tables, tmp_path)
    for name in ("contracting_events", "customers_daily"):
        assert LAYOUT[name] and rows(wh.table(name)) == rows(getattr(StandinSources(spark, tables), name))


def test_open_files_are_set_for_the_write_only(spark, tables, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    was = spark.conf.get(key, None)
    with warehouse._open_files(spark, 7):
        assert spark.conf.get(key) == "7"
    built(spark, tables, tmp_path).table("person_board")
    assert spark.conf.get(key, None) == was


def test_files_of_sorted_tables_are_sorted(spark, tables, tmp_path):
    built(spark, tables, tmp_path).table("customers_daily")
    files = glob.glob(f"{tmp_path}/root/customers_daily/*/*.parquet")
    assert files
    for f in files:
        days = [d for d in pq.read_table(f, partitioning=None)["fecha_derivado"].to_pylist() if d is not None]
        assert days == sorted(days)


def test_plan_operations_stay_in_the_order_of_their_lines(spark, tables, tmp_path):
    built(spark, tables, tmp_path).table("plan_operations")
    (f,) = glob.glob(f"{tmp_path}/root/plan_operations/*.parquet")
    numbers = pq.read_table(f)["idprig"].to_pylist()
    assert numbers == sorted(numbers, reverse=True) and len(numbers) == 2 * ORDERS


def test_receipts_are_written_by_the_tasks_that_join_them(spark, tables, tmp_path):
    wh, derived = built(spark, tables, tmp_path), StandinSources(spark, tables).receipts
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # no more stages than the joins have
        assert stages_of(spark, lambda: wh.table("receipts")) == stages_of(spark, lambda: derived.write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(wh.table("receipts")) == rows(derived)
    assert "receipts" not in warehouse.SORT_BY


def test_balances_of_both_snapshots_come_from_one_join(spark, tables, tmp_path):
    balances = StandinSources(spark, tables).account_balance
    plan = balances._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1
    key = ["copemk", "copser", "idcoec", "idprig", "fevaig"]
    twice = balances.groupBy(*key).agg(F.count_distinct("snapshot").alias("s"), F.sum("cavt20").alias("sum"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    assert twice.count() > 0 and twice.filter("n <> 2 OR s <> 2 OR sum <> 0").isEmpty()
    assert rows(built(spark, tables, tmp_path).table("account_balance")) == rows(balances)
