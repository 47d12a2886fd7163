"""Bucketed customer tables: the same rows, and no Exchange between their scans and the joins by customer."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from rumbo.plans import drafts, overdraft
from rumbo.plans.registered import OWN_EXPIRY_AS_OF
from rumbo.sources.bucketed import CUSTOMER_KEY, bucket_count, is_bucketed, write_bucketed
from rumbo.sources.standins import AS_OF
from rumbo.sources.warehouse import LAYOUT, standin_warehouse

SF = "/root/testdata/sf0.01"
TABLES = ("contracts", "person_board", "customer_attrs", "loans", "cards", "payroll_amounts", "scores_a", "scores_b", "monthly_board")


@pytest.fixture(scope="module")
def src(spark):
    return standin_warehouse(spark, SF)


@pytest.fixture(scope="module")
def bucketed(spark, src):
    return write_bucketed(src, "bucketed_test", 8, TABLES, LAYOUT, location=tempfile.mkdtemp(prefix="rumbo-buckets-"))


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold") if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def path_to_join(plan: str) -> list[tuple[str, list[str]]]:
    """(table, nodes from its scan up to the first join) of every scan in a plan's tree."""
    out, above = [], []
    for line in plan.splitlines():
        m = re.match(r"^([\s:|+\-]*)(?:\*\(\d+\)\s*)?(\w+)", line)
        if not m:
            continue
        depth, name = len(m.group(1)), m.group(2)
        above = [(d, n) for d, n in above if d < depth] + [(depth, name)]
        if name == "FileScan":
            nodes = []
            for _, n in reversed(above[:-1]):
                nodes.append(n)
                if "Join" in n:
                    break
            table = re.search(r"FileScan parquet (?:[\w]+\.)*([\w]+)\[", line)
            out.append((table.group(1) if table else "?", nodes, "Bucketed: true" in line))
    return out


def test_every_table_has_the_same_rows(spark, src, bucketed):
    for name in TABLES:
        a, b = src.table(name), bucketed.table(name)
        assert is_bucketed(spark, bucketed.tables[name]), name
        assert a.count() == b.count() and a.select(*b.columns).exceptAll(b).count() == 0, name
        assert set(CUSTOMER_KEY) >= set(TABLES)


@pytest.mark.parametrize("plan,as_of,tables", [
    (overdraft.overdraft_journey, AS_OF, {"loans", "cards", "scores_a", "scores_b"}),
    (drafts.home_insurance_draft, OWN_EXPIRY_AS_OF, {"customer_attrs", "payroll_amounts", "monthly_board"})])
def test_enrichments_do_not_shuffle_the_tables(spark, src, bucketed, no_broadcast, plan, as_of, tables):
    df = plan(bucketed, as_of)
    tree = df._jdf.queryExecution().executedPlan().toString()
    found = [(t, nodes) for t, nodes, in_buckets in path_to_join(tree) if t in tables and in_buckets]
    assert {t for t, _ in found} == tables
    assert all("Exchange" not in nodes and "Join" in nodes[-1] for _, nodes in found), found
    # the same plan on plain tables shuffles each of them
    plain = path_to_join(plan(src, as_of)._jdf.queryExecution().executedPlan().toString())
    assert sum("Exchange" in nodes for _, nodes, _ in plain) >= len(tables)
    a, b = plan(src, as_of), df
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_a_hot_customer_keeps_a_table_out_of_buckets(spark):
    class One:
        loans = spark.range(0, 30_000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("copemk"),
                                              F.col("id").alias("x"), F.lit("LATEST").alias("snapshot"))
        cards = spark.range(0, 1000).select(F.col("id").alias("copemk"), F.lit("LATEST").alias("snapshot"))

    out = write_bucketed(One(), "bucketed_hot", 4, ("loans", "cards"), {"loans": ["snapshot"], "cards": ["snapshot"]},
                         location=tempfile.mkdtemp(prefix="rumbo-buckets-"), heavy_rows=5000)
    assert not is_bucketed(spark, out.tables["loans"]) and is_bucketed(spark, out.tables["cards"])
    assert out.loans.count() == 30_000 and out.cards.count() == 1000
    again = write_bucketed(One(), "bucketed_hot", 4, ("cards",), location=None)
    assert again.cards.count() == 1000


def test_bucket_count_is_a_power_of_two(spark):
    assert [bucket_count(spark.range(n), rows_per_bucket=100) for n in (0, 100, 101, 250, 900, 1700)] == [1, 1, 2, 4, 16, 32]
