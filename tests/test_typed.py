"""Typed source contract: casts, quarantine, and plans that keep their push-down."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rumbo.operators import accounts
from rumbo.plans import core, overdraft
from rumbo.sources.standins import AS_OF
from rumbo.sources.typed import AMOUNT_DIGITS, TypedSources, declared
from rumbo.sources.untyped import UntypedStandins
from rumbo.sources.warehouse import LAYOUT, standin_warehouse

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def src(spark):
    return standin_warehouse(spark, SF)


class Tables:
    def __init__(self, **tables):
        self.__dict__.update(tables)


def formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_declared_types_are_those_of_the_stand_ins(src):
    """Every column of every table; amounts are the only ones that come in another type (double)."""
    for name in LAYOUT:
        for f in src.table(name).schema.fields:
            if f.name in ("row_order", "row_part", "row_price", "hit_ts", "hit_id"):       # not read by any rule
                continue
            kind = declared(name, f.name)
            if isinstance(kind, T.DecimalType):
                assert f.dataType == T.DoubleType() and (kind.precision, kind.scale) == (AMOUNT_DIGITS, 2), (name, f.name)
            else:
                assert f.dataType == kind, (name, f.name)


def test_values_are_cast_or_quarantined(spark):
    rows = [(" 0011239 ", "20240131", " 12.50", "5", "2024-01-31"), ("S/N", "x", "1", "5", "2024-01-31"), ("20100", "x", "1.234", "5", "2024-01-31"),
            ("20100", "x", "N/D", " ", "2024-02-30"), ("", None, None, "7", " "), (None, None, None, "7", None)]
    base = Tables(loans=spark.createDataFrame(rows, "copser string, extractiondate string, imlppm string, copemk string, feclpp string"))
    src = TypedSources(base)
    good = src.loans.collect()
    assert [tuple(r) for r in good] == [(11239, "20240131", Decimal("12.50"), 5, dt.date(2024, 1, 31)), (20100, "x", Decimal("1.23"), 5, dt.date(2024, 1, 31))]
    bad = {json.loads(r["row"]).get("copser"): [tuple(f) for f in r["faults"]] for r in src.quarantine("loans").collect()}
    assert bad == {"S/N": [("copser", "type", "S/N")], "20100": [("imlppm", "type", "N/D"), ("copemk", "missing", " "), ("feclpp", "type", "2024-02-30")],
                   "": [("copser", "missing", "")], None: [("copser", "missing", None)]}
    assert len(good) + src.quarantine("loans").count() == len(rows)


def test_amounts_that_would_be_rounded_are_quarantined(spark):
    base = Tables(cards=spark.createDataFrame([(1, 12.34), (2, 12.345), (3, 0.1 + 0.2), (4, 1e17), (5, None)], "copemk long, cacv0d double"))
    src = TypedSources(base)
    assert {r["copemk"]: r["cacv0d"] for r in src.cards.collect()} == {1: Decimal("12.34"), 3: Decimal("0.30"), 5: None}
    assert {json.loads(r["row"])["copemk"]: r["faults"][0]["reason"] for r in src.quarantine("cards").collect()} == {2: "precision", 4: "type"}
    assert TypedSources(base, decimals=3).cards.filter("copemk = 2").first()["cacv0d"] == Decimal("12.345")
    assert TypedSources(base, needed={"cards": ["cacv0d"]}).quarantine("cards").count() == 3


def test_a_typed_table_keeps_its_push_down(src):
    typed = TypedSources(src, decimals=4)
    p = formatted(accounts.overdrawn_accounts(typed.account_balance, AS_OF))
    assert "PartitionFilters: [isnotnull(snapshot" in p and "= 20240130)" in p and "IsNull(ffigco)" in p and "EqualTo(xcoemp,0)" in p
    assert "cast(copser" not in p


def test_every_row_of_the_untyped_extract_is_accounted_for(src):
    raw = UntypedStandins(src)
    typed = TypedSources(raw, decimals=4)
    for name in ("contracts", "account_balance", "plan_operations"):
        n, kept, out = getattr(raw, name).count(), typed.table(name).count(), typed.quarantine(name).count()
        assert n == kept + out and kept > 0 and out > 0, name
        good = src.table(name)
        same = typed.table(name).select("idprig", "copser").exceptAll(good.select("idprig", "copser"))
        assert same.count() == 0, name
    assert typed.newest("account_balance", "extractiondate", "20240131") == "20240130"      # the base's metadata


def test_journeys_run_on_typed_sources(src):
    typed = TypedSources(src, decimals=5)
    for plan in (overdraft.overdraft_journey, overdraft.overdraft_master, core.customer_core):
        a, b = plan(src, AS_OF), plan(typed, AS_OF)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) != []


def test_the_quarantine_is_written_once_per_run(spark, src, tmp_path):
    typed = TypedSources(UntypedStandins(src), decimals=4)
    for _ in range(2):
        typed.write_quarantine(["contracts", "plan_operations"], str(tmp_path / "q"), AS_OF)
    rows = spark.read.parquet(str(tmp_path / "q"))
    assert rows.count() == typed.quarantine("contracts").count() + typed.quarantine("plan_operations").count()
    assert rows.filter(F.col("run_date") == AS_OF).count() == rows.count()
