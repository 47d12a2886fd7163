"""Newest values from metadata: equal to the aggregates, and the plans open no data file for them."""

import datetime as dt
import re
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rumbo import params as P
from rumbo.operators import control, people, scoring
from rumbo.plans import core, drafts, overdraft
from rumbo.plans.registered import REGISTRY
from rumbo.sources import newest as N
from rumbo.sources.registry import WAREHOUSE_TABLES, CatalogSources
from rumbo.sources.standins import AS_OF
from rumbo.sources.warehouse import WarehouseSources, standin_warehouse

from bank import Bank

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def src(spark):
    return standin_warehouse(spark, SF)


def formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def scans(df, table: str) -> list[str]:
    """The scan entries of a table in the formatted plan."""
    return [part for part in re.split(r"\n\n(?=\(\d+\) )", formatted(df)) if f"/{table}]" in part and "Scan parquet" in part]


ASKED = [("customers_daily", "dt", 202401, {}), ("customers_daily", "dt", 202312, {}), ("monthly_board", "process_date", "20240130", {}),
         ("model_thresholds", "extractiondate", "20240131", {"snapshot": "LATEST"}), ("model_thresholds", "extractiondate", "20240115", {}),
         ("web_hits", "fe_adobe_extraction_dia", "20240120", {}), ("contracting_events", "dt", "20240131", {}),
         ("account_balance", "extractiondate", "20240131", {"snapshot": "HISTORIC"}), ("account_balance", "fevaig", AS_OF, {}),
         ("account_balance", "fevaig", dt.date(2024, 1, 9), {"snapshot": "HISTORIC"}), ("customers_daily", "fecha_derivado", AS_OF, {}),
         ("customers_daily", "fecha_derivado", dt.date(2021, 3, 1), {}), ("customers_daily", "fecha_derivado", dt.date(1980, 1, 1), {}),
         ("account_balance", "fevaig", dt.date(2090, 1, 1), {})]


@pytest.mark.parametrize("table,column,at_most,equal", ASKED)
def test_newest_equals_the_aggregate(src, table, column, at_most, equal):
    rows = src.table(table).filter(F.col(column) <= F.lit(at_most))
    for c, v in equal.items():
        rows = rows.filter(F.col(c) == v)
    want = rows.agg(F.max(column)).first()[0]
    assert src.newest(table, column, at_most, equal) == want
    one = src.spark.range(1).select(control.newest_of(src, table, column, at_most, equal).alias("v"))
    assert one.first()["v"] == want and one.schema["v"].dataType == src.table(table).schema[column].dataType


def test_partition_values_open_no_file(spark, tmp_path):
    """The answer comes from folder names: the files hold no Parquet at all."""
    root = tmp_path / "wh"
    for snapshot, days in (("LATEST", ["20240130"]), ("HISTORIC", ["20240101", "20240129", "20240131", "20240215"])):
        for day in days:
            folder = root / "account_balance" / f"snapshot={snapshot}" / f"extractiondate={day}"
            folder.mkdir(parents=True)
            (folder / "part-0.parquet").write_bytes(b"not a parquet file")
    (root / "account_balance" / "snapshot=HISTORIC" / "extractiondate=20240131" / "part-0.parquet").write_bytes(b"")   # empty
    (root / "account_balance" / "snapshot=HISTORIC" / "extractiondate=20240131" / "_SUCCESS").write_bytes(b"x")        # no data file
    (root / "account_balance" / "snapshot=HISTORIC" / "extractiondate=__HIVE_DEFAULT_PARTITION__").mkdir()
    schema = standin_warehouse(spark, SF).account_balance.schema
    src = WarehouseSources(spark, str(root), {"account_balance": schema})
    assert src.newest("account_balance", "extractiondate", "20240201", {"snapshot": "HISTORIC"}) == "20240129"
    assert src.newest("account_balance", "extractiondate", None, {"snapshot": "HISTORIC"}) == "20240215"
    assert src.newest("account_balance", "extractiondate", "20240130") == "20240130"
    assert src.newest("account_balance", "extractiondate", "20230101") is None


def test_values_are_unescaped_and_typed(spark, tmp_path):
    rows = [(1, "a b/c=d", 7), (2, None, 7), (3, "z%", 12)]
    spark.createDataFrame(rows, "x int, p string, q int").write.partitionBy("q", "p").parquet(str(tmp_path / "t"))
    schema = spark.createDataFrame([], "x int, p string, q int").schema
    found = N.folder_partitions(spark, str(tmp_path / "t"), schema)
    assert {(p["q"], p["p"]) for p in found} == {(7, "a b/c=d"), (12, "z%")}
    assert [p["p"] for p in N.folder_partitions(spark, str(tmp_path / "t"), schema, {"q": 12})] == ["z%"]


def test_catalog_partitions(spark, src):
    spark.sql("CREATE DATABASE IF NOT EXISTS newest_db")
    spark.sql("DROP TABLE IF EXISTS newest_db.thresholds")
    src.model_thresholds.toDF(*[c.upper() for c in src.model_thresholds.columns]).write.partitionBy(
        "SNAPSHOT", "EXTRACTIONDATE").option("path", tempfile.mkdtemp(prefix="rumbo-cat-")).saveAsTable("newest_db.thresholds")
    src.model_thresholds.createOrReplaceTempView("thresholds_view")
    cat = CatalogSources(spark, {"model_thresholds": "newest_db.thresholds"})
    ask = ("model_thresholds", "extractiondate", "20240120", {"snapshot": "LATEST"})
    assert cat.newest(*ask) == src.newest(*ask)
    view = CatalogSources(spark, {"model_thresholds": "thresholds_view"})
    assert view.partitions("model_thresholds") is None and view.newest(*ask) is N.UNKNOWN
    # a view falls back to the aggregate and gives the same rows
    a, b = (scoring.propensity_b(src.scores_b, s.model_thresholds, ["MCOCLFX1"], "ID", "F", scoring.newest_threshold_date(s, AS_OF))
            for s in (cat, view))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) != []


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5000)), st.one_of(st.none(), st.integers(0, 5000)), st.booleans()), max_size=12),
       st.integers(0, 6000), st.booleans())
def test_bands_equal_the_maximum(spark, rows, until, bounded):
    day = lambda n: None if n is None else dt.date(2010, 1, 1) + dt.timedelta(days=n)
    key = lambda d: d and d.strftime("%Y%m%d")
    df = spark.createDataFrame([(day(a), key(day(b)), k) for a, b, k in rows], "a date, b string, k boolean")
    u = day(until)
    got = N.newest_in_bands(df, {"a": None, "b": "%Y%m%d"}, u, u if bounded else None, F.col("k"))
    # as the aggregate has it: both columns bounded, a row without either does not count
    held = [(day(a), key(day(b))) for a, b, k in rows if k and (not bounded or (a is not None and b is not None and a <= until and b <= until))]
    most = lambda vs: max((v for v in vs if v is not None), default=None)
    assert got == [most(a for a, _ in held), most(b for _, b in held)]


def test_a_band_reads_the_newest_row_groups_only(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 1).select(F.expr("date_add(date'2000-01-01', cast(id / 40 as int))").alias("d"), F.col("id").alias("x"))
    rows.write.option("parquet.block.size", 64 * 1024).parquet(str(tmp_path / "sorted"))
    df = spark.read.parquet(str(tmp_path / "sorted"))
    last = df.agg(F.max("d")).first()[0]
    b = N.band(df, {"d": None}, last - dt.timedelta(days=1), last)
    assert b.agg(F.max("d")).first()[0] == last
    found = b.select("d")
    found.collect()
    node = found._jdf.queryExecution().executedPlan()
    read = []

    def walk(n):
        if "FileSourceScan" in n.getClass().getSimpleName():
            read.append(n.metrics().apply("numOutputRows").value())
        if "AdaptiveSparkPlan" in n.getClass().getSimpleName():
            walk(n.executedPlan())
        for i in range(n.children().size()):
            walk(n.children().apply(i))

    walk(node)
    assert read and read[0] < 20_000


def test_any_start_finds_the_newest_time(spark):
    from rumbo.plans.registered import ORDERS_AS_OF
    from rumbo.sources.testdata import TestTables
    o = TestTables(spark, SF).orders
    want = o.agg(F.max("o_orderdate")).first()[0]
    for start in (ORDERS_AS_OF, dt.date(1990, 1, 1), dt.date(2004, 5, 6)):
        assert N.newest_in_bands(o, {"o_orderdate": None}, start) == [want]
    assert N.newest_in_bands(o.filter("o_orderkey < 0"), {"o_orderdate": None}, ORDERS_AS_OF) == [None]
    newest = REGISTRY["newest_partition"](spark, SF)
    assert formatted(newest).count("Scan parquet") == 2 and "Subquery" not in formatted(newest)     # the tree and its entry: one scan
    assert newest.count() == o.filter(F.col("o_orderdate") == F.lit(want)).count()


def test_newest_under_a_condition_reads_partitions_newest_first(spark):
    rows = [(p, v, k) for p, v, k in [("p1", 10, True), ("p1", 3, True), ("p2", 30, False), ("p2", 9, True), ("p3", 20, False), ("p4", 5, True)]]
    df = spark.createDataFrame(rows, "p string, v int, k boolean")
    bounds = [(N.Partition((("p", p),)), hi) for p, hi in (("p1", 10), ("p2", 30), ("p3", 20), ("p4", 5), ("p5", None))]
    assert N.newest_under(df, "v", bounds, F.col("k")) == 10
    assert N.newest_under(df, "v", bounds, F.col("k"), at_most=9) == 9
    assert N.newest_under(df, "v", bounds, F.lit(False)) is None


# ---- plans ---------------------------------------------------------------------

def test_customer_core_reads_its_table_once_with_a_literal_partition(src):
    df = core.customer_core(src, AS_OF)
    (scan,) = scans(df, "customers_daily")
    assert re.search(r"PartitionFilters: \[.*= 202401\)", scan) and "Subquery" not in formatted(df)


def test_control_tables_read_nothing(src):
    labels = list(drafts.CONTROL_SOURCES)
    ctl = drafts.control_dates(src, labels, AS_OF)
    assert "Scan parquet" not in formatted(ctl)
    want = {label: getattr(src, t).filter(F.col(c) <= AS_OF.strftime("%Y%m%d")).agg(F.max(c)).first()[0]
            for label, (t, c) in drafts.CONTROL_SOURCES.items()}
    assert {r["C1"]: r["C2"] for r in ctl.collect()} == want


def test_thresholds_are_read_once_with_a_literal_date(src):
    df = scoring.propensity_b(src.scores_b, src.model_thresholds, [P.OVERDRAFT_MODEL_SCORES_B], "ID", "F",
                              scoring.newest_threshold_date(src, AS_OF))
    assert len(scans(df, "model_thresholds")) == 1 and len(scans(df, "scores_b")) == 1
    assert all("= 20240130)" in s for s in scans(df, "model_thresholds") + scans(df, "scores_b"))


@pytest.mark.parametrize("key,table", [("product_family_flags", "account_balance"), ("latest_date_semi", "programme"),
                                       ("web_interest_trigger", "web_hits"), ("propensity_multi_model", "model_thresholds")])
def test_queries_scan_the_dated_table_once(spark, src, key, table):
    df = REGISTRY[key](spark, SF)
    assert len(scans(df, table)) == 1 and "Subquery" not in formatted(df)


def test_newest_balance_day_reads_one_day_of_history(src):
    """The day comes from a band; the query's own scan is bounded to it."""
    df = people.youth_accounts(src, AS_OF)
    (scan,) = scans(df, "account_balance")
    assert "EqualTo(fevaig,2024-01-30)" in scan


# ---- sources without metadata give the same rows -----------------------------------

def test_frames_without_metadata_agree(spark, src):
    class Plain:
        """The same tables, nothing known about them."""
        def __getattr__(self, name):
            if name in ("newest", "newest_where") or name.startswith("_"):
                raise AttributeError(name)
            return src.table(name)

    for plan in (overdraft.overdraft_journey, core.customer_core):
        a, b = plan(src, AS_OF), plan(Plain(), AS_OF)
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    a, b = people.programme_rows(src, AS_OF, True), people.programme_rows(Plain(), AS_OF, True)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) != []


def test_hand_built_bank_uses_the_aggregate(spark):
    bank = Bank(spark, web_hits=[{"id_cliente": 1, "fe_adobe_extraction_dia": d} for d in ("20240110", "20240112", "20240301")])
    assert spark.range(1).select(scoring.web_day(bank, AS_OF).alias("d")).first()["d"] == "20240112"


def test_answers_are_kept(src, monkeypatch):
    src.newest("web_hits", "dt", "202401")
    monkeypatch.setattr(src, "partitions", lambda *a: pytest.fail("asked again"), raising=False)
    assert src.newest("web_hits", "dt", "202401") == "202401"
    assert set(WAREHOUSE_TABLES) >= {"web_hits"}
