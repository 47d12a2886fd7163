"""The incremental contract load equals the batch load over the same files."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from rumbo.plans import core
from rumbo.sources.standins import AS_OF
from rumbo.sources.warehouse import standin_warehouse
from rumbo.streaming.daily_contracts import start_contract_load


def test_stream_matches_batch(spark):
    src = standin_warehouse(spark, "/root/testdata/sf0.001")
    since = dt.date(2023, 10, 31)
    contracts = src.contracts
    root = tempfile.mkdtemp(prefix="rumbo-stream-")
    incoming, sink, ckpt = (os.path.join(root, d) for d in ("in", "out", "ckpt"))
    cut = F.col("fiigco") < F.lit(dt.date(2023, 12, 15))
    contracts.filter(cut).write.parquet(f"{incoming}/part1")
    q = start_contract_load(spark, f"{incoming}/*", src, AS_OF, since, sink, ckpt, schema=contracts.schema)
    q.awaitTermination()
    contracts.filter(~cut).write.parquet(f"{incoming}/part2")
    q = start_contract_load(spark, f"{incoming}/*", src, AS_OF, since, sink, ckpt, schema=contracts.schema)
    q.awaitTermination()
    got = spark.read.parquet(f"{sink}/*")
    want = core.contract_core(src, AS_OF, since)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_registry_covers_every_table():
    from rumbo.sources.registry import WAREHOUSE_TABLES
    from rumbo.sources.warehouse import LAYOUT
    assert set(WAREHOUSE_TABLES) == set(LAYOUT)
    assert len(set(WAREHOUSE_TABLES.values())) == len(WAREHOUSE_TABLES)


def test_cli_writes_run_partition(spark):
    from rumbo import cli
    out = tempfile.mkdtemp(prefix="rumbo-cli-")
    cli.main(["overdraft_master", "--as-of", AS_OF.isoformat(), "--source", "standin:/root/testdata/sf0.001",
              "--out", out])
    cli.main(["overdraft_master", "--as-of", AS_OF.isoformat(), "--source", "standin:/root/testdata/sf0.001",
              "--out", out])                                  # re-run replaces the partition
    got = spark.read.parquet(out)
    want = cli.JOURNEYS["overdraft_master"](standin_warehouse(spark, "/root/testdata/sf0.001"), AS_OF)
    assert got.filter(F.col("run_date") == AS_OF).count() == want.count()


def test_catalog_sources_match_warehouse(spark):
    from rumbo.plans import overdraft
    from rumbo.sources.registry import WAREHOUSE_TABLES, CatalogSources
    wh = standin_warehouse(spark, "/root/testdata/sf0.001")
    names = {}
    for logical in WAREHOUSE_TABLES:
        view = f"wh_{logical}"
        df = getattr(wh, logical)
        df.toDF(*[c.upper() for c in df.columns]).createOrReplaceTempView(view)   # catalog casing differs
        names[logical] = view
    cat = CatalogSources(spark, tables=names)
    a = overdraft.overdraft_master(cat, AS_OF)
    b = overdraft.overdraft_master(wh, AS_OF)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_warehouse_matches_live_derivation(spark):
    from rumbo.plans import core, overdraft
    from rumbo.sources.standins import StandinSources
    sf = "/root/testdata/sf0.001"
    wh, live = standin_warehouse(spark, sf), StandinSources(spark, sf)
    for plan in (core.customer_core, overdraft.overdraft_master):
        a, b = plan(wh, AS_OF), plan(live, AS_OF)
        # names and types agree (Parquet reads every column back as nullable)
        assert [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema], plan.__name__
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, plan.__name__


def test_modes_give_the_same_results(spark, monkeypatch):
    from rumbo.operators import control, reuse
    from rumbo.plans import overdraft, youth
    wh = standin_warehouse(spark, "/root/testdata/sf0.01")

    def rows(plan):
        return sorted(tuple(str(v) for v in r) for r in plan(wh, AS_OF).collect())

    base = {p.__name__: rows(p) for p in (overdraft.overdraft_journey, youth.young_retention)}
    monkeypatch.setattr(control, "NEWEST_MODE", "literal")
    monkeypatch.setattr(reuse, "REUSE_MODE", "off")
    for p in (overdraft.overdraft_journey, youth.young_retention):
        assert rows(p) == base[p.__name__] and len(base[p.__name__]) > 0
