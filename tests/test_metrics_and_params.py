"""Run-time warnings of the rules, and the rules' parameters."""

import datetime as dt
import logging

import pytest
from bank import Bank
from pyspark.sql import functions as F

from rumbo.operators.observe import RuleMetrics, watch
from rumbo.plans import drafts, insurance, web_interest
from rumbo.sources import sinks
from rumbo.sources.marks import LoadMarks
from rumbo.sources.standins import AS_OF
from rumbo.sources.warehouse import WarehouseSources, standin_warehouse

SF = "/root/testdata/sf0.01"


def rows(df):
    return sorted(map(str, df.collect()))


def visits(spark, scores_day):
    """One visitor with a fund score over the threshold, both of some day."""
    return Bank(
        spark,
        web_hits=[{"id_cliente": 1, "fe_adobe_extraction_dia": "20240130", "tl_familia": "Fondos de Inversion", "tl_seccion1_pagename": "s",
                   "tl_seccion2_pagename": "t", "tl_proceso_post": "simulacion", "co_canal": "WEB"}],
        person_board=[{"copemk": 1, "cotpmk": 1, "coh004": 62120}],
        model_thresholds=[{"idmode": "FIAPOR1", "iduso": "MEDICION", "nupropenmin": 0.1, "extractiondate": "20240129"}],
        scores_a=[{"idpers": 1, "idmode": "FIAPOR1", "nupropen": 0.5, "extractiondate": scores_day}],
        scores_b=[{"co_cliente": 1, "modelid": "MFOGENU1", "probabilidad": 0.5, "sessionid": "20240129"}])


@pytest.mark.parametrize("day,warned", [("20240129", False), ("20240130", True)])
def test_the_fund_journey_warns_of_scores_of_another_day(spark, tmp_path, caplog, day, warned):
    bank = visits(spark, day)
    with caplog.at_level(logging.WARNING, "rumbo.rules"):
        said = sinks.run_journey(spark, web_interest.fund_interest, bank, AS_OF, str(tmp_path / "out"))
    assert [r.message for r in caplog.records if r.name == "rumbo.rules"] == said
    assert len(said) == int(warned) and all("newest date" in m and "FIAPOR1" in m for m in said)
    got = spark.read.parquet(str(tmp_path / "out")).drop("run_date")
    assert rows(got) == rows(web_interest.fund_interest(bank, AS_OF)) and got.count() == 1       # the result is the same
    assert got.first()["C1"] == int(not warned)


def test_results_are_the_same_with_metrics(spark, tmp_path):
    src = standin_warehouse(spark, SF)
    for plan in (insurance.home_insurance_expiry, web_interest.pension_interest):
        plain = rows(plan(src, AS_OF))
        with RuleMetrics() as m:
            assert rows(plan(src, AS_OF)) == plain != []
            assert m.warnings() == []
            if plan is insurance.home_insurance_expiry:
                assert m.values() == {"insurers": [{"unnamed": 0}]}
    assert "observe" not in web_interest.pension_interest(src, AS_OF)._jdf.queryExecution().analyzed().toString().lower()


def test_unnamed_insurers_and_missing_loads_are_reported(spark, tmp_path):
    src = standin_warehouse(spark, SF).build_all()
    marks = LoadMarks(spark, str(tmp_path / "marks"))
    marks.append(drafts.BOARD, dt.date(2024, 1, 31), "20240131")
    with RuleMetrics() as m:
        drafts.own_policy_expiry(WarehouseSources(spark, src.root, src.schemas, marks), dt.date(2024, 3, 31)).count()
        assert m.warnings() == []
        empty = drafts.young_retention_draft(WarehouseSources(spark, src.root, src.schemas, marks), dt.date(2024, 2, 1))
        assert empty.count() > 0
    assert sum("control table without a row" in x for x in m.warnings()) == 3
    with RuleMetrics() as m:
        df = watch(spark.range(5), "n", lambda got: f"{got['n']} rows", n=F.count(F.lit(1)))
        assert m.warnings() == []                    # nothing has run: nothing to say, and no waiting for it
        df.collect()
        assert m.report() == ["5 rows"]


# ---- parameters ------------------------------------------------------------------

def test_home_insurance_parameters(spark):
    src = standin_warehouse(spark, SF)
    as_written = insurance.home_insurance_expiry(src, AS_OF)
    strict = insurance.home_insurance_expiry(src, AS_OF, strict_home=True)
    home = src.policies.filter("snapshot = 'LATEST' and xcoemp = 0 and ffigco is null and cosiig = 10000 and codsi7 = 1")
    any_policy = {r["copemk"] for r in home.collect()}
    home_policy = {r["copemk"] for r in home.filter("colnng = 5").collect()}
    for df, held in ((as_written, any_policy), (strict, home_policy)):
        got = {r["PERSONA"]: r["SEGURO_HOGAR_CONTRATADO"] for r in df.collect()}
        assert got == {p: int(p in held) for p in got} and set(got.values()) == {0, 1}
    nobody = insurance.home_insurance_expiry(src, AS_OF, exclusion_insurers=())
    everybody = insurance.home_insurance_expiry(src, AS_OF, exclusion_insurers=tuple(
        r["COMPANIA"] for r in insurance.insurance.expiring_receipts(src.receipts, AS_OF).select("COMPANIA").distinct().collect()))
    assert everybody.count() < nobody.count() and as_written.count() <= nobody.count()
    assert not {r["PERSONA"] for r in everybody.collect()} & home_policy
    labels = insurance.insurance.expiring_receipts(src.receipts, AS_OF, home_label="HOGAR").select("RAMO").distinct()
    assert {r["RAMO"] for r in labels.collect()} == {None, "HOGAR"}
    assert rows(insurance.home_insurance_expiry(src, AS_OF, home_label="HOGAR")) == rows(as_written)


def test_draft_product_codes(spark):
    src, as_of = standin_warehouse(spark, SF), dt.date(2024, 2, 1)
    flags = ["TENENCIA_CUENTA_FACIL", "TENENCIA_CUENTA_ON", "NOMINA_DOMICILIADA", "CONTRATACION_CUENTA_ON"]
    total = lambda df: {f: df.agg(F.sum(f)).first()[0] for f in flags}
    plain = total(drafts.young_retention_draft(src, as_of))
    turned = total(drafts.young_retention_draft(src, as_of, products=("11229", "10600", "11594")))
    assert all(v for v in plain.values()) and [turned[f] for f in flags] == [plain[f] for f in (flags[2], flags[0], flags[1], flags[3])]
    other = total(drafts.young_retention_draft(src, as_of, contracting_product="11660"))
    assert other["CONTRATACION_CUENTA_ON"] != plain["CONTRATACION_CUENTA_ON"]
