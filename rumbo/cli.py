"""Run one journey for a run date and write its ``run_date`` partition.

    python -m rumbo.cli overdraft_journey --as-of 2024-01-31 --out /warehouse/journeys/overdraft \\
        [--source catalog | --source warehouse:/path | --source standin:/root/testdata/sf0.1]
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import SparkSession

from .plans import core, drafts, insurance, overdraft, web_interest, youth
from .session import ensure_checkpoint_dir, tune_session
from .sources.registry import CatalogSources
from .sources.sinks import run_journey
from .sources.warehouse import WarehouseSources, standin_warehouse

JOURNEYS = {
    "customer_core": core.customer_core,
    "contract_initial_load": core.contract_initial_load,
    "contract_daily_load": core.contract_daily_load,
    "overdraft_master": overdraft.overdraft_master,
    "overdraft_journey": overdraft.overdraft_journey,
    "fund_interest": web_interest.fund_interest,
    "pension_interest": web_interest.pension_interest,
    "young_retention": youth.young_retention,
    "home_insurance_expiry": insurance.home_insurance_expiry,
    "young_retention_draft": drafts.young_retention_draft,
    "home_insurance_draft": drafts.home_insurance_draft,
}


def open_sources(spark: SparkSession, spec: str):
    if spec == "catalog":
        return CatalogSources(spark)
    kind, _, path = spec.partition(":")
    if kind == "warehouse":
        return WarehouseSources(spark, path)
    if kind == "standin":
        return standin_warehouse(spark, path)
    raise ValueError(f"unknown source {spec!r}")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="rumbo")
    ap.add_argument("journey", choices=sorted(JOURNEYS))
    ap.add_argument("--as-of", required=True, type=_dt.date.fromisoformat)
    ap.add_argument("--source", default="catalog")
    ap.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    spark = tune_session(SparkSession.builder.appName(f"rumbo-{args.journey}").getOrCreate())
    ensure_checkpoint_dir(spark)
    run_journey(spark, JOURNEYS[args.journey], open_sources(spark, args.source), args.as_of, args.out)


if __name__ == "__main__":
    main()
