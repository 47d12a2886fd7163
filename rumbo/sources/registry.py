"""The bank's warehouse tables, by the logical names the journeys use.

``CatalogSources(spark)`` reads them through the session catalog
(``spark.table``), lower-casing column names, so the journeys run unchanged
on the production warehouse.  Partition columns (``snapshot``,
``extractiondate``, ``dt`` …) stay ordinary columns: the filters the journeys
place on them become partition filters in the catalog scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .newest import NewestValues, Partition, catalog_partitions

# FIXED VALUES: warehouse table of each logical table.
WAREHOUSE_TABLES = {
    "account_balance": "STANDARD.IGV0_CP_AHCA_D",
    "contracts": "STANDARD.IGV0_CONTRATO_P",
    "holder_codes": "STANDARD.RELTIT",
    "fund_contracts": "STANDARD.IGV0_FOND_INV_D",
    "plan_contracts": "STANDARD.IGV0_PLP_D",
    "plan_operations": "STANDARD.IGV0_PLP_OP_D",
    "payroll_contracts": "STANDARD.IGV0_NOM_CONTCOM_D",
    "payroll_amounts": "STANDARD.IGV0_NOM_CONTCOM",
    "loans": "STANDARD.IGV0_LPRESPRE_D",
    "cards": "STANDARD.IGV0_TARJETA_D",
    "person_board": "STANDARD.MKTBBLON",
    "customer_attrs": "STANDARD.MKTBBLOF",
    "value_managers": "STANDARD.MKSERMVL",
    "managers": "STANDARD.MKGESTOR",
    "manager_contacts": "STANDARD.MKGESCOM",
    "programme": "STANDARD.MKBKSINH",
    "catalogue": "STANDARD.MKCPMCDE",
    "dictionary_attrs": "STANDARD.IGQ_DATO",
    "dictionary_values": "STANDARD.IGQ_VALOR",
    "scores_a": "STANDARD.CRPROPEN",
    "model_thresholds": "STANDARD.MODELOPROPENMIN",
    "receipts": "STANDARD.IGV0_SCP_ADESEPA_D",
    "policies": "STANDARD.IGV0_SEG_POLIZAS",
    "account_domiciliations": "STANDARD.IGV0_CP_AHCAD_DOM",
    "monthly_accounts": "STANDARD.IGV0_CP_AHCAD_M",
    "customers_daily": "DERIVATIVES_GENERIC.BGDV_DMCLIENTES_D",
    "web_hits": "DERIVATIVES_GENERIC.BGTMD_ANALITICAWEB_D",
    "monthly_board": "DERIVATIVES_TABCLI.BGTTB_TABLON_CLIENTES_MES_TT",
    "contracting_events": "DERIVATIVES_EVBATCH.BGTMD_PB150_INICIOCONTRATACIONPRODUCTO_D",
    "scores_b": "DERIVATIVES_MODELS_IN.BGMD_IN_MATRIZ_PROPENSIONES",
}


class CatalogSources(NewestValues):
    """Warehouse tables through the session catalog (``database.table``)."""

    def __init__(self, spark: SparkSession, tables: dict[str, str] | None = None):
        self.spark, self.tables = spark, {**WAREHOUSE_TABLES, **(tables or {})}
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self.spark.table(self.tables[name])
            self._cache[name] = df.toDF(*[c.lower() for c in df.columns])
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.tables:
            raise AttributeError(name)
        return self.table(name)

    def partitions(self, name: str, equal=None) -> list[Partition] | None:
        """As the metastore lists them (``SHOW PARTITIONS``); None for a view or a table without partitions."""
        return catalog_partitions(self.spark, self.tables[name], self.table(name).schema, equal)
