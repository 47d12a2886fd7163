"""Banking source tables derived from the driver's TPC-H-like test tables.

The journeys read the bank's warehouse tables (see ``registry.py``).  The test
data has none of them, so this adapter derives each one, with Spark, from the
given tables; their work therefore grows with the test data.  Every rule below
is a stand-in choice documented in the README; the journeys themselves only
see the banking column names.

Timeline: order dates are moved by ``ORDER_SHIFT_DAYS`` so that the newest
order day equals the newest event day (2024-01-30); one run date
``AS_OF = 2024-01-31`` then serves every journey ("yesterday" is the newest
balance day).
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import code_label, date_key
from .testdata import DEFAULT_SF_DIR, TestTables

AS_OF = _dt.date(2024, 1, 31)
ORDER_SHIFT_DAYS = 8217            # 2001-08-01 (newest order) -> 2024-01-30

# Stand-in rule tables (test-data categories -> bank codes).
SEGMENT_PRODUCT = {"BUILDING": 11239, "AUTOMOBILE": 11594, "MACHINERY": 10300,
                   "HOUSEHOLD": 10600, "FURNITURE": 20100}
# Product of the second account that every third customer has.
SECOND_PRODUCT = {"BUILDING": 11594, "AUTOMOBILE": 10300, "MACHINERY": 11239, "HOUSEHOLD": 10300, "FURNITURE": 11594}
CUSTOMERS_PER_USER = 10            # an event user stands for so many customers
SECOND_ACCOUNT = 500_000_000       # added to the customer's number for the second account's number
# Days on which periodic extractions fall: one of them, and the days between two.
QUARTER_DAY, QUARTER, YEAR = _dt.date(2024, 1, 30), 91, 364
RECEIPT_DAY, RECEIPT_CYCLE = _dt.date(2023, 3, 31), 56
EXPIRY_DAY, EXPIRY_CYCLE = _dt.date(2024, 3, 27), 30
THRESHOLD_FACTOR = 1.0             # a model's threshold, in daily averages
MODEL_A = {"view": "FIAPOR1", "click": "TNFIASE01", "signup": "APORTPP01",
           "purchase": "PCONSLPP02", "error": "PPEN01"}
MODEL_B = {"view": "MFOGENU1", "click": "MPDPENU1", "signup": "MCOCLFX1",
           "purchase": "MSGHCHX1", "error": "MSGHSHX1"}
# Brand#n -> creditor tax id of its receipts (n = 1..25).
BRAND_TAX_IDS = (
    "A28141935", "A28013050", "A30014831", "A58771247", "A86007572", "A28061083",
    "A85372597", "A08171605", "V46055810", "A87987822", "G28202802", "A58201740",
    "G28177657", "A58452905", "A79409058", "A15003619", "G28031466", "A41003864",
    "A15009244", "A78804390", "A08185589", "A64194590", "A08371908", "A85669604",
    "A58333261",
)
RECEIPT_TEXT_BY_TYPE = {"STANDARD": "SEGURO HOGAR ", "ECONOMY": "MULTIRRIESGO, ",
                        "PROMO": "SEGURO AUTO ", "LARGE": "VIVIENDA ", "MEDIUM": "hogar "}
RECEIPT_TEXT_DEFAULT = "VIDA "


def _shift(c: str) -> Column:
    return F.date_add(F.to_date(F.col(c)), ORDER_SHIFT_DAYS)


def _pad(c: str | Column, n: int = 12) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lpad(c.cast("string"), n, "0")


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def _priority_digit() -> Column:
    return F.substring("o_orderpriority", 1, 1)


def _cycle(day: Column, anchor: _dt.date, days: int) -> Column:
    """The first day not before ``day`` of those that lie whole multiples of ``days`` from ``anchor``."""
    back = F.floor(F.datediff(F.lit(anchor), day) / float(days)) * days
    return F.date_sub(F.lit(anchor), back.cast("int"))


def _rest(key: str, n: int, r: int) -> Column:
    """Whether a number leaves remainder ``r`` modulo ``n``."""
    return F.col(key) % n == r


def _entity(key: str) -> Column:
    """Another entity than the bank for a few numbers."""
    return F.when(_rest(key, 11, 8), 1).otherwise(0)


def _office(key: str) -> Column:
    return F.when(_rest(key, 2, 1), "0002").otherwise("0001")


def _status(key: str) -> Column:
    return F.when(_rest(key, 7, 6), 20000).otherwise(10000)


def _customer() -> Column:
    """The customer behind an event: one of those that its user stands for."""
    return F.col("user_id") * CUSTOMERS_PER_USER + F.col("event_id") % CUSTOMERS_PER_USER


def _snapshot(key: str) -> Column:
    """A few rows are left from an older load."""
    return F.when(_rest(key, 9, 4), "HISTORIC").otherwise("LATEST")


def _older(key: str) -> Column:
    """As :func:`_snapshot`, for other rows."""
    return F.when(_rest(key, 8, 3), "HISTORIC").otherwise("LATEST")


def _std(key: str, closed: Column | None = None) -> list[Column]:
    """[std] columns by the row's number: entity, status, end dates, snapshot."""
    return [_entity(key).alias("xcoemp"), _status(key).alias("cosiig"),
            (closed if closed is not None else _null("date")).alias("ffigco"),
            F.when(_rest(key, 13, 9), F.lit(_dt.date(2023, 6, 30))).alias("feigfi"), _snapshot(key).alias("snapshot")]


def _closed_if_f(but: int | None = None) -> Column:
    """Closed orders; those with remainder ``but`` of four are open in this table."""
    closed = F.col("o_orderstatus") == "F"
    return F.when(closed if but is None else closed & ~_rest("o_orderkey", 4, but), _shift("o_orderdate"))


class StandinSources:
    """Banking tables as lazily built DataFrames over the test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str = DEFAULT_SF_DIR):
        self.spark, self.sf_dir = spark, sf_dir
        self.t = TestTables(spark, sf_dir)

    # -- balances and contracts --------------------------------------------
    def _accounts(self) -> DataFrame:
        """Each customer's account, and a second one of every third customer."""
        c = self.t.customer
        product = lambda m: code_label("c_mktsegment", {k: str(v) for k, v in m.items()}).cast("int").alias("copser")
        first = c.select("*", product(SEGMENT_PRODUCT), F.lit("0001").alias("idcoec"), _pad("c_custkey").alias("idprig"), F.lit(1).alias("place"))
        second = c.filter(_rest("c_custkey", 3, 0)).select(
            "*", product(SECOND_PRODUCT), F.lit("0002").alias("idcoec"), _pad(F.col("c_custkey") + SECOND_ACCOUNT).alias("idprig"), F.lit(2).alias("place"))
        return first.unionByName(second)

    @cached_property
    def account_balance(self) -> DataFrame:
        """IGV0_CP_AHCA_D: daily net flow of the customer's event user, moved by customer, as balance of the first
        account; the second moves against it."""
        ev = self.t.events
        signed = F.when(F.col("event_type").isin("purchase", "error"), -F.col("value")).otherwise(F.col("value"))
        daily = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.round(F.sum(signed), 2).alias("flow"))
        newest_day = ev.agg(F.max(F.to_date("ts"))).scalar()
        c = self._accounts()
        j = daily.join(c.withColumn("user", F.floor(F.col("c_custkey") / CUSTOMERS_PER_USER)), daily.user_id == F.col("user"), "inner")
        flow = F.round(F.when(_rest("c_custkey", 2, 0), F.col("flow")).otherwise(-F.col("flow")) + F.col("c_custkey") % 7 * 3, 2)
        turn = F.col("c_custkey") + F.dayofmonth("day") + 3 * F.col("place")        # a status changes by day and account
        # some accounts are in the other snapshot too, with a balance that has been corrected since; both rows from one pass
        newest = F.coalesce(F.col("day") == newest_day, F.lit(False))
        j = j.select("*", newest.alias("newest"), F.when(F.col("place") == 1, flow).otherwise(F.round(15 - 0.6 * flow, 2)).alias("amount"))
        newest = F.col("newest")

        def entry(amount: Column, latest: Column) -> Column:
            return F.struct(amount.alias("cavt20"), F.when(latest, F.lit("LATEST")).otherwise(F.lit("HISTORIC")).alias("snapshot"))

        own, other = entry(F.col("amount"), newest), entry(-F.col("amount"), ~newest)
        twice = (newest & _rest("c_custkey", 4, 1)) | (~newest & _rest("c_custkey", 4, 2))
        j = j.select("*", F.explode(F.when(twice, F.array(own, other)).otherwise(F.array(own))).alias("entry"))
        return j.select(
            _entity("c_custkey").alias("xcoemp"), "copser", "idcoec", "idprig",
            F.col("c_custkey").alias("copemk"),
            F.col("day").alias("fevaig"),
            "entry.cavt20",
            F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("inz120"),
            F.when(F.col("c_nationkey") < 5, 1).otherwise(0).alias("inz121"),
            F.when(_rest("c_custkey", 5, 0), 1).otherwise(0).alias("inz122"),
            ((F.col("c_acctbal") - 3000) / 10).alias("imlimk"),
            F.when(turn % 7 == 6, 20000).otherwise(10000).alias("cosiig"),
            F.when(turn % 13 == 9, F.lit(_dt.date(2023, 6, 30))).alias("feigfi"),
            F.when(turn % 17 == 4, F.lit(_dt.date(2023, 6, 30))).alias("ffigco"),
            date_key("day").alias("extractiondate"),
            "entry.snapshot",
        )

    @cached_property
    def contracts(self) -> DataFrame:
        """IGV0_CONTRATO_P: account holders (from customer), second holders of every tenth account, order contracts."""
        c = self._accounts()

        def holders(rows: DataFrame, who: Column, relation: Column) -> DataFrame:
            return rows.select(
                _entity("c_custkey").alias("xcoemp"), "copser", "idcoec", "idprig", who.alias("copemk"), relation.alias("coprbs"),
                F.lit(_dt.date(2015, 1, 1)).alias("fiigco"),
                F.when(_rest("c_custkey", 19, 10), F.lit(_dt.date(2023, 5, 31))).alias("ffigco"),
                F.when(_rest("c_custkey", 12, 2), 20000).otherwise(10000).alias("cosiig"), _older("c_custkey").alias("snapshot"))

        own = holders(c, F.col("c_custkey"), F.when((F.col("c_mktsegment") == "FURNITURE") & (F.col("place") == 1), "0030").otherwise("0020"))
        shared = holders(c.filter(_rest("c_custkey", 10, 1) & (F.col("place") == 1)), F.col("c_custkey") + 1, F.when(_rest("c_custkey", 20, 11), "0030").otherwise("0020"))
        o = self.t.orders
        orders = o.select(
            _entity("o_orderkey").alias("xcoemp"), _priority_digit().cast("int").alias("copser"),
            _office("o_orderkey").alias("idcoec"), _pad("o_orderkey").alias("idprig"),
            F.col("o_custkey").alias("copemk"),
            F.when((F.col("o_orderstatus") == "O") & _rest("o_orderkey", 5, 1), "0030")
            .when(F.col("o_orderstatus") == "O", "0020").when(F.col("o_orderstatus") == "P", "0000")
            .otherwise("0010").alias("coprbs"),
            _shift("o_orderdate").alias("fiigco"), _closed_if_f(1).alias("ffigco"),
            F.when(_rest("o_orderkey", 12, 2), 20000).otherwise(10000).alias("cosiig"), _older("o_orderkey").alias("snapshot"))
        return own.unionByName(shared).unionByName(orders)

    @cached_property
    def holder_codes(self) -> DataFrame:
        """RELTIT: holder relation codes."""
        return self.t.region.select((F.col("r_regionkey") * 10).cast("string").alias("coprbs"),
                                    F.when(F.col("r_regionkey") == 3, "HISTORIC").otherwise("LATEST").alias("snapshot"))

    def _order_accounts(self, priority_digit: str, copser: int) -> DataFrame:
        o = self.t.orders.filter(_priority_digit() == priority_digit)
        return o.select(F.lit(copser).alias("copser"), _office("o_orderkey").alias("idcoec"),
                        _pad("o_orderkey").alias("idprig"), F.col("o_custkey").alias("copemk"),
                        *_std("o_orderkey", _closed_if_f(2)))

    @cached_property
    def fund_contracts(self) -> DataFrame:
        """IGV0_FOND_INV_D: fund accounts (medium-priority orders)."""
        return self._order_accounts("3", 3)

    @cached_property
    def plan_contracts(self) -> DataFrame:
        """IGV0_PLP_D: pension-plan accounts (not-specified-priority orders)."""
        return self._order_accounts("4", 4)

    @cached_property
    def plan_operations(self) -> DataFrame:
        """IGV0_PLP_OP_D: plan operations (order lines)."""
        li = self.t.lineitem
        return li.select(F.lit(4).alias("copser"), _office("l_orderkey").alias("idcoec"),
                         _pad("l_orderkey").alias("idprig"), _entity("l_orderkey").alias("xcoemp"),
                         (F.col("l_extendedprice") / 20).alias("cacv7j"),
                         F.col("l_linenumber").alias("cox1b7"),
                         _cycle(_shift("l_shipdate"), QUARTER_DAY, 2 * YEAR).alias("fecaig"),
                         F.date_sub(_shift("l_shipdate"), 40).alias("feopen"))

    @cached_property
    def payroll_contracts(self) -> DataFrame:
        """IGV0_NOM_CONTCOM_D: payroll contracts (low-priority orders)."""
        o = self.t.orders.filter(_priority_digit() == "5")
        return o.select(F.col("o_custkey").alias("copemk"), *_std("o_orderkey", _closed_if_f()))

    @cached_property
    def loans(self) -> DataFrame:
        """IGV0_LPRESPRE_D: pre-approved loans (urgent orders)."""
        o = self.t.orders.filter(_priority_digit() == "1")
        return o.select(
            F.col("o_custkey").alias("copemk"), F.when(_rest("o_orderkey", 13, 3), 93020).otherwise(93010).alias("copser"),
            (F.col("o_totalprice") / 100).alias("imlppm"),
            F.add_months(_shift("o_orderdate"), 12).alias("feclpp"),
            F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "P", 2)
            .otherwise(3).alias("inanom"),
            F.when(_rest("o_orderkey", 9, 1), "BA ").otherwise("AC ").alias("coelpp"),
            F.when(_rest("o_orderkey", 11, 2), "CA ").otherwise("VI ").alias("coespq"),
            F.when(F.col("o_totalprice") > 400000, "99 ").otherwise("01 ").alias("cdtcls"),
            *_std("o_orderkey", F.when(_rest("o_orderkey", 29, 4), _shift("o_orderdate"))))

    @cached_property
    def cards(self) -> DataFrame:
        """IGV0_TARJETA_D: cards (high-priority orders)."""
        o = self.t.orders.filter(_priority_digit() == "2")
        return o.select(
            F.col("o_custkey").alias("copemk"),
            F.when(_rest("o_orderkey", 19, 7), 0.0).otherwise(F.col("o_totalprice") / 1000).alias("cacv0d"),
            F.when(F.col("o_orderstatus") == "P", "D ").otherwise("C ").alias("titar3"),
            F.when(F.col("o_orderstatus") == "F", 50.0).otherwise(100.0).alias("porcpa"),
            *_std("o_orderkey", F.when(_rest("o_orderkey", 29, 4), _shift("o_orderdate"))))

    # -- people -------------------------------------------------------------
    @cached_property
    def person_board(self) -> DataFrame:
        """MKTBBLON: person board."""
        c = self.t.customer
        return c.select(
            F.col("c_custkey").alias("copemk"),
            F.when(F.col("c_mktsegment") == "AUTOMOBILE", 2).otherwise(1).alias("cotpmk"),
            F.when(F.col("c_acctbal") < 0, 0).otherwise(62120).alias("coh004"),
            F.add_months(F.lit(_dt.date(1998, 3, 1)), -(F.col("c_nationkey") % 2)).alias("fenac9"),
            F.round(F.col("c_acctbal") * 100).cast("bigint").alias("casfpt"),
            (F.lit(25) + F.when(_rest("c_custkey", 2, 0), 1).otherwise(0)).alias("caedad"),
            F.when(F.col("c_acctbal") > 5000, "1").otherwise("0").alias("in82mk"),
            F.when(F.col("c_mktsegment") == "BUILDING", "1").otherwise("0").alias("in94mk"),
            F.col("c_nationkey").cast("bigint").alias("cogsmk"),
            _snapshot("c_custkey").alias("snapshot"))

    @cached_property
    def customers_daily(self) -> DataFrame:
        """BGDV_DMCLIENTES_D: one derived customer row per order, on the extraction days; the month before has
        the rows of every other order, extracted 31 days earlier (monthly partition dt)."""
        c, o = self.t.customer, self.t.orders
        j = o.join(c, o.o_custkey == c.c_custkey, "inner")
        st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
        pad8 = _pad("c_custkey", 8)
        rows = j.select(
            F.col("c_custkey").alias("id_cliente"),
            _cycle(_shift("o_orderdate"), QUARTER_DAY, YEAR).alias("fecha_derivado"),
            F.when((pr == "5-LOW") | _rest("o_orderkey", 8, 3), _null("string")).otherwise(F.concat(F.lit("6"), pad8)).alias("telefono_movil_1"),
            F.when(st == "O", F.concat(F.lit("7"), pad8)).alias("telefono_movil_2"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", _null("string"))
            .otherwise(F.concat(F.lit("9"), pad8)).alias("telefono_fijo"),
            F.when(pr == "5-LOW", _null("string")).otherwise(F.lit("0034")).alias("prefijo_telefono_movil_1"),
            F.when(st == "O", F.lit("0034")).alias("prefijo_telefono_movil_2"),
            F.when(st == "F", "").when(st == "O", "SI").alias("ds_email"),
            F.col("c_name").alias("ds_nombre"),
            (F.col("c_nationkey") + 18).alias("edad_cliente"),
            F.when(_rest("c_custkey", 23, 8), 1).otherwise(0).alias("entidad"),
            F.add_months(F.lit(_dt.date(1998, 3, 1)), -(F.col("c_nationkey") % 2)).alias("fc_nacimiento"),
            F.when(F.col("c_acctbal") < -500, F.lit(_dt.date(2020, 6, 30))).alias("fc_fallecimiento_disolucion"),
            F.when(pr == "1-URGENT", _null("int")).otherwise(_priority_digit().cast("int")).alias("id_canal_preferido"),
            F.when(F.col("c_nationkey").isin(0, 1), F.col("c_nationkey") + 700).otherwise(800).alias("id_cartera"),
            _pad("c_nationkey", 5).alias("id_codigo_postal"),
            F.col("c_nationkey").cast("bigint").alias("id_gestor"),
            F.when(st == "P", _null("string"))
            .otherwise(F.substring(F.col("c_nationkey").cast("string"), -1, 1)).alias("id_idioma_preferencia"),
            _pad("c_nationkey", 4).alias("id_oficina"),
            F.col("c_mktsegment").alias("id_segm_soec"),
            pr.alias("id_segm_valor_estrategico"),
            F.when(F.col("c_mktsegment") == "AUTOMOBILE", 2).otherwise(1).alias("id_tipo_persona"),
            F.when(F.col("c_acctbal") > 8000, 1).otherwise(0).alias("ind_banca_personal"),
            F.when(F.col("c_acctbal") > 9500, 1).otherwise(0).alias("ind_banca_privada"),
            F.when(st == "F", _null("int")).when(st == "O", 1).otherwise(0).alias("ind_banca_virtual"),
            st.alias("id_clasificacion_actividad"),
            F.when(pr.isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "S").otherwise("N").alias("ind_cr_electronica"),
            F.when(F.col("c_acctbal") > 0, "S").otherwise("N").alias("ind_disp_moviles"),
            F.when(_rest("o_orderkey", 7, 0), "N").otherwise("S").alias("ind_telemarketing"),
            F.when(_rest("o_orderkey", 6, 1), 0).otherwise(1).alias("ind_correspondencia_internet"),
            F.lit(202401).alias("dt"), "o_orderkey")
        before = rows.filter(_rest("o_orderkey", 2, 0)).withColumns({
            "fecha_derivado": F.date_sub("fecha_derivado", 31), "edad_cliente": F.col("edad_cliente") - 1, "dt": F.lit(202312)})
        left = _rest("id_cliente", 25, 7)          # customers who left in December
        return rows.filter(~left).unionByName(before).drop("o_orderkey")

    @cached_property
    def managers(self) -> DataFrame:
        """MKGESTOR: managers."""
        n = self.t.nation
        return n.select(F.col("n_nationkey").cast("bigint").alias("cogsmk"),
                        _pad("n_regionkey", 4).alias("codice"),
                        F.substring("n_name", 1, 3).alias("cotgmk"),
                        F.when(_rest("n_nationkey", 12, 7), "HISTORIC").otherwise("LATEST").alias("snapshot"))

    @cached_property
    def manager_contacts(self) -> DataFrame:
        """MKGESCOM: manager e-mail (managers of region 0 have none)."""
        n = self.t.nation.filter(F.col("n_regionkey") != 0)
        return n.select(F.col("n_nationkey").cast("bigint").alias("cogrmk"),
                        F.concat(F.lower("n_name"), F.lit("@gestores.es")).alias("coemai"),
                        F.when(_rest("n_nationkey", 12, 8), "HISTORIC").otherwise("LATEST").alias("snapshot"))

    @cached_property
    def customer_attrs(self) -> DataFrame:
        """MKTBBLOF: customer attribute board."""
        c = self.t.customer
        return c.select(
            F.col("c_custkey").alias("copemk"),
            F.when(F.col("c_mktsegment") == "BUILDING", "1").otherwise("0").alias("in94mk"),
            F.when(F.col("c_acctbal") > 7000, "S").otherwise("N").alias("inpx06"),
            F.when(F.col("c_nationkey") > 20, "1").otherwise("0").alias("in16mk"),
            F.when(F.col("c_nationkey") < 10, "1").otherwise("0").alias("inlp26"),
            F.when(F.col("c_acctbal") > 3000, "1").otherwise("0").alias("in61mk"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "1").otherwise("0").alias("in77mk"),
            F.when(F.col("c_acctbal") < 0, "0").otherwise(F.col("c_nationkey").cast("string")).alias("cogsmk"),
            _entity("c_custkey").alias("xcoemp"), _snapshot("c_custkey").alias("snapshot"))

    @cached_property
    def value_managers(self) -> DataFrame:
        """MKSERMVL: value-manager services (high-priority orders)."""
        o = self.t.orders.filter(_priority_digit() == "2")
        return o.select(F.col("o_custkey").alias("copemk"), F.col("o_orderkey").alias("cogsmk"),
                        F.when(F.col("o_orderstatus") != "O", _shift("o_orderdate")).alias("ffcpmk"),
                        _snapshot("o_orderkey").alias("snapshot"))

    @cached_property
    def programme(self) -> DataFrame:
        """MKBKSINH: programme evaluations of the quarters' extraction days (some a quarter old), extracted about that day."""
        o = self.t.orders
        run = _cycle(_shift("o_orderdate"), QUARTER_DAY, QUARTER)
        return o.select(
            F.col("o_custkey").alias("copemk"), F.when(_rest("o_orderkey", 7, 3), F.date_sub(run, QUARTER)).otherwise(run).alias("fevaig"),
            F.when(F.col("o_totalprice") > 400000, "N").otherwise("S").alias("marin1"),
            F.when(_rest("o_orderkey", 5, 0), "N").otherwise("S").alias("marin2"),
            F.when((F.col("o_orderstatus") == "F") & _rest("o_orderkey", 3, 0), "N").otherwise("S").alias("marin3"),
            F.when((F.col("o_orderpriority") == "5-LOW") & _rest("o_orderkey", 2, 0), "N").otherwise("S").alias("marin5"),
            F.when(_rest("o_orderkey", 13, 2), "N").otherwise("S").alias("marin6"),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "OTRO ").otherwise("HIBD2 ").alias("clvpro"),
            date_key(F.date_add(run, F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 1).when(_rest("o_orderkey", 3, 2), -1).otherwise(0)))
            .alias("extractiondate"))

    # -- catalogue and dictionary --------------------------------------------
    @cached_property
    def catalogue(self) -> DataFrame:
        """MKCPMCDE: product catalogue extractions (order lines, product = line number)."""
        li = self.t.lineitem
        return li.select(
            F.col("l_linenumber").alias("copser"), F.col("l_returnflag").alias("cdfeco"),
            F.col("l_linestatus").alias("cdseco"),
            F.concat(F.lit("FAMILIA "), F.col("l_returnflag")).alias("dsfeco"),
            F.concat(F.lit("SUBFAMILIA "), F.col("l_linestatus")).alias("dsseco"),
            F.when(F.col("l_linestatus") == "O", "EN COMERCIALIZACIÓN")
            .otherwise("FUERA DE COMERCIALIZACIÓN").alias("especo"),
            F.when((F.col("l_returnflag") == "R") | _rest("l_partkey", 4, 1), "B").otherwise("A").alias("coesin"),
            date_key(_shift("l_shipdate")).alias("extractiondate"),
            F.col("l_orderkey").alias("row_order"), F.col("l_partkey").alias("row_part"),
            F.col("l_extendedprice").alias("row_price"))

    @cached_property
    def dictionary_attrs(self) -> DataFrame:
        """IGQ_DATO: dictionary attributes."""
        r = self.t.region
        return r.select(F.col("r_regionkey").cast("string").alias("codam1"),
                        F.when(F.col("r_regionkey") <= 2, 750).otherwise(751).alias("codamk"),
                        F.lit("LATEST").alias("snapshot"))

    @cached_property
    def dictionary_values(self) -> DataFrame:
        """IGQ_VALOR: dictionary values."""
        n = self.t.nation
        return n.select(F.col("n_regionkey").cast("string").alias("codamk"),
                        F.col("n_nationkey").cast("string").alias("coocmk"),
                        F.col("n_regionkey").alias("coocda"), F.col("n_name").alias("noocmk"),
                        F.lit("LATEST").alias("snapshot"))

    # -- models and web --------------------------------------------------------
    def _daily_event_stats(self) -> DataFrame:
        return self.t.events.groupBy(_customer().alias("customer"), "event_type", F.to_date("ts").alias("day")).agg(
            F.max("value").alias("vmax"))

    @cached_property
    def scores_a(self) -> DataFrame:
        """CRPROPEN: model scores, source A."""
        s = self._daily_event_stats()
        return s.select(F.col("customer").alias("idpers"), code_label("event_type", MODEL_A).alias("idmode"),
                        (F.col("vmax") / 500).alias("nupropen"),
                        date_key("day").alias("extractiondate"))

    @cached_property
    def scores_b(self) -> DataFrame:
        """BGMD_IN_MATRIZ_PROPENSIONES: model scores, source B."""
        s = self._daily_event_stats()
        return s.select(F.col("customer").alias("co_cliente"), code_label("event_type", MODEL_B).alias("modelid"),
                        (F.col("vmax") / 400).alias("probabilidad"),
                        date_key("day").alias("sessionid"))

    @cached_property
    def model_thresholds(self) -> DataFrame:
        """MODELOPROPENMIN: per model, use and day."""
        base = self.t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
            F.avg("value").alias("vavg"))
        def rows(models, use, factor):
            return base.select(code_label("event_type", models).alias("idmode"), F.lit(use).alias("iduso"),
                               (F.col("vavg") * factor).alias("nupropenmin"),
                               date_key("day").alias("extractiondate"), F.lit("LATEST").alias("snapshot"))
        return (rows(MODEL_A, "MEDICION", THRESHOLD_FACTOR / 500).unionByName(rows(MODEL_B, "MEDICION", THRESHOLD_FACTOR / 400))
                .unionByName(rows(MODEL_A, "ENTRENAMIENTO", 0.0)).unionByName(rows(MODEL_B, "ENTRENAMIENTO", 0.0))
                .unionByName(rows(MODEL_A, "MEDICION", THRESHOLD_FACTOR / 250).unionByName(rows(MODEL_B, "MEDICION", THRESHOLD_FACTOR / 200))
                             .withColumns({     # a later load, not in force
                                 "extractiondate": F.date_format(F.date_add(F.to_date("extractiondate", "yyyyMMdd"), 1), "yyyyMMdd"),
                                 "snapshot": F.lit("HISTORIC")})))

    @cached_property
    def web_hits(self) -> DataFrame:
        """BGTMD_ANALITICAWEB_D: web navigation hits."""
        e = self.t.events
        v, t = F.col("value"), F.col("event_type")
        return e.select(
            _customer().alias("id_cliente"), F.col("ts").alias("hit_ts"), F.col("event_id").alias("hit_id"),
            F.when(_rest("event_id", 3, 0), "WEB").otherwise("APP").alias("co_canal"),
            F.when(v >= 30, "Fondos de Inversion").otherwise("Planes de Pensiones").alias("tl_familia"),
            F.lit("particulares").alias("tl_seccion0_pagename"),
            F.when(t == "error", "empresas").otherwise(t).alias("tl_seccion1_pagename"),
            F.when(t == "purchase", "mis productos").when(_rest("event_id", 5, 0), "cartera").otherwise("productos").alias("tl_seccion2_pagename"),
            F.when(_rest("event_id", 4, 0), "").otherwise(F.col("props")).alias("tl_seccion3_pagename"),
            F.when(_rest("event_id", 2, 0), "detalle").alias("tl_seccion4_pagename"),
            F.when(t == "signup", "contratacion").when(t == "click", "")
            .when(t == "view", F.when(v < 60, "traspaso fondo").when(v < 120, _null("string"))
                  .otherwise("simulacion"))
            .otherwise("consulta").alias("tl_proceso_post"),
            date_key(F.to_date("ts"), "yyyyMM").alias("dt"),
            date_key(F.to_date("ts")).alias("fe_adobe_extraction_dia"))

    # -- insurance -------------------------------------------------------------
    @cached_property
    def receipts(self) -> DataFrame:
        """IGV0_SCP_ADESEPA_D: direct-debit receipts (order lines x part)."""
        o, li, p = self.t.orders, self.t.lineitem, self.t.part
        j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
        brand_ids = {f"Brand#{i + 1}": tid for i, tid in enumerate(BRAND_TAX_IDS)}
        return j.select(
            F.when(_rest("o_orderkey", 10, 7), F.lit(0).cast("bigint")).otherwise(F.col("o_custkey")).alias("cope14"),
            _cycle(_shift("o_orderdate"), RECEIPT_DAY, RECEIPT_CYCLE).alias("qfaope"),
            code_label("p_type", RECEIPT_TEXT_BY_TYPE, RECEIPT_TEXT_DEFAULT).alias("qncnes"),
            F.upper("p_name").alias("qncne1"),
            F.concat(F.lit("ES00001"), code_label("p_brand", brand_ids)).alias("idprac"),
            F.when(F.col("o_orderstatus") == "F", "DEV").otherwise("PRE").alias("qcacc7"),
            F.when(F.col("l_linenumber") <= 2, "0606").when(F.col("l_linenumber") <= 4, "0406")
            .otherwise("0101").alias("qcspc1"),
            F.when(_rest("o_orderkey", 6, 3), 4).otherwise(3).alias("qcopc3"),
            (F.col("l_extendedprice") / 1000).alias("qmnopd"),
            _snapshot("o_orderkey").alias("snapshot"))

    @cached_property
    def policies(self) -> DataFrame:
        """IGV0_SEG_POLIZAS: own insurance policies."""
        o = self.t.orders
        d = _priority_digit()
        return o.select(
            F.col("o_custkey").alias("copemk"),
            F.when(_rest("o_orderkey", 3, 1), 1).otherwise(2).alias("codsi7"),
            F.when(d == "1", 4).when(d == "2", 7).when(d == "3", 8).when(d == "4", 5).otherwise(9).alias("colnng"),
            (F.col("o_totalprice") / 1000).alias("imd2c0"),
            F.when(F.col("o_totalprice") > 200000, 25).otherwise(26).alias("cosgri"),
            F.when(~_rest("o_orderkey", 61, 30), _cycle(F.add_months(_shift("o_orderdate"), 12), EXPIRY_DAY, EXPIRY_CYCLE)).alias("feprnz"),
            F.when(F.col("o_orderstatus") == "F", "0019").when(F.col("o_orderstatus") == "P", "C511")
            .when(_rest("o_orderkey", 4, 1), "0600").otherwise("0500").alias("idcoas"),
            F.when(d == "4", "43530").when(d == "3", "46100").otherwise("10000").alias("copser"),
            *_std("o_orderkey", _closed_if_f()))

    # -- tables read by the draft journeys ----------------------------------------
    @cached_property
    def account_domiciliations(self) -> DataFrame:
        """IGV0_CP_AHCAD_DOM: account domiciliations (older extraction for closed orders)."""
        o, d = self.t.orders, _priority_digit()
        return o.select(
            F.col("o_custkey").alias("copemk"),
            F.when(d == "1", "10600").when(d == "2", "11594").when(d == "3", "11229").otherwise("10300").alias("copser"),
            F.when(F.col("o_orderstatus") == "O", "702").otherwise("701").alias("coddmc"),
            F.when(F.col("o_orderstatus") == "F", "20231231").otherwise("20240130").alias("extractiondate"))

    @cached_property
    def monthly_board(self) -> DataFrame:
        """BGTTB_TABLON_CLIENTES_MES_TT: monthly customer board, two monthly loads."""
        c = self.t.customer
        def load(process_date: str, factor: float) -> DataFrame:
            return c.select(
                F.col("c_custkey").alias("co_codpers_mt"), F.col("c_custkey").alias("co_cliente"),
                (F.col("c_acctbal") * factor).alias("im_saldfinmestotvolrecur_mt"),
                F.when(F.col("c_mktsegment") == "AUTOMOBILE", "1").otherwise("0").alias("in_tensegurauto_mt"),
                F.when(F.col("c_nationkey") == 7, "1").otherwise("0").alias("in_tensegurvehisegurauto_mt"),
                F.when(F.col("c_acctbal") > 6000, "1").otherwise("0").alias("in_tensegursaludindem_mt"),
                F.when(F.col("c_nationkey") == 9, "1").otherwise("0").alias("in_tensegursaludreemb_mt"),
                F.when(F.col("c_nationkey") == 5, "1").otherwise("0").alias("in_tensegursaludasistsanit_mt"),
                F.when(F.col("c_mktsegment") == "HOUSEHOLD", "1").otherwise("0").alias("in_tensegurotrsegurdecenoprimunic_mt"),
                F.when(F.col("c_nationkey") == 11, "1").otherwise("0").alias("in_tensegurotrsegurdeceprimunic_mt"),
                F.lit(process_date).alias("process_date"))
        return load("20231231", 0.5).unionByName(load("20240131", 1.0))

    @cached_property
    def monthly_accounts(self) -> DataFrame:
        """IGV0_CP_AHCAD_M: monthly account data."""
        o, d = self.t.orders, _priority_digit()
        return o.select(
            F.col("o_custkey").alias("copemk"),
            F.when(d == "1", "105").when(d == "2", "151").when(d == "3", "200").otherwise("135").alias("co1504"),
            F.when(F.col("o_orderstatus") == "F", "20231231").otherwise("20240131").alias("extractiondate"))

    @cached_property
    def contracting_events(self) -> DataFrame:
        """BGTMD_PB150_INICIOCONTRATACIONPRODUCTO_D: product contracting starts, on the extraction days."""
        o, d = self.t.orders, _priority_digit()
        return o.select(
            F.col("o_custkey").alias("co_cliente"),
            F.when(d == "1", "115594").when(d.isin("2", "3"), "11660").otherwise("10000").alias("co_producto_ursus"),
            F.when(_rest("o_orderkey", 3, 0), "1").otherwise("0").alias("co_empresa_cont"),
            date_key(_cycle(_shift("o_orderdate"), QUARTER_DAY, QUARTER)).alias("dt"))

    @cached_property
    def payroll_amounts(self) -> DataFrame:
        """IGV0_NOM_CONTCOM: payroll services with amount (low-priority orders)."""
        o = self.t.orders.filter(_priority_digit() == "5")
        return o.select(F.col("o_custkey").alias("copemk"),
                        F.when(F.col("o_orderstatus") == "O", "32000").otherwise("31000").alias("copser"),
                        (F.col("o_totalprice") / 100).alias("imulig"), _snapshot("o_orderkey").alias("snapshot"))
