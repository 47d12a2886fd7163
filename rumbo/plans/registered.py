"""Every registered query: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Journey keys run the journey plans on the banking stand-ins; operator keys run
one operator (or a short chain) on the stand-ins or directly on the test
tables.  All read whole tables: no id subsets, samples or row caps.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions import (account_hash, add_months, code_label, concat_key, flag,
                         home_receipt_label, insurer_name, language_label, last_chars,
                         strip_leading_zeros, tax_id_of)
from ..operators import accounts, agg, control, dedupe, insurance, joins, people, scoring
from ..operators.reuse import scratch_folder
from ..sources.bucketed import write_bucketed
from ..sources.newest import newest_in_bands
from ..sources.sinks import write_run
from ..sources.standins import AS_OF, StandinSources
from ..sources.testdata import TestTables
from ..sources.typed import TypedSources
from ..sources.untyped import UntypedStandins
from ..sources.warehouse import LAYOUT, standin_warehouse
from ..streaming.balance_state import LastPositiveState
from . import core, drafts, insurance as ins_plan, overdraft, web_interest, youth

ORDERS_AS_OF = _dt.date(2001, 8, 1)      # newest order day of the raw test tables
# The daily load keeps contracts dated on or after its run date (strict "> as_of - 1",
# no upper bound, as written); a run 11 days before the data ends covers 11 days.
DAILY_LOAD_AS_OF = AS_OF - _dt.timedelta(days=11)
BIRTHDAY_DRAFT_AS_OF = _dt.date(2024, 2, 1)
# 56 days before a day on which the stand-ins' policies expire.
OWN_EXPIRY_AS_OF = _dt.date(2024, 3, 31)
SCORE_PIVOT_MODELS = {"MSGHCHX1": "COMPRA_SH_CLIENTE_SINPRESTAMO", "MSGHSHX1": "COMPRA_SH_CLIENTE_PRESTAMO"}
# Priority digit of an order -> youth product (5 has none), for the account-mix operator.
PRIORITY_PRODUCT = {"1": "11594", "2": "11239", "3": "10300", "4": "10600"}

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(fn: Query | None = None, *, name: str | None = None):
    """Register ``fn`` under its own name or ``name``."""
    def deco(f: Query) -> Query:
        REGISTRY[name or f.__name__] = f
        return f
    return deco(fn) if fn is not None else deco


def _src(spark, sf_dir):
    """Banking tables for ``sf_dir``: the stand-in warehouse (written once per
    session under the checkpoint folder), or the live derivation when
    ``RUMBO_STANDINS=live``."""
    if os.environ.get("RUMBO_STANDINS", "warehouse") == "live":
        return StandinSources(spark, sf_dir)
    return standin_warehouse(spark, sf_dir)


def _warehouse(spark, sf_dir):
    """The stand-in warehouse, for queries about its partitions."""
    return standin_warehouse(spark, sf_dir)


BUCKETS = 8
BUCKETED_TABLES = ("contracts", "person_board", "loans", "cards", "scores_a", "scores_b")


def _bucketed(spark, sf_dir):
    """The stand-ins with :data:`BUCKETED_TABLES` in catalog tables of this session, written once."""
    name = "bucketed_" + hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    if (spark.sparkContext.applicationId, name) not in _BUCKETED:
        _BUCKETED[spark.sparkContext.applicationId, name] = write_bucketed(
            standin_warehouse(spark, sf_dir), name, BUCKETS, BUCKETED_TABLES, LAYOUT, location=scratch_folder(spark, "buckets"))
    return _BUCKETED[spark.sparkContext.applicationId, name]


_BUCKETED: dict[tuple[str, str], object] = {}


# ---------------------------------------------------------------- journeys
@register
def customer_core(spark, sf_dir):
    """Newest cleaned row per living natural person with manager and detail columns."""
    return core.customer_core(_src(spark, sf_dir), AS_OF)


@register
def contract_initial_load(spark, sf_dir):
    """Holder contracts started in the last 3 months with catalogue and name."""
    return core.contract_initial_load(_src(spark, sf_dir), AS_OF)


@register
def contract_daily_load(spark, sf_dir):
    """The same contract core for contracts dated on or after the run date."""
    return core.contract_daily_load(_src(spark, sf_dir), DAILY_LOAD_AS_OF)


@register
def overdraft_master(spark, sf_dir):
    """Every account overdrawn yesterday with days overdrawn and covers."""
    return overdraft.overdraft_master(_src(spark, sf_dir), AS_OF)


@register
def overdraft_journey(spark, sf_dir):
    """Customers newly overdrawn yesterday, deepest overdraft, covers and propensity."""
    return overdraft.overdraft_journey(_src(spark, sf_dir), AS_OF)


@register
def fund_interest(spark, sf_dir):
    """Best fund web hit of the newest web day, ownership and propensity."""
    return web_interest.fund_interest(_src(spark, sf_dir), AS_OF)


@register
def pension_interest(spark, sf_dir):
    """Best pension web hit, plan ownership, yearly contributions, propensity."""
    return web_interest.pension_interest(_src(spark, sf_dir), AS_OF)


@register
def young_retention(spark, sf_dir):
    """Youth-account holders turning 26 in 30 days, after programme/digital exclusions."""
    return youth.young_retention(_src(spark, sf_dir), AS_OF)


@register
def home_insurance_expiry(spark, sf_dir):
    """Competitor home-insurance receipts expiring in 2 months, own-policy flags."""
    return ins_plan.home_insurance_expiry(_src(spark, sf_dir), AS_OF)


@register
def young_retention_draft(spark, sf_dir):
    """Draft birthday-by-parts rule with control-table reads."""
    return drafts.young_retention_draft(_src(spark, sf_dir), BIRTHDAY_DRAFT_AS_OF)


@register
def home_insurance_draft(spark, sf_dir):
    """Own home policies expiring in 56 days with enrichment flags."""
    return drafts.home_insurance_draft(_src(spark, sf_dir), AS_OF)


# ---------------------------------------------------------- scans / control
@register
def latest_snapshot(spark, sf_dir):
    """Rows of the LATEST balance snapshot."""
    bal = _src(spark, sf_dir).account_balance
    return bal.filter(F.col("snapshot") == P.SNAPSHOT_LATEST).select("copemk", "fevaig", "cavt20", "extractiondate")


@register
def day_partition(spark, sf_dir):
    """Accounts overdrawn yesterday (one daily partition)."""
    od = accounts.overdrawn_accounts(_src(spark, sf_dir).account_balance, AS_OF)
    return od.select("copemk", "idprig", "cavt20", "fevaig")


@register
def newest_partition(spark, sf_dir):
    """Orders of the newest order day."""
    o = TestTables(spark, sf_dir).orders
    # looked for from the day on that the test data is known to end; any other start gives the same day
    (day,) = newest_in_bands(o, {"o_orderdate": None}, ORDERS_AS_OF)
    newest = F.lit(None if day is None else day.isoformat()).cast(o.schema["o_orderdate"].dataType)
    return o.filter(F.col("o_orderdate") == newest).select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"))


@register
def control_table_union(spark, sf_dir):
    """(label, newest date) of orders, lineitem and events, unioned."""
    t = TestTables(spark, sf_dir)
    return control.control_table([("tbl_orders", t.orders, "o_orderdate"),
                                  ("tbl_lineitem", t.lineitem, "l_shipdate"),
                                  ("tbl_events", t.events, "ts")])


@register
def historic_window_max(spark, sf_dir):
    """Newest non-negative balance day per account in the last 15 days."""
    return accounts.last_positive_day(_src(spark, sf_dir).account_balance, AS_OF)


@register
def active_accounts(spark, sf_dir):
    """Live contracts (no end date, entity 0, status 10000)."""
    c = _src(spark, sf_dir).contracts
    live = c.filter((F.col("snapshot") == P.SNAPSHOT_LATEST) & (F.col("xcoemp") == P.ENTITY)
                    & F.col("ffigco").isNull() & (F.col("cosiig") == P.STATUS_ACTIVE))
    return live.select("copemk", "copser", "idprig", "coprbs")


@register
def newest_control(spark, sf_dir):
    """The drafts' control table, from partition listings alone."""
    return drafts.control_dates(_warehouse(spark, sf_dir), list(drafts.CONTROL_SOURCES), AS_OF)


@register
def last_positive_state(spark, sf_dir):
    """The same days as ``historic_window_max``, carried from run to run over the window's days."""
    src = _warehouse(spark, sf_dir)
    state = LastPositiveState(spark, scratch_folder(spark, "balance-state"))
    for back in (9, 2, 0):           # a first run, one a week later, one after a missed day
        state.run(src, AS_OF - _dt.timedelta(days=back))
    return state.view(src, AS_OF)


@register
def run_sink(spark, sf_dir):
    """The overdraft master written for two run dates, the newer one twice, and read back."""
    src, path = _src(spark, sf_dir), scratch_folder(spark, "run-sink")
    for as_of in (AS_OF - _dt.timedelta(days=1), AS_OF, AS_OF):
        write_run(overdraft.overdraft_master(src, AS_OF), path, as_of)
    return spark.read.parquet(path)


# ------------------------------------------------------------ untyped sources
def _typed(spark, sf_dir) -> TypedSources:
    # the stand-ins' plan contributions have 4 decimals
    return TypedSources(UntypedStandins(_src(spark, sf_dir)), decimals=4)


@register
def quarantined_rows(spark, sf_dir):
    """Rows of the untyped extract that do not fit their declared types, by table, column and reason."""
    src = _typed(spark, sf_dir)
    rows = [src.quarantine(n).select("table_name", F.explode("faults").alias("f")) for n in ("contracts", "account_balance", "plan_operations")]
    return reduce(DataFrame.unionByName, rows).groupBy("table_name", F.col("f.column").alias("column_name"),
                                                       F.col("f.reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@register
def contract_initial_load_typed(spark, sf_dir):
    """The initial contract load from padded and non-numeric codes."""
    return core.contract_initial_load(_typed(spark, sf_dir), AS_OF)


@register
def total_balance_cover_typed(spark, sf_dir):
    """The sign of the customers' balances, summed as decimals read from text."""
    s = _typed(spark, sf_dir)
    trig = accounts.overdraft_trigger(s.account_balance, s.contracts, s.person_board, AS_OF)
    return accounts.total_balance_cover(trig, s.contracts, s.account_balance)


@register
def yearly_contributions_typed(spark, sf_dir):
    """Contributions of the run year as decimals read from text."""
    c = accounts.yearly_contributions(_typed(spark, sf_dir).plan_operations, AS_OF)
    return c.select("idprig", F.col("APORTACION_ANUAL").cast("double").alias("APORTACION_ANUAL"),
                    flag(F.col("APORTACION_ANUAL") < P.CONTRIBUTION_LIMIT).alias("IND_APORTACION_MENOR_7000"))


# ------------------------------------------------------------ bucketed tables
@register
def overdraft_journey_bucketed(spark, sf_dir):
    """The overdraft journey with its customer tables bucketed by customer."""
    return overdraft.overdraft_journey(_bucketed(spark, sf_dir), AS_OF)


# ------------------------------------------------------------ top-1 / windows
@register
def latest_row_per_key(spark, sf_dir):
    """Newest order per customer (row_number = 1)."""
    o = TestTables(spark, sf_dir).orders
    top = dedupe.latest_row_per_key(o, ["o_custkey"], "o_orderdate", [F.col("o_orderkey").desc()])
    return top.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")


@register
def latest_catalogue(spark, sf_dir):
    """Newest line per part in the 15 days to the orders' newest day."""
    li = TestTables(spark, sf_dir).lineitem.withColumn("ship_day", F.to_date("l_shipdate"))
    top = dedupe.latest_in_window(
        li, "l_partkey", "ship_day", since=ORDERS_AS_OF - _dt.timedelta(days=P.CATALOGUE_WINDOW_DAYS),
        until=ORDERS_AS_OF,
        tie_breakers=[F.col("l_orderkey").desc(), F.col("l_linenumber").desc(), F.col("l_extendedprice").desc()])
    return top.select("l_partkey", "ship_day", "l_orderkey", "l_linenumber", "l_extendedprice",
                      "l_returnflag", "l_linestatus")


@register
def worst_overdraft(spark, sf_dir):
    """Lowest negative daily balance per customer."""
    bal = _src(spark, sf_dir).account_balance.filter(F.col("cavt20") < 0)
    w = dedupe.worst_row_per_key(bal, ["copemk"], "cavt20", [F.col("fevaig").asc()])
    return w.select("copemk", "idprig", "fevaig", "cavt20")


@register
def web_interest_trigger(spark, sf_dir):
    """Best funds web hit per customer with the process exclusions."""
    s = _src(spark, sf_dir)
    return scoring.web_interest(s.web_hits, scoring.web_day(s, AS_OF), P.WEB_FAMILY_FUNDS, P.FUND_EXCLUDED_PROCESSES)


@register
def web_priority_row(spark, sf_dir):
    """Best pensions web hit per customer (no process exclusion)."""
    s = _src(spark, sf_dir)
    return scoring.web_interest(s.web_hits, scoring.web_day(s, AS_OF), P.WEB_FAMILY_PENSIONS)


# ---------------------------------------------------------------------- joins
@register
def left_enrich(spark, sf_dir):
    """Customer LEFT JOIN nation, region with typed defaults."""
    t = TestTables(spark, sf_dir)
    c, n = t.customer, t.nation
    r = t.region.filter(F.col("r_regionkey") != 0)
    j = joins.enrich(joins.enrich(c, n, [("c_nationkey", "n_nationkey")]), r, [("n_regionkey", "r_regionkey")])
    return j.select("c_custkey", F.coalesce("n_name", F.lit("0")).alias("nation"),
                    F.coalesce("r_name", F.lit("0")).alias("region"),
                    F.coalesce("r_regionkey", F.lit(0)).alias("region_key"))


@register
def composite_key_join(spark, sf_dir):
    """Lineitem LEFT JOIN its own group on (order key, line number)."""
    li = TestTables(spark, sf_dir).lineitem
    g = li.groupBy(F.col("l_orderkey").alias("g_orderkey"), F.col("l_linenumber").alias("g_linenumber")).agg(
        F.to_date(F.max("l_shipdate")).alias("last_ship"), F.count(F.lit(1)).alias("n_lines"))
    j = joins.enrich(li, g, [("l_orderkey", "g_orderkey"), ("l_linenumber", "g_linenumber")])
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "last_ship", "n_lines")


@register
def natural_person_filter(spark, sf_dir):
    """Orders of active natural persons (semi join)."""
    s = _src(spark, sf_dir)
    o = TestTables(spark, sf_dir).orders
    return joins.semi(o, accounts.natural_persons(s.person_board, active_only=True),
                      [("o_custkey", "copemk")]).select("o_orderkey", "o_custkey")


@register
def dictionary_lookup(spark, sf_dir):
    """Comma join of dictionary attribute and values, distinct."""
    s = _src(spark, sf_dir)
    return core.product_dictionary(s.dictionary_attrs, s.dictionary_values)


@register
def normalised_code_semi_join(spark, sf_dir):
    """Contracts whose zero-stripped relation code is a holder code."""
    s = _src(spark, sf_dir)
    return accounts.holder_contracts(s.contracts, s.holder_codes).select(
        "copemk", "copser", "idprig", "coprbs", strip_leading_zeros("coprbs").alias("code"))


@register
def presence_flag(spark, sf_dir):
    """0/1 flag for customers with an urgent order."""
    t = TestTables(spark, sf_dir)
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    return joins.with_presence(t.customer.select("c_custkey"), urgent, "c_custkey", "o_custkey", "IND_URGENTE")


@register
def anti_join_exclusion(spark, sf_dir):
    """Customers without an urgent order (anti join)."""
    t = TestTables(spark, sf_dir)
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    return joins.anti(t.customer, urgent, [("c_custkey", "o_custkey")]).select("c_custkey", "c_name")


@register
def anti_join_composite(spark, sf_dir):
    """Lines without a returned line of the same two keys."""
    li = TestTables(spark, sf_dir).lineitem
    returned = li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("r_orderkey"), F.col("l_linenumber").alias("r_linenumber"))
    a = joins.anti(li, returned, [("l_orderkey", "r_orderkey"), ("l_linenumber", "r_linenumber")])
    return a.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


@register
def latest_date_semi(spark, sf_dir):
    """Programme rows of the newest evaluation meeting the criteria."""
    return people.programme_rows(_src(spark, sf_dir), AS_OF, passing=True)


# ------------------------------------------------------------ overdraft ops
@register
def overdraft_transition(spark, sf_dir):
    """Overdrawn yesterday and positive the day before."""
    s = _src(spark, sf_dir)
    t = accounts.new_overdrafts(s.account_balance, s.contracts, s.person_board, AS_OF)
    return t.select("ID_URSUS", "idprig", "IMPORTE_DESCUBIERTO", "SALDO_AYER", "FECHA_DESCUBIERTO")


@register
def days_since_last_positive(spark, sf_dir):
    """Days since the last non-negative day of each overdrawn account."""
    return accounts.days_overdrawn(_src(spark, sf_dir).account_balance, AS_OF)


@register
def total_balance_cover(spark, sf_dir):
    """Sign of the sum of the trigger customers' balances."""
    s = _src(spark, sf_dir)
    trig = accounts.overdraft_trigger(s.account_balance, s.contracts, s.person_board, AS_OF)
    return accounts.total_balance_cover(trig, s.contracts, s.account_balance)


@register
def card_limit_cover(spark, sf_dir):
    """Best credit-card limit against yesterday's overdraft."""
    s = _src(spark, sf_dir)
    od = accounts.overdrawn_accounts(s.account_balance, AS_OF).select("copemk", "idprig", "cavt20")
    cards = accounts.best_credit_card_limit(s.cards).withColumnRenamed("copemk", "__c")
    j = od.join(cards, od.copemk == cards.__c, "left")
    return j.select("copemk", "idprig", "MAX_LIMITE_DISPONIBLE_TARJ_CRED",
                    flag(F.col("MAX_LIMITE_DISPONIBLE_TARJ_CRED") >= F.col("cavt20")).alias("IND_TARJ_CUBRE"))


@register
def preapproved_loan_cover(spark, sf_dir):
    """Pre-approved loan amount and validity against the overdraft."""
    s = _src(spark, sf_dir)
    od = accounts.overdrawn_accounts(s.account_balance, AS_OF).select("copemk", "idprig", "cavt20", "fevaig")
    loans = accounts.preapproved_loans(s.loans).withColumnRenamed("copemk", "__l")
    j = od.join(loans, od.copemk == loans.__l, "left")
    return j.select("copemk", "idprig", "IMPORTE_LPP", "VIGENCIA_LPP",
                    F.coalesce("IND_ANTICIPO_NOMINA", F.lit(0)).alias("IND_ANTICIPO_NOMINA"),
                    flag((F.col("IMPORTE_LPP") >= F.col("cavt20"))
                         & (F.col("VIGENCIA_LPP") > F.col("fevaig"))).alias("IND_LPP_CUBRE"))


# ------------------------------------------------------------- propensity
@register
def propensity_multi_model(spark, sf_dir):
    """Customers over the threshold of the same model (fund and pension models)."""
    s = _src(spark, sf_dir)
    return scoring.propensity_a(s.scores_a, s.model_thresholds, P.FUND_MODELS_A + P.PENSION_MODELS_A,
                                "ID_CLIENTE", "PROPENSION", scoring.newest_threshold_date(s, AS_OF))


@register
def propensity_single_model(spark, sf_dir):
    """Customers over the single overdraft model's threshold."""
    s = _src(spark, sf_dir)
    return scoring.propensity_b(s.scores_b, s.model_thresholds, [P.OVERDRAFT_MODEL_SCORES_B],
                                "ID_CLIENTE", "PROPENSION", scoring.newest_threshold_date(s, AS_OF))


@register
def score_pivot(spark, sf_dir):
    """Max score per customer for two models as two columns."""
    s = _src(spark, sf_dir).scores_b
    return agg.pivot_max(s, "co_cliente", "modelid", "probabilidad", SCORE_PIVOT_MODELS, default=0.0)


@register
def yearly_contributions(spark, sf_dir):
    """Contributions of the run year per plan account, under-7000 flag."""
    c = accounts.yearly_contributions(_src(spark, sf_dir).plan_operations, AS_OF)
    return c.select("idprig", F.round("APORTACION_ANUAL", 4).cast("double").alias("APORTACION_ANUAL"),
                    flag(F.col("APORTACION_ANUAL") < P.CONTRIBUTION_LIMIT).alias("IND_APORTACION_MENOR_7000"))


# ------------------------------------------------------------------ youth
@register
def product_family_flags(spark, sf_dir):
    """Youth-product accounts with family flags."""
    return people.youth_accounts(_src(spark, sf_dir), AS_OF)


@register
def account_mix(spark, sf_dir):
    """Distinct accounts, accounts per family, all-ON/young flag."""
    o = TestTables(spark, sf_dir).orders
    rows = o.select("o_custkey",
                    code_label(F.substring("o_orderpriority", 1, 1), PRIORITY_PRODUCT).cast("int").alias("copser"),
                    F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("idprig"))
    s = F.col("copser")
    rows = rows.select("*", flag(s == P.YOUTH_PRODUCT_ON).alias("cuenta_on"),
                       flag(s == P.YOUTH_PRODUCT_YOUNG).alias("cuenta_joven"),
                       flag(s.isin(*P.YOUTH_PRODUCTS_EASY)).alias("cuenta_facil"),
                       flag(s.isin(*P.YOUTH_PRODUCTS)).alias("total_cuentas"))
    return agg.account_mix(rows, ["o_custkey"], "copser", "idprig", "cuenta_on", "cuenta_joven",
                           "cuenta_facil", "total_cuentas")


@register
def anniversary_trigger(spark, sf_dir):
    """Persons turning 26 thirty days after the run date."""
    return people.milestone_birthdays(_src(spark, sf_dir).person_board, AS_OF)


@register
def birthday_trigger(spark, sf_dir):
    """Draft birthday rule by day, month and year parts."""
    pb = _src(spark, sf_dir).person_board
    return pb.filter(people.birthday_by_parts("fenac9", BIRTHDAY_DRAFT_AS_OF, P.DRAFT_AGE_YEARS)).select(
        "copemk", "fenac9")


# -------------------------------------------------------------- insurance
@register
def code_map_lookup(spark, sf_dir):
    """Insurer name from the receipt's creditor tax id."""
    r = _src(spark, sf_dir).receipts
    return r.select("cope14", "idprac", insurer_name(tax_id_of("idprac")).alias("COMPANIA"))


@register
def text_classify(spark, sf_dir):
    """Home-insurance receipts by include/exclude text patterns."""
    r = _src(spark, sf_dir).receipts
    text = F.concat("qncnes", "qncne1")
    out = r.select("cope14", F.regexp_replace(text, ",", "").alias("Concepto"), home_receipt_label(text).alias("RAMO"))
    return out.filter(F.col("RAMO").isNotNull() & (F.length("Concepto") >= P.RECEIPT_MIN_TEXT))


@register
def expiring_policy_trigger(spark, sf_dir):
    """Prepaid receipts paid exactly 10 months ago."""
    return insurance.expiring_receipts(_src(spark, sf_dir).receipts, AS_OF)


@register
def own_policy_expiry(spark, sf_dir):
    """Own home policies expiring in 56 days with their holders' tenure flags."""
    return drafts.own_policy_expiry(_src(spark, sf_dir), OWN_EXPIRY_AS_OF)


@register
def policy_threshold_flags(spark, sf_dir):
    """Per-holder premium threshold flags of own policies."""
    return insurance.policy_flags(_src(spark, sf_dir).policies)


# ---------------------------------------------------------------- scalars
@register(name="account_hash")
def account_hash_key(spark, sf_dir):
    """md5 pseudonym of the concatenated account key."""
    c = _src(spark, sf_dir).contracts
    return c.select("copemk", "copser", "idprig", account_hash("copser", "xcoemp", "idprig").alias("C5"))


@register(name="language_label")
def language_label_map(spark, sf_dir):
    """Language code to label, else 'ES'."""
    c = _src(spark, sf_dir).customers_daily
    return c.select("id_cliente", "fecha_derivado", "id_idioma_preferencia",
                    language_label("id_idioma_preferencia").alias("idioma_preferencia"))


@register
def scalar_functions(spark, sf_dir):
    """Every scalar function of the rules in one projection."""
    t = TestTables(spark, sf_dir)
    o = t.orders
    d = F.to_date("o_orderdate")
    key = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    status = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    return o.select(
        "o_orderkey",
        F.coalesce(status, F.lit("X")).alias("f_coalesce"),
        F.isnull(status).alias("f_isnull_b").cast("int").alias("f_isnull"),
        flag(F.col("o_totalprice") > 200000).alias("f_if"),
        last_chars(key, 4).alias("f_last4"),
        F.substring(F.col("o_orderpriority"), 3, 4).alias("f_substr"),
        concat_key("o_orderkey", status, "o_custkey").alias("f_concat"),
        strip_leading_zeros(key).alias("f_strip"),
        F.regexp_replace(F.concat(F.col("o_orderpriority"), F.lit(",x,")), ",", "").alias("f_nocomma"),
        F.trim(F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit(" "))).alias("f_trim"),
        F.length("o_orderpriority").alias("f_length"),
        F.md5(concat_key("o_orderkey", "o_custkey")).alias("f_md5"),
        F.col("o_orderpriority").like("%URG%").cast("int").alias("f_like"),
        F.date_sub(d, 15).alias("f_date_sub"),
        F.date_add(d, 30).alias("f_date_add"),
        add_months(d, 12).alias("f_add_months"),
        F.datediff(F.lit(ORDERS_AS_OF), d).alias("f_datediff"),
        F.date_format(d, "yyyyMMdd").alias("f_date_format"),
        F.year(d).alias("f_year"), F.month(d).alias("f_month"), F.dayofmonth(d).alias("f_day"),
        (F.col("o_totalprice") / 100).alias("f_div"),
        (F.year(d) - F.lit(1990)).alias("f_minus"),
    )

