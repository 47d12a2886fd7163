"""Web-interest journeys: investment funds and pension plans."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import flag
from ..operators import accounts, joins, scoring
from ..operators.reuse import reuse


def _interest(src, as_of: _dt.date, family: str, excluded: tuple, owners_for, models_a, models_b) -> DataFrame:
    hits = scoring.web_interest(src.web_hits, scoring.web_day(src, as_of), family, excluded)
    hits = reuse(hits.join(accounts.natural_persons(src.person_board, active_only=True),
                           hits.id_cliente == F.col("copemk"), "left_semi"))
    who = hits.select("id_cliente")     # one web day's customers: enrichments are reduced to them first
    owners = owners_for(who)
    when = scoring.newest_threshold_date(src, as_of)
    prop_a = scoring.propensity_a(src.scores_a, src.model_thresholds, models_a, "__pa", "PROPENSION_SAS", when, ids=who)
    prop_b = scoring.propensity_b(src.scores_b, src.model_thresholds, models_b, "__pb", "PROPENSION_BD", when, ids=who)
    # ownership rows fan out per customer (one per account, as the rule reads them)
    return (joins.left_join_skew_safe(hits, owners, [("id_cliente", "TITULAR")])
            .join(prop_a, F.col("id_cliente") == prop_a.__pa, "left")
            .join(prop_b, F.col("id_cliente") == prop_b.__pb, "left"))


def _propensity() -> "F.Column":
    return flag((F.col("PROPENSION_SAS") == 1) | (F.col("PROPENSION_BD") == 1))


def fund_interest(src, as_of: _dt.date, dedupe_owners: bool = False) -> DataFrame:
    """Customers who browsed investment funds on the newest web day."""
    def owners_for(who):
        owners = accounts.owners_of(src.fund_contracts, src.contracts, src.holder_codes, holders=who).select(
            F.col("copemk").alias("TITULAR"))
        return owners.distinct() if dedupe_owners else owners

    j = _interest(src, as_of, P.WEB_FAMILY_FUNDS, P.FUND_EXCLUDED_PROCESSES, owners_for,
                  P.FUND_MODELS_A, P.FUND_MODELS_B)
    return j.select(
        F.col("id_cliente").alias("ID_CLIENTE"), flag(F.col("TITULAR").isNotNull()).alias("C0"),
        _propensity().alias("C1"), F.col("co_canal").alias("C2"),
        F.col("tl_seccion1_pagename").alias("C3"), F.col("tl_seccion2_pagename").alias("C4"),
        F.col("tl_seccion3_pagename").alias("C5"), F.col("tl_proceso_post").alias("C6"))


def pension_interest(src, as_of: _dt.date) -> DataFrame:
    """Customers who browsed pension plans, with yearly contributions under the limit."""
    key = ["copser", "idcoec", "idprig", "xcoemp"]

    def owners_for(who):
        owned = accounts.owners_of(src.plan_contracts, src.contracts, src.holder_codes, holders=who)
        contrib = accounts.yearly_contributions(src.plan_operations, as_of, accounts=owned)
        return owned.join(contrib, key, "left").select(F.col("copemk").alias("TITULAR"), "APORTACION_ANUAL")

    j = _interest(src, as_of, P.WEB_FAMILY_PENSIONS, (), owners_for, P.PENSION_MODELS_A, P.PENSION_MODELS_B)
    return j.select(
        F.col("id_cliente").alias("ID_CLIENTE"), flag(F.col("TITULAR").isNotNull()).alias("C0"),
        flag(F.col("APORTACION_ANUAL").isNotNull() & (F.col("APORTACION_ANUAL") < P.CONTRIBUTION_LIMIT)).alias("C1"),
        _propensity().alias("C2"), F.col("co_canal").alias("C3"),
        F.col("tl_seccion1_pagename").alias("C4"), F.col("tl_seccion2_pagename").alias("C5"),
        F.col("tl_seccion3_pagename").alias("C6"), F.col("tl_proceso_post").alias("C7"))
