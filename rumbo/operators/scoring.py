"""Propensity and web-interest operators."""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import snapshot_is
from . import control, dedupe, joins, observe


def newest_threshold_date(src, as_of: _dt.date) -> Column:
    """Newest extraction of the LATEST threshold table not after ``as_of`` (see ``control.newest_of``)."""
    return control.newest_of(src, "model_thresholds", "extractiondate", as_of.strftime("%Y%m%d"), {"snapshot": P.SNAPSHOT_LATEST})


def propensity_flags(scores: DataFrame, thresholds: DataFrame, *, id_col: str, model_col: str,
                     score_col: str, date_col: str, models: Sequence[str], out_id: str,
                     flag_name: str, when: Column, use: str = P.MODEL_USE,
                     ids: DataFrame | None = None) -> DataFrame:
    """``(out_id, 1 AS flag_name)`` for customers with a score at or above the
    threshold of the same model, both taken at ``when``, the threshold table's newest date.

    Scores of a different date give no propensity at all (as in the source
    rule).  The threshold side is at most one row per listed model.
    """
    s = scores.filter(F.col(date_col) == when)
    observe.note_if_empty(s, f"no scores of the thresholds' newest date: models {', '.join(models)} give no propensity")
    if ids is not None:       # only the trigger's customers, before the distinct
        who = ids.select(F.col(ids.columns[0]).alias("__i"))
        s = s.join(who, s[id_col] == who["__i"], "left_semi")
    t = thresholds.filter((F.col("iduso") == use) & (F.col("extractiondate") == when))
    ids = joins.passing_ids(s, t, id_col=id_col, model_col=model_col, score_col=score_col,
                            thr_model_col="idmode", thr_col="nupropenmin", models=models, out_col=out_id)
    return ids.withColumn(flag_name, F.lit(1))


def propensity_a(scores_a: DataFrame, thresholds: DataFrame, models: Sequence[str], out_id: str,
                 flag_name: str, when: Column, ids: DataFrame | None = None) -> DataFrame:
    return propensity_flags(scores_a, thresholds, id_col="idpers", model_col="idmode", score_col="nupropen",
                            date_col="extractiondate", models=models, out_id=out_id, flag_name=flag_name, when=when, ids=ids)


def propensity_b(scores_b: DataFrame, thresholds: DataFrame, models: Sequence[str], out_id: str,
                 flag_name: str, when: Column, ids: DataFrame | None = None) -> DataFrame:
    return propensity_flags(scores_b, thresholds, id_col="co_cliente", model_col="modelid",
                            score_col="probabilidad", date_col="sessionid", models=models,
                            out_id=out_id, flag_name=flag_name, when=when, ids=ids)


WEB_COLUMNS = ["id_cliente", "co_canal", "tl_familia", "tl_seccion0_pagename", "tl_seccion1_pagename",
               "tl_seccion2_pagename", "tl_seccion3_pagename", "tl_seccion4_pagename", "tl_proceso_post"]


def web_day(src, as_of: _dt.date) -> Column:
    """Newest extraction day of the web hits not after ``as_of``."""
    return control.newest_of(src, "web_hits", "fe_adobe_extraction_dia", as_of.strftime("%Y%m%d"))


def web_interest(web_hits: DataFrame, day: str | Column, family: str,
                 excluded_processes: Sequence[str] = ()) -> DataFrame:
    """Best web hit per customer in a product family on a web day (the newest, :func:`web_day`).

    Business sections and "my products" pages are excluded, as are the listed
    processes (a NULL process fails ``NOT IN`` and is dropped, as in SQL).
    Ties are broken by the remaining columns so the choice is deterministic.
    """
    cond = ((F.col("fe_adobe_extraction_dia") == (F.lit(day) if isinstance(day, str) else day)) & (F.col("tl_familia") == family)
            & (F.col("tl_seccion1_pagename") != P.WEB_EXCLUDED_SECTION1)
            & (F.col("tl_seccion2_pagename") != P.WEB_EXCLUDED_SECTION2))
    if excluded_processes:
        cond = cond & ~F.col("tl_proceso_post").isin(*excluded_processes)
    hits = web_hits.filter(cond).select(*WEB_COLUMNS)
    rest = [c for c in WEB_COLUMNS if c not in ("id_cliente", "tl_proceso_post", "tl_seccion3_pagename")]
    order = dedupe.priority_order("tl_proceso_post", "tl_seccion3_pagename", P.WEB_PRIORITY_PROCESS,
                                  [F.col(c).asc_nulls_first() for c in rest])
    return dedupe.first_row_per_key(hits, ["id_cliente"], order)
