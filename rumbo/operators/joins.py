"""Join operators: enrichment, semi / anti joins, presence flags, thresholds.

Strategy notes (what Spark does with each at scale):

* Equi joins are left to Catalyst + AQE: sort-merge on the key, switched at
  run time to a broadcast hash join when a side's measured shuffle output is
  under ``spark.sql.autoBroadcastJoinThreshold``; skewed partitions are split
  by AQE's skew-join handling.  No side whose size grows with the data is
  ever force-broadcast.
* Explicit ``broadcast`` hints are only placed on sides with a proven row
  bound (a one-row control frame, thresholds aggregated per listed model).
* ``LEFT JOIN ... WHERE right.key IS NULL`` is written as ``left_anti``: Spark
  4.1 keeps the outer-join form as LeftOuter + Filter, which ships and
  materialises every matched pair first.
* Score thresholds are applied as an equi join on the model id against the
  minimum threshold per model, which is exactly "some threshold row of the
  model is met", instead of a nested-loop theta join.
* A left join whose right side may hold a hot key is asked for its heavy keys
  first (:func:`heavy_keys`, a mergeable frequency sketch over the key column);
  only those keys are salted (:func:`left_join_skew_safe`).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reuse import reuse

Key = str | tuple[str, str]


def _cond(left: DataFrame, right: DataFrame, on: Sequence[Key]) -> Column | list[str]:
    if all(isinstance(k, str) for k in on):
        return list(on)
    parts = []
    for k in on:
        lk, rk = (k, k) if isinstance(k, str) else k
        parts.append(left[lk] == right[rk])
    return reduce(lambda a, b: a & b, parts)


def enrich(left: DataFrame, right: DataFrame, on: Sequence[Key], how: str = "left") -> DataFrame:
    """LEFT (or inner) equi join keeping every left row (fan-out as the data has it)."""
    return left.join(right, _cond(left, right, on), how)


def semi(left: DataFrame, right: DataFrame, on: Sequence[Key]) -> DataFrame:
    """Rows of ``left`` with a match in ``right`` (IN-subquery / existence test)."""
    return left.join(right, _cond(left, right, on), "left_semi")


def anti(left: DataFrame, right: DataFrame, on: Sequence[Key]) -> DataFrame:
    """Rows of ``left`` without a match in ``right`` (exclusion list)."""
    return left.join(right, _cond(left, right, on), "left_anti")


def presence(df: DataFrame, key: str, flag_name: str, as_key: str | None = None) -> DataFrame:
    """Distinct keys of ``df`` with a constant ``1`` flag (``GROUP BY key, 1 AS f``)."""
    return df.select(F.col(key).alias(as_key or key)).distinct().withColumn(flag_name, F.lit(1))


def with_presence(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  flag_name: str) -> DataFrame:
    """Add a 0/1 column telling whether ``left_key`` occurs in ``right``.

    The right side is reduced to distinct keys before the join (map-side
    partial aggregation), so the join never multiplies left rows.
    """
    flags = presence(right, right_key, flag_name, as_key="__pk")
    out = left.join(flags, left[left_key] == flags["__pk"], "left").drop("__pk")
    return out.withColumn(flag_name, F.coalesce(F.col(flag_name), F.lit(0)))


def passing_ids(scores: DataFrame, thresholds: DataFrame, id_col: str, model_col: str,
                score_col: str, thr_model_col: str, thr_col: str,
                models: Sequence[str] | None = None, out_col: str | None = None) -> DataFrame:
    """Distinct ids having a score at or above a threshold of the same model.

    ``thresholds`` are reduced to ``min(threshold)`` per model; restricted to
    the listed ``models`` that frame has at most ``len(models)`` rows, so the
    broadcast is bounded by the rule, not by the data.
    """
    thr = thresholds
    if models is not None:
        thr = thr.filter(F.col(thr_model_col).isin(list(models)))
        scores = scores.filter(F.col(model_col).isin(list(models)))
    thr = thr.groupBy(F.col(thr_model_col).alias("__model")).agg(F.min(thr_col).alias("__min"))
    if models is not None:
        thr = F.broadcast(thr)
    hits = scores.join(thr, scores[model_col] == thr["__model"], "inner").filter(
        F.col(score_col) >= F.col("__min"))
    return hits.select(F.col(id_col).alias(out_col or id_col)).distinct()


# A key is heavy when it has this many times the rows of an even shuffle partition ...
HEAVY_FACTOR = 2
# ... and at least this many rows: fewer are no load for a task.
HEAVY_ROWS = 10_000


@dataclass(frozen=True)
class HeavyKey:
    """A key's value, its rows (as the sketch has them) and the number of parts it is dealt to."""

    value: Any
    rows: int
    parts: int


def heavy_keys(df: DataFrame, key: str, factor: float = HEAVY_FACTOR, least_rows: int = HEAVY_ROWS) -> list[HeavyKey]:
    """Keys of ``df`` that bring more rows than ``factor`` even shuffle partitions, the most frequent first.

    One pass over the key column: every task keeps a frequency sketch of bounded
    size, and the sketches are merged, so a hot key costs no shuffle.  The
    shares of heavy keys add up to at most 1, so there are at most
    ``partitions / factor`` of them; the sketch tracks 50 times as many, which
    bounds its error well below the threshold.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, min(10_000, int(partitions / factor) + 1))
    tracked = max(1_000, min(1_000_000, 50 * partitions))
    found, total = df.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {tracked})"), F.count(F.lit(1))).first()
    even = total / partitions
    return [HeavyKey(r["item"], r["count"], max(2, math.ceil(r["count"] / max(even, 1)))) for r in found or []
            if r["count"] >= least_rows and r["count"] > factor * even]


def _parts(key: Column, heavy: Sequence[HeavyKey]) -> Column:
    """Number of parts of a heavy key, from a literal map."""
    pairs = [x for h in heavy for x in (F.lit(h.value), F.lit(h.parts))]
    return F.try_element_at(F.create_map(*pairs), key)


def left_join_skew_safe(left: DataFrame, right: DataFrame, on: tuple[str, str] | Sequence[tuple[str, str]],
                        factor: float = HEAVY_FACTOR, least_rows: int = HEAVY_ROWS) -> DataFrame:
    """``left LEFT JOIN right`` for a right side whose keys may be hot.

    AQE splits skewed partitions of a left outer join on the left side only,
    so a customer holding a third of the right side's rows would be joined by
    a single task.  The right side is therefore asked for its heavy keys; as a
    rule there is none, and the join is a plain left join.  Rows of heavy
    keys are joined apart: the right rows are dealt to parts by the hash of
    the whole row, the left rows are copied to every part, and the two are
    inner-joined on key and part (a heavy key has right rows, so no left row
    is lost; AQE may still split what equal rows have left uneven).  ``left`` is
    written only in that case, because both joins read it.  Column names of
    the two sides must not overlap; the result has the columns of
    ``left.join(right, ..., "left")``.
    """
    ((lk, rk),) = [on] if isinstance(on, tuple) else on
    heavy = heavy_keys(right, rk, factor, least_rows)
    if not heavy:
        return left.join(right, left[lk] == right[rk], "left")
    left = reuse(left)
    # the map's keys have the right key's type
    kind = right.schema[rk].dataType
    l_parts, r_parts = _parts(F.col(lk).try_cast(kind), heavy), _parts(F.col(rk), heavy)
    cold = left.filter(l_parts.isNull()).join(right.filter(r_parts.isNull()), F.col(lk) == F.col(rk), "left")
    copies = left.withColumn("__part", F.explode(F.sequence(F.lit(0), l_parts - 1)))        # null parts: no row
    dealt = right.filter(r_parts.isNotNull()).withColumn(
        "__dealt", F.pmod(F.xxhash64(*[F.col(c) for c in right.columns]), r_parts).cast("int"))
    hot = copies.join(dealt, (F.col(lk) == F.col(rk)) & (F.col("__part") == F.col("__dealt")), "inner").drop("__part", "__dealt")
    return cold.unionByName(hot)
