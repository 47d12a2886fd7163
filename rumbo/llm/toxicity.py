"""Toxicity severity by cumulative-link ordinal regression over sparse text features.

Model: ``P(grade <= k) = sigmoid(theta_k - w . x)`` with one weight vector for
all ordered thresholds ``theta_0 < theta_1 < ...``; the output is the expected
grade ``sum_k P(grade > k)``.

Features: lower-cased words and word beginnings of :data:`STEMS` letters; ``x``
is ``log(1 + count)`` of each term of the vocabulary, the terms of the training
rows with the most evidence for or against the label (log-likelihood ratio of
their occurrences, at most ``CAP`` of them counted in a row).

Choice of the vocabulary's size, the penalty and the threshold: by
:data:`FOLDS` folds inside the training rows.  Each fold ranks terms and fits
weights without its own rows and links them; the pair of :data:`GRID` with
the fewest errors (then the least log loss) is taken, and all thresholds are moved
so that the cut with the fewest errors on those links is a probability of 0.5.

Grades: labels say only whether a document is toxic, so toxic rows are graded
1 to 3 by how many occurrences of cue terms they hold (vocabulary words that are at
least ``e^3`` times as frequent among toxic rows); clean rows are grade 0.  The
grades 1 to 3 are thus counts of features, not judgements: the order of severities
is evidence of how much of the learned wording a text holds, and only grade 0
against the rest is held against labels.

Learning uses a bounded sample of labelled rows, at most ``rows_per_class`` of
each label in hash order (held-out rows never), one text for each labelled id;
their sparse rows are collected to fit the weights, and folds use the first
``2 * choice_rows`` of them.  Scoring covers the whole text of every row.

Defined cases: null counts as the empty text, which scores like a text without
known terms; a very long text is read whole, word by word; without rows of both
labels nothing is called toxic (severity 0); of several texts with one labelled id
the greatest is learned from, of equal hashes in the sample the smaller id; of equal evidence the
first term by code point; an empty table gives no rows; repeated rows
are each scored; extra columns are kept and not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import deploy, fresh, store, trim
from .quality import held_out

STEMS = (4, 5, 6)
CAP = 3
FOLDS = 5
# vocabulary size and penalty
GRID = ((50, 1e-3), (100, 3e-4), (200, 1e-3), (400, 1e-4))
_LETTERS = re.compile(r"[^\W\d_]+")


def terms_of(text: str) -> dict[str, int]:
    """Words of a text and their beginnings (marked ``*``), with counts."""
    found: dict[str, int] = {}
    for word in _LETTERS.findall(text.lower()):
        found[word] = found.get(word, 0) + 1
        for k in STEMS:
            if len(word) > k:
                t = word[:k] + "*"
                found[t] = found.get(t, 0) + 1
    return found


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of the terms and the ordered thresholds."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def link(self, text: str) -> float:
        """w . x of one text."""
        found: dict[str, int] = {}
        weights, stems = self.weights, self._stems
        for word in _LETTERS.findall(text.lower()):
            if word in weights:
                found[word] = found.get(word, 0) + 1
            for k in STEMS:
                if len(word) > k and word[:k] in stems:
                    t = word[:k] + "*"
                    found[t] = found.get(t, 0) + 1
        return sum(weights[t] * np.log1p(c) for t, c in found.items())

    @property
    def _stems(self) -> frozenset:
        if "_s" not in self.__dict__:
            object.__setattr__(self, "_s", frozenset(t[:-1] for t in self.weights if t.endswith("*")))
        return self.__dict__["_s"]

    def above(self, link: Column, grade: int) -> Column:
        """P(severity > grade)."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(float(self.thresholds[grade])) - link))

    def severity(self, link: Column) -> Column:
        out = F.lit(0.0)
        for k in range(len(self.thresholds)):
            out = out + self.above(link, k)
        return out


def link_column(model: OrdinalModel, text: Column) -> Column:
    deploy()

    def ordinal_link(texts: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(texts), 256):
            out += [model.link(t) for t in pc.fill_null(texts.slice(i, 256), "").to_pylist()]
        trim()
        return pa.array(out, pa.float64())

    return arrow_udf(ordinal_link, "double")(text)


def term_counts(texts: pa.Array) -> pa.Array:
    """Terms of each text as ``array<struct<t: string, n: int>>``."""
    kind = pa.list_(pa.struct([("t", pa.string()), ("n", pa.int32())]))
    parts = []
    for i in range(0, len(texts), 64):            # few texts' terms are Python objects at a time
        terms, counts, offsets = [], [], [0]
        for text in pc.fill_null(texts.slice(i, 64), "").to_pylist():
            found = terms_of(text)
            terms += found
            counts += found.values()
            offsets.append(len(terms))
        cells = pa.StructArray.from_arrays([pa.array(terms, pa.string()), pa.array(counts, pa.int32())], ["t", "n"])
        parts.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells))
    out = pa.chunked_array(parts, kind).combine_chunks() if parts else pa.array([], kind)
    del parts
    trim()
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit_ordinal(row: np.ndarray, col: np.ndarray, val: np.ndarray, y: np.ndarray, features: int,
                grades: int, penalty: float = 1e-4, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by full-batch gradient steps (Adam) on the sparse rows.

    Thresholds are theta_0 and positive gaps, so they stay in order.
    """
    n = len(y)
    share = np.array([(y <= k).mean() for k in range(grades - 1)]).clip(1e-4, 1 - 1e-4)
    start = np.log(share / (1 - share))
    p = np.concatenate([np.zeros(features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, theta = p[:features], np.cumsum(np.concatenate([p[features:features + 1], np.exp(p[features + 1:])]))
        z = np.bincount(row, val * w[col], minlength=n)
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = sigmoid(edges[y + 1] - z), sigmoid(edges[y] - z)
        prob = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi) / prob, lo * (1 - lo) / prob        # derivatives of log prob by the upper and lower edge
        gw = np.bincount(col, val * (dhi - dlo)[row], minlength=features) / n + penalty * w
        ge = (np.bincount(y, dlo, minlength=grades)[1:] - np.bincount(y, dhi, minlength=grades)[:-1]) / n
        tail = np.cumsum(ge[::-1])[::-1]                             # a gap moves every later threshold
        g = np.concatenate([gw, tail[:1], tail[1:] * np.exp(p[features + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return p[:features], np.cumsum(np.concatenate([p[features:features + 1], np.exp(p[features + 1:])]))


@dataclass(frozen=True)
class _Rows:
    """Sparse training rows: ``col`` indexes ``terms``; ``fold`` of each row."""

    y: np.ndarray
    fold: np.ndarray
    row: np.ndarray
    col: np.ndarray
    n: np.ndarray


def _fit_on(rows: _Rows, use: np.ndarray, vocabulary: np.ndarray, cue: np.ndarray, cuts: tuple[int, ...],
            penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights by column (zero outside the vocabulary) and thresholds, from the rows ``use`` marks."""
    place = np.full(len(cue), -1)
    place[vocabulary] = np.arange(len(vocabulary))
    at = np.cumsum(use) - 1
    mine = use[rows.row] & (place[rows.col] >= 0)
    cues = np.bincount(at[rows.row[mine]], (rows.n * cue[rows.col])[mine], minlength=int(use.sum()))
    grade = rows.y[use] * (1 + sum((cues >= c).astype(np.int64) for c in cuts))
    w, theta = fit_ordinal(at[rows.row[mine]], place[rows.col[mine]], np.log1p(rows.n[mine]), grade, len(vocabulary), len(cuts) + 2,
                           penalty, steps=200)
    out = np.zeros(len(cue))
    out[vocabulary] = w
    return out, theta


def _links(rows: _Rows, w: np.ndarray, theta: np.ndarray) -> np.ndarray:
    return np.bincount(rows.row, np.log1p(rows.n) * w[rows.col], minlength=len(rows.y)) - theta[0]


def best_cut(z: np.ndarray, y: np.ndarray) -> tuple[int, float]:
    """Fewest errors of ``z >= cut`` against ``y``, and the middle of the cuts that reach it."""
    order = np.argsort(z, kind="stable")
    zs, ys = z[order], y[order]
    # errors of a cut before the i-th value: label 1 below it, label 0 from it on
    errors = np.concatenate(([0], np.cumsum(ys))) + (len(ys) - ys.sum()) - np.concatenate(([0], np.cumsum(1 - ys)))
    cuts = (zs[1:] + zs[:-1]) / 2
    inner = errors[1:-1]
    ok = np.flatnonzero((inner == inner.min()) & (np.diff(zs) > 0))
    return (int(inner[ok[len(ok) // 2]]), float(cuts[ok[len(ok) // 2]])) if len(ok) else (int(min(ys.sum(), len(ys) - ys.sum())), 0.0)


def choose(rows: _Rows, ranked: list[np.ndarray], cues: list[np.ndarray], cuts: tuple[int, ...]) -> tuple[int, float, float]:
    """Vocabulary size, penalty and cut of the links by folds; ``ranked[f]``: columns by their evidence outside fold ``f``."""
    best = None
    for size, penalty in GRID:
        z = np.zeros(len(rows.y))
        for f in range(FOLDS):
            out = rows.fold == f
            if out.any() and 0 < rows.y[~out].sum() < (~out).sum():
                z[out] = _links(rows, *_fit_on(rows, ~out, ranked[f][:size], cues[f], cuts, penalty))[out]
        errors, cut = best_cut(z, rows.y)
        loss = float(np.logaddexp(0, -z * (2 * rows.y - 1)).mean())
        if best is None or (errors, loss) < best[0]:
            best = (errors, loss), (size, penalty, cut)
    return best[1]


def _sample(docs: DataFrame, labels: DataFrame, rows_per_class: int, label: str, held: Column | None = None) -> DataFrame:
    """``(r, y, fold, terms)`` of the training rows: one text for each id of a bounded sample of the labels."""
    from pyspark.sql import Window
    own = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y")).filter(
        F.col("__id").isNotNull() & F.col("__y").isin(0, 1) & ~(held_out(F.col("__id")) if held is None else held)).distinct()
    pick = Window.partitionBy("__y").orderBy(F.xxhash64("__id", F.lit(5)), "__id")
    sample = store(own.withColumn("__n", F.row_number().over(pick)).filter(F.col("__n") <= rows_per_class), "toxic-sample")
    deploy(docs.sparkSession)
    # the sample's size is bounded by rows_per_class, so it may be sent to every task
    text = docs.select(F.col("doc_id").alias("__d"), F.col("text").alias("__t")).join(F.broadcast(sample), F.col("__d") == F.col("__id"))
    text = text.groupBy("__id", "__y", "__n").agg(F.max("__t").alias("__t"))
    return store(text.select(F.monotonically_increasing_id().alias("r"), F.col("__y").alias("y"), F.col("__n").alias("n"),
                             F.pmod(F.xxhash64("__id", F.lit(11)), F.lit(FOLDS)).cast("int").alias("fold"),
                             arrow_udf(term_counts, "array<struct<t:string,n:int>>")(F.col("__t")).alias("terms")), "toxic-terms")


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = 3000, choice_rows: int = 1500,
        cuts: tuple[int, ...] = (2, 5), label: str = "toxic", held: Column | None = None) -> OrdinalModel:
    """Learn from at most ``rows_per_class`` labelled rows of each label; folds use at most about ``2 * choice_rows``, in the labels' shares.

    ``held`` marks the rows of ``labels`` that are not learned from, in place of :func:`quality.held_out`.
    """
    train = _sample(docs, labels, rows_per_class, label, held)
    seen = {(int(r["y"]), int(r["fold"])): int(r["count"]) for r in train.groupBy("y", "fold").count().collect()}
    total = lambda y, without: sum(k for (a, f), k in seen.items() if a == y and f != without)
    if not total(1, None) or not total(0, None):
        return OrdinalModel({}, (40.0, 41.0, 42.0))
    flat = train.select("r", "y", "fold", F.col("n").alias("place"), F.explode("terms").alias("c")).select("r", "y", "fold", "place", "c.t", "c.n")
    # the same part of both labels, in hash order, for the choice by folds
    each = {y: total(y, None) for y in (0, 1)}
    part_of = min(1.0, 2 * choice_rows / sum(each.values()))
    last = {y: math.ceil(k * part_of) for y, k in each.items()}
    by_folds = {(int(r["y"]), int(r["fold"])): int(r["count"]) for r in train.filter(
        F.col("n") <= F.when(F.col("y") == 1, last[1]).otherwise(last[0])).groupBy("y", "fold").count().collect()}
    held = F.least("n", F.lit(CAP))
    tally = lambda y, when, name: F.sum(F.when((F.col("y") == y) & when, held).otherwise(0)).alias(name)
    in_all = store(flat.groupBy("t").agg(tally(1, F.lit(True), "a_all"), tally(0, F.lit(True), "b_all")).filter(
        F.col("a_all") + F.col("b_all") >= 3), "toxic-counts")
    some = flat.filter(F.col("place") <= F.when(F.col("y") == 1, last[1]).otherwise(last[0]))
    in_folds = store(some.groupBy("t").agg(*[tally(y, F.col("fold") != f, f"{name}{f}") for f in range(FOLDS) for y, name in ((1, "a"), (0, "b"))]),
                     "toxic-fold-counts")

    def ranked(fold: str, without: int | None) -> DataFrame:
        if without is None:
            pos, neg = each[1], each[0]
        else:
            pos, neg = (max(1, sum(k for (y, f), k in by_folds.items() if y == label_ and f != without)) for label_ in (1, 0))
        a, b = F.col(f"a{fold}"), F.col(f"b{fold}")
        counts = in_all if without is None else in_folds
        part = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
        both = a + b
        llr = part(a, both * pos / (pos + neg)) + part(b, both * neg / (pos + neg))
        odds = F.log((a + 0.5) / (pos + 1.0)) - F.log((b + 0.5) / (neg + 1.0))
        top = counts.filter(both >= 3).select("t", odds.alias("odds"), llr.alias("llr")).orderBy(F.desc("llr"), "t").limit(max(v for v, _ in GRID))
        return top.withColumn("fold", F.lit(-1 if without is None else without))

    every = ranked("_all", None)
    for f in range(FOLDS):
        every = every.unionByName(ranked(str(f), f))
    chosen = every.toPandas().sort_values(["fold", "llr", "t"], ascending=[True, False, True])   # six short lists
    index = {t: i for i, t in enumerate(sorted(set(chosen["t"])))}
    vocab = docs.sparkSession.createDataFrame(list(index.items()) or [("", 0)], "t string, i int")
    cells = flat.join(F.broadcast(vocab), "t").groupBy("r").agg(F.collect_list("i").alias("i"), F.collect_list(F.col("n")).alias("k"))
    got = train.select("r", "y", "n", "fold").join(cells, "r", "left").select("y", "n", "fold", "i", "k").orderBy("y", "n").toPandas()
    lens = got["i"].map(lambda x: 0 if x is None else len(x)).to_numpy(np.int64)
    join = lambda c: np.concatenate([np.asarray(x, np.int64) for x in got[c] if x is not None] or [np.zeros(0, np.int64)])
    rows = _Rows(got["y"].to_numpy(np.int64), got["fold"].to_numpy(np.int64), np.repeat(np.arange(len(got)), lens), join("i"), join("k"))
    order, cue = [], []
    for f in (*range(FOLDS), -1):
        part = chosen[chosen["fold"] == f]
        cols = part["t"].map(index).to_numpy(np.int64)
        marks = np.zeros(max(len(index), 1), bool)
        marks[cols[((part["odds"] >= 3.0) & ~part["t"].str.endswith("*")).to_numpy()]] = True
        order.append(cols)
        cue.append(marks)
    few = got["n"].to_numpy() <= np.where(rows.y == 1, last[1], last[0])
    at = np.cumsum(few) - 1
    part = _Rows(rows.y[few], rows.fold[few], at[rows.row[few[rows.row]]], rows.col[few[rows.row]], rows.n[few[rows.row]])
    size, penalty, cut = choose(part, order, cue, cuts)
    w, theta = _fit_on(rows, np.ones(len(rows.y), bool), order[-1][:size], cue[-1], cuts, penalty)
    terms = list(index)
    return OrdinalModel({terms[i]: float(w[i]) for i in order[-1][:size]}, tuple(float(t) for t in theta + cut))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, model: OrdinalModel | None = None) -> DataFrame:
    """doc_id, held_out, score (P of any toxicity), severity (expected grade), toxic (score >= threshold)."""
    model = fit(docs, labels) if model is None else model
    linked = docs.select("doc_id", link_column(model, F.col("text")).alias("__link"))
    return linked.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.above(F.col("__link"), 0).alias("score"),
                         model.severity(F.col("__link")).alias("severity")).withColumn("toxic", (F.col("score") >= threshold).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that are not toxic, with their columns unchanged."""
    model = fit(docs, labels)
    (link,) = fresh(docs, "toxic_link")
    return docs.withColumn(link, link_column(model, F.col("text"))).filter(
        model.above(F.col(link), 0) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
