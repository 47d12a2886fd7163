"""Quality classifier: a sparse ensemble of rules over text statistics.

1. :func:`with_statistics` measures every whole text (:data:`STATISTICS`).
2. :func:`fit` grows a random forest of shallow trees on the labelled rows,
   takes every path from a root as a conjunctive rule over the statistics and
   fits a logistic regression with an L1 penalty (lasso) over the rules'
   indicators; rules with weight zero are dropped.  Both fits are distributed.
3. :meth:`RuleModel.score` compiles the kept rules into one Spark column
   expression, so scoring is a projection without Python.

Defined cases: a null text counts as the empty text and is scored like any
other; null labels are not learned from; repeated rows are each scored; with
no usable labels, or labels of one class, the score is the share of label 1
(0.5 without labels).  Extra columns are kept and never read; a column of
theirs that has a name of this operator is not overwritten.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import Text, deploy, fresh, store, trim

STATISTICS = [
    "chars", "words", "lines", "word_length", "upper", "digits", "marks", "symbols", "bangs", "pipes",
    "non_ascii", "symbol_words", "bang_words", "pipe_words", "number_words", "upper_words", "distinct_words",
    "top_word", "repeated_next", "repeated_lines", "words_per_line",
]

# byte classes: lower-case and other letters, A-Z, digits, space, newline, ! , | , symbols, marks, UTF-8 lead, UTF-8 rest
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x41:0x5B] = 1
_CLASS[0x30:0x3A] = 2
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 3
_CLASS[0x0A] = 4
_CLASS[ord("!")] = 5
_CLASS[ord("|")] = 6
_CLASS[np.frombuffer(b"#$%&*@^~<>{}[]=+\\_/`", np.uint8)] = 7
_CLASS[np.frombuffer(b".,;:?'\"()-", np.uint8)] = 8
_CLASS[0xC0:] = 9
_CLASS[0x80:0xC0] = 10
_N = 11


def _repeats(text: Text, owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct segments, and occurrences of its most frequent one."""
    if len(h) == 0:
        return np.zeros(text.n), np.zeros(text.n)
    key = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    run = np.diff(np.append(first, len(key)))
    who = (key[first] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(text.n)
    np.maximum.at(top, who, run)
    return np.bincount(who, minlength=text.n).astype(float), top


def _measure(text: Text) -> np.ndarray:
    n, lens = text.n, np.diff(text.offsets)
    cls = _CLASS[text.data]
    counts = np.bincount(np.repeat(np.arange(n, dtype=np.int64) * _N, lens) + cls, minlength=n * _N).reshape(n, _N)
    chars = (lens - counts[:, 10]).astype(float)
    starts, ends, owner = text.words()
    words = text.per_text(owner).astype(float)
    h = text.hashes(starts, ends)
    inside = np.zeros((7, len(starts)))
    if len(starts):
        for k, c in enumerate((1, 2, 5, 6, 7)):
            inside[k] = np.add.reduceat((cls == c).astype(np.int32), starts)    # up to the next word: spaces count nothing
        inside[5] = ends - starts
    share = lambda mask: text.per_text(owner, mask.astype(float)) / np.maximum(words, 1)
    distinct, top = _repeats(text, owner, h)
    same = np.zeros(len(h))
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    ls, le, lo = text.lines()
    lines = text.per_text(lo).astype(float)
    line_distinct, _ = _repeats(text, lo, text.hashes(ls, le))
    d = np.maximum(chars, 1)
    return np.stack([
        chars, words, lines, (chars - counts[:, 3] - counts[:, 4]) / np.maximum(words, 1),
        counts[:, 1] / d, counts[:, 2] / d, counts[:, 8] / d, counts[:, 7] / d, counts[:, 5] / d, counts[:, 6] / d,
        counts[:, 9] / d, share(inside[4] >= 2), share(inside[2] >= 1), share(inside[3] >= 1),
        share(inside[1] >= 1), share(inside[0] >= 2), distinct / np.maximum(words, 1), top / np.maximum(words, 1),
        share(same), 1 - line_distinct / np.maximum(lines, 1), words / np.maximum(lines, 1),
    ])


def text_statistics(texts: pa.Array) -> pa.Array:
    """One array of :data:`STATISTICS` for each text."""
    text = Text.of(texts)
    parts = [_measure(t) for _, _, t in text.slices()] or [np.zeros((len(STATISTICS), 0))]
    flat = np.ascontiguousarray(np.concatenate(parts, axis=1).T).ravel()
    trim()
    return pa.ListArray.from_arrays(pa.array(np.arange(text.n + 1, dtype=np.int32) * len(STATISTICS)), pa.array(flat))


def with_statistics(df: DataFrame, column: str, text_col: str = "text") -> DataFrame:
    deploy(df.sparkSession)
    return df.withColumn(column, arrow_udf(text_statistics, "array<double>")(F.col(text_col)))


Condition = tuple[int, bool, float]          # statistic, "at most" (else "above"), threshold


@dataclass(frozen=True)
class RuleModel:
    """Kept rules with their weights; ``score`` is a column expression over a statistics array."""

    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def logit(self, stats: Column) -> Column:
        total = F.lit(float(self.intercept))
        for conditions, weight in self.rules:
            total = total + F.when(_holds(stats, conditions), F.lit(float(weight))).otherwise(F.lit(0.0))
        return total

    def score(self, stats: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.logit(stats)))

    def describe(self) -> list[str]:
        return [f"{w:+.3f}  " + " and ".join(f"{STATISTICS[i]} {'<=' if at_most else '>'} {t:.6g}"
                                             for i, at_most, t in c) for c, w in self.rules]


def _holds(stats: Column, conditions: tuple[Condition, ...]) -> Column:
    out = None
    for i, at_most, t in conditions:
        one = (stats[i] <= F.lit(t)) if at_most else (stats[i] > F.lit(t))
        out = one if out is None else out & one
    return out


def _paths(node, before: dict, out: set) -> None:
    """Every path of a tree as a rule: per statistic and side, the tightest threshold."""
    if before:
        out.add(tuple(sorted((i, m, t) for (i, m), t in before.items())))
    if node.getClass().getSimpleName() != "InternalNode":
        return
    i, t = node.split().featureIndex(), float(node.split().threshold())
    for at_most, child in ((True, node.leftChild()), (False, node.rightChild())):
        old = before.get((i, at_most))
        tight = t if old is None else (min(old, t) if at_most else max(old, t))
        _paths(child, {**before, (i, at_most): tight}, out)


def tree_rules(forest) -> list[tuple[Condition, ...]]:
    """Rules of a fitted forest, each once, in a fixed order."""
    rules: set = set()
    for tree in forest.trees:
        _paths(tree._java_obj.rootNode(), {}, rules)
    return sorted(rules, key=lambda r: (len(r), r))


def fit(labelled: DataFrame, stats_col: str, label_col: str, trees: int = 16, depth: int = 3,
        penalty: float = 5e-4, seed: int = 11) -> RuleModel:
    """Learn from every row of ``labelled`` whose label is 0 or 1."""
    rows = store(labelled.select(F.col(stats_col).alias("s"), F.col(label_col).cast("double").alias("y"))
                 .filter(F.col("y").isin(0.0, 1.0) & F.col("s").isNotNull()), "quality-train")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if n == 0 or ones in (0, n):
        p = min(max((ones / n) if n else 0.5, 1e-3), 1 - 1e-3)
        return RuleModel(float(np.log(p / (1 - p))))
    train = rows.select("y", array_to_vector("s").alias("v"))
    forest = RandomForestClassifier(featuresCol="v", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed,
                                    featureSubsetStrategy="0.5", subsamplingRate=0.6, maxBins=48).fit(train)
    rules = tree_rules(forest)
    if not rules:
        return RuleModel(float(np.log(ones / (n - ones))))
    indicators = F.array(*[_holds(F.col("s"), r).cast("double") for r in rules])
    lasso = LogisticRegression(featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=penalty, maxIter=60,
                               standardization=True).fit(
        store(rows.select("y", indicators.alias("a")), "quality-rules").select("y", array_to_vector("a").alias("x")))
    weights = lasso.coefficients.toArray()
    kept = [(r, float(w)) for r, w in zip(rules, weights) if w != 0.0]
    return RuleModel(float(lasso.intercept), kept)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 5 is 0: never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(measured: DataFrame, labels: DataFrame, stats_col: str, label: str, id_col: str = "doc_id") -> DataFrame:
    """Measured rows with a label, without the held-out ones."""
    own = labels.select(F.col(id_col).alias("__id"), F.col(label).alias("__label")).filter(
        F.col("__label").isNotNull() & F.col("__id").isNotNull() & ~held_out(F.col("__id"))).distinct()
    return measured.join(own, measured[id_col] == own["__id"], "inner")


def reject_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` whose score is at least ``threshold``, with their columns unchanged."""
    stats, score = fresh(docs, "quality_stats", "quality_score")
    # only ids and statistics meet the labels: no text is shuffled
    measured = with_statistics(docs.select("doc_id", "text"), "__stats").drop("text")
    model = fit(training_rows(measured, labels, "__stats", "quality"), "__stats", "__label")
    scored = with_statistics(docs, stats).withColumn(score, model.score(F.col(stats)))
    return scored.filter(F.col(score) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    measured = store(with_statistics(docs.select("doc_id", "text"), "__stats").drop("text"), "quality-stats")
    model = fit(training_rows(measured, labels, "__stats", "quality"), "__stats", "__label")
    return measured.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("__stats")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
