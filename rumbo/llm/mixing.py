"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Targets: the total size is shared among the sources by their weights; a source
gives at most ``max_epochs`` times its own size, and the excess goes to the
others by weight until none is above (:func:`targets`).

Selection: a source's complete epochs take every document; the rest of its
target is filled by weighted sampling without replacement: each document draws
an exponential key divided by its quality weight (a hash of seed, id and text
gives the draw, so reruns agree), documents are ordered by key within the
source and their sizes are prefix-summed up to the budget.

The prefix sum is two-level, so a source holding a third of all rows is not
sorted by one task: rows are range-partitioned by source and order key, the partitions'
totals are summed first, and rows are summed one by one only in the partition where a
source's budget ends.  The last order key is the row's number in the written
rows, so repeated rows (same id and text, hence the same draw) are distinct: a budget may end among them, and a
partition holds about ``ROWS_PER_BUCKET`` rows whatever the weights or the copies.

Defined cases: null text has size 0; a null source is a source of its own and
sorts last; a source without words has target 0; of repeated rows as many are taken as the
budget has room for, and it makes no difference which; the last document is
taken if that brings the source nearer to its target; a very long text is counted whole; an empty table
gives no rows; extra columns are never read, and kept by :func:`mixed_documents`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, store

ROWS_PER_BUCKET = 50_000


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.05 to 1: falls with the share of characters that are neither letters, white space nor . , marks."""
    odd = F.length(F.regexp_replace(text, r"[\p{L}\s.,]+", ""))
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 4 * odd / F.greatest(F.length(text), F.lit(1))), F.lit(1.0))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources by code point, null last, take the weights in turn.  With sources
    ordered by cap / weight, one is capped exactly when the level that is left
    after capping all before it lies above its own ratio.
    The windows run over one row per source, not over documents.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    w = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn("r", F.col("cap") / F.col("w"))
    everything = Window.partitionBy()
    before = Window.orderBy("r", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    level = (F.sum("source_size").over(everything) - zero(F.sum("cap").over(before))) / (
        F.sum("w").over(everything) - zero(F.sum("w").over(before)))
    w = w.withColumn("capped", level > F.col("r"))
    free = lambda c: F.sum(F.when(~F.col("capped"), c).otherwise(0.0)).over(everything)
    capped = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)
    rest = (F.sum("source_size").over(everything) - capped) / F.nullif(free(F.col("w")), F.lit(0.0))
    return w.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(
        F.coalesce(F.col("w") * rest, F.lit(0.0))).alias("target"))


def _drawn(df: DataFrame, text: Column, id_col: str, weight: Column, seed: int, h: str, key: str) -> DataFrame:
    draw = (F.pmod(F.col(h), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return df.withColumn(h, F.xxhash64(F.lit(seed), F.col(id_col), text)).withColumn(key, -F.log(draw) / weight)


KEY = ("key", "id", "h")


def _plan(slim: DataFrame, weights: tuple[float, ...], max_epochs: int) -> tuple[DataFrame, DataFrame]:
    """The rows in order, and per source: size, target, epochs, the last order key ``cut`` that the rest of the target
    takes, and how many of the ``cut_n`` rows of that key (id and text) it takes, ``cut_k``."""
    per = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    t = targets(per.select("source", "source_size"), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    s = t.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    s = store(s.select(F.monotonically_increasing_id().alias("sid"), F.col("source").alias("s2"), "source_size", "target", "epochs", "budget"),
              "mix-sources")
    line = F.struct(*KEY, "row")
    rows = int(slim.count())
    placed = slim.join(s.select("sid", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    # the partition number is written with its rows
    placed = store(placed.repartitionByRange(max(1, -(-rows // ROWS_PER_BUCKET)), "sid", *KEY, "row").withColumn("part", F.spark_partition_id()),
                   "mix-ranges")
    totals = placed.groupBy("sid", "part").agg(F.sum("size").alias("total"), F.max(line).alias("last"))
    before = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = store(totals.withColumn("before", F.coalesce(F.sum("total").over(before), F.lit(0))).withColumn(
        "until", F.max("last").over(before)), "mix-parts")
    b = F.broadcast(s.select(F.col("sid").alias("sid2"), "budget"))       # one row per source: its size is known
    reached = parts.join(b, F.col("sid") == F.col("sid2")).filter(F.col("before") < F.col("budget"))
    ends = reached.groupBy("sid").agg(F.max_by(F.struct("part", "before", "until", "budget"), "part").alias("e")).select(
        F.col("sid").alias("sid3"), F.col("e.part").alias("b"), F.col("e.before").alias("taken_before"), F.col("e.until").alias("until"),
        F.col("e.budget").alias("budget"))
    ends = store(ends, "mix-ends")
    inside = placed.join(ends, (F.col("sid") == F.col("sid3")) & (F.col("part") == F.col("b")))
    up_to = Window.partitionBy("sid").orderBy(*KEY, "row").rowsBetween(Window.unboundedPreceding, -1)      # one partition a source
    room = F.col("budget") - F.col("taken_before") - F.coalesce(F.sum("size").over(up_to), F.lit(0))
    fits = inside.withColumn("room", room).filter((F.col("room") > 0) & (F.col("room") * 2 >= F.col("size")))
    # nothing of the last partition fits: everything before it is taken
    cut = ends.join(fits.groupBy("sid").agg(F.max(line).alias("cut")), F.col("sid3") == F.col("sid"), "left").select(
        "sid3", F.coalesce("cut", "until").alias("cut")).filter(F.col("cut").isNotNull())
    cut = store(cut, "mix-cuts")
    same = placed.join(cut, (F.col("sid") == F.col("sid3")) & F.struct(*KEY).eqNullSafe(F.struct(*[F.col(f"cut.{c}") for c in KEY])))
    copies = same.groupBy("sid").agg(F.count("*").alias("cut_n"), F.count_if(F.col("row") <= F.col("cut.row")).alias("cut_k"))
    plan = s.join(cut, F.col("sid") == F.col("sid3"), "left").join(copies.withColumnRenamed("sid", "sid4"), F.col("sid") == F.col("sid4"), "left")
    return placed, store(plan.select("sid", "s2", "source_size", "target", "epochs", "cut", "cut_n", "cut_k"), "mix-plan")


def _slim(docs: DataFrame, weight: Column, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), F.col(f"`{text_col}`").alias("text"),
                       word_count(F.col(f"`{text_col}`")).alias("size"), weight.cast("double").alias("weight"))
    drawn = _drawn(rows, F.col("text"), "id", F.col("weight"), seed, "h", "key")
    return store(drawn.select("id", "source", "size", "h", "key", F.monotonically_increasing_id().alias("row")), "mix-documents")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 2024, weight: Column | None = None,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(id, size, source_size, target, taken)`` for every row."""
    slim = _slim(docs, quality_weight(F.col(f"`{text_col}`")) if weight is None else weight, seed, id_col, text_col, source_col)
    placed, plan = _plan(slim, weights, max_epochs)
    chosen = F.coalesce(F.struct(*KEY, "row") <= F.col("cut"), F.lit(False))
    return placed.withColumnRenamed("sid", "sid1").join(plan, F.col("sid1") == F.col("sid")).select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * (F.col("epochs") + chosen.cast("int"))).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 2024,
                    weight: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix itself: each document as often as it is taken, with its columns unchanged."""
    weight = quality_weight(F.col(f"`{text_col}`")) if weight is None else weight
    _, plan = _plan(_slim(docs, weight, seed, id_col, text_col, source_col), weights, max_epochs)
    h, key, w, n, plan_col = fresh(docs, "mix_hash", "mix_key", "mix_weight", "mix_copies", "mix_plan")
    plan = plan.select(F.struct("*").alias(plan_col))
    of = lambda c: F.col(f"`{plan_col}`.{c}")
    source, own = F.col(f"`{source_col}`"), [F.col(f"`{c}`") for c in docs.columns]
    drawn = _drawn(docs.withColumn(w, weight.cast("double")), F.col(f"`{text_col}`"), f"`{id_col}`", F.col(w), seed, h, key)
    joined = drawn.join(plan, source.eqNullSafe(of("s2")))
    mine = F.struct(F.col(key).alias("key"), F.col(f"`{id_col}`").alias("id"), F.col(h).alias("h"))
    last = F.struct(*[of("cut")[c].alias(c) for c in KEY])
    at_cut = of("cut").isNotNull() & mine.eqNullSafe(last)
    # repeated rows among which a budget ends: one of them stands for those taken
    whole = of("cut").isNotNull() & ((mine < last) | (at_cut & (of("cut_k") == of("cut_n"))))
    copies = joined.withColumn(n, of("epochs") + F.coalesce(whole, F.lit(False)).cast("int"))
    out = _repeated(copies, n, own)
    if plan.filter(of("cut_k") < of("cut_n")).limit(1).count():
        split = joined.filter(at_cut & (of("cut_k") < of("cut_n"))).withColumn(n, of("cut_k"))
        # at most one such group for each source; its rows are equal in id, text and source, not in other columns
        one = split.groupBy(of("sid").alias(h)).agg(F.first(F.struct(*own)).alias(key), F.first(n).alias(n))
        blocks = one.withColumn(w, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / F.lit(ROWS_PER_BUCKET)))))
        size = F.least(F.lit(ROWS_PER_BUCKET).cast("long"), F.col(n) - F.col(w) * ROWS_PER_BUCKET)
        dealt = blocks.withColumn(n, size).repartition(F.col(h), F.col(w))
        out = out.unionByName(_repeated(dealt, n, [F.col(key)[c].alias(c) for c in docs.columns]))
    return out


def _repeated(df: DataFrame, n: str, columns: list[Column]) -> DataFrame:
    """Each row ``n`` times."""
    return df.filter(F.col(n) > 0).withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n).cast("long")))).select(*columns)
