"""Source divergence audit: how far the sources of a language lie apart in their words.

1. Identical texts of a language are collapsed: rows are counted by language,
   text digest and source first, and only one copy of each text is shuffled
   (:func:`distinct_texts`).
2. Each distinct text is tokenised once; its term counts are added to every
   source that holds it, times the copies there, and its terms to the
   language's document frequency, times all its copies (:func:`term_counts`).
3. Terms of enough documents are kept with their postings, the sources they
   occur in (:func:`postings`).  Smoothed shares are exact integers (decimal
   arithmetic, floor division).
4. Pairs are evaluated sparsely (:func:`pair_distances`).  A source gives every
   term it lacks the same base share, so the distance of two sources is that of
   their bases on all terms, corrected for the terms of either one by a histogram
   of its shares, and for the terms of both through the postings.

Defined cases: null text, language and source count as the empty string; a
group without kept terms has base shares only, and distance 0 where the
language keeps no term; a language of one source has no pairs; repeated rows
count as documents of their own; ties are broken by the item's UTF-8 bytes; an
empty table gives no rows; a very long text is tokenised whole, in a batch of
its own; extra columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import deploy, store

# What lies between two terms: terms are runs of ASCII letters and of all characters beyond ASCII.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SLICE_BYTES = 8 << 20
HELD_ROWS = 500_000


def distinct_texts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, text, held)``: each text of a language once, ``held`` = its copies as ``[(source, n)]``.

    The copies are counted before they are shuffled, by digest; a text that many
    rows share leaves each task once.
    """
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), empty(text_col).alias("text")).withColumn(
        "digest", F.unhex(F.sha2("text", 256)))
    copies = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    held = copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("held"))    # at most one entry a source
    texts = rows.select("lang", "digest", "text").dropDuplicates(["lang", "digest"])
    return texts.join(held, ["lang", "digest"]).select("lang", "text", "held")


def _summed(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the exact sums of their weights."""
    if not len(keys):
        return keys, *weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], *[np.add.reduceat(w[order], first) for w in weights]


def _count(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``(lang, source, term, n, df)`` of some distinct texts: occurrences in the source, and the documents of the
    texts that the source is the first holder of, so that a term's ``df`` adds up to its documents in the language."""
    text, held = batch.column("text"), batch.column("held")
    parts = pc.split_pattern_regex(pc.ascii_lower(text), BETWEEN)
    owner = np.repeat(np.arange(len(text)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    coded = parts.flatten().dictionary_encode()
    terms, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(terms, "").to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
    n_terms = max(len(terms), 1)
    pairs, n = np.unique(owner[real] * n_terms + code[real], return_counts=True)
    doc, term = pairs // n_terms, pairs % n_terms                              # each text's terms, once
    langs = batch.column("lang").dictionary_encode()
    lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    holders = pc.list_value_length(held).to_numpy(zero_copy_only=False).astype(np.int64)
    cells = held.flatten()
    sources = cells.field("source").dictionary_encode()
    source = sources.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    copies = cells.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(holders) - holders
    in_all = np.add.reduceat(copies, start) if len(copies) else np.zeros(0, np.int64)     # every text has a holder
    times = holders[doc]
    row = np.repeat(np.arange(len(doc)), times)
    cell = start[doc][row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    n_sources = max(len(sources.dictionary), 1)
    first = np.where(cell == start[doc][row], in_all[doc][row], 0)
    key, count, df = _summed((lang[doc][row] * n_sources + source[cell]) * n_terms + term[row], n[row] * copies[cell], first)
    group = key // n_terms
    return pa.record_batch({
        "lang": langs.dictionary.take(pa.array(group // n_sources)), "source": sources.dictionary.take(pa.array(group % n_sources)),
        "term": terms.take(pa.array(key % n_terms)), "n": pa.array(count, pa.int64()), "df": pa.array(df, pa.int64())})


def _combined(parts: list[pa.RecordBatch]) -> pa.Table:
    """The parts' counts added up by language, source and term."""
    table = pa.Table.from_batches(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("df", "sum")])
    return table.select(["lang", "source", "term", "n_sum", "df_sum"]).rename_columns(["lang", "source", "term", "n", "df"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts, combined as they come; at most about ``2 * HELD_ROWS`` rows are held."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < batch.num_rows:       # at most SLICE_BYTES of text at once, or one longer text
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE_BYTES, "right")))
            held.append(_count(batch.slice(i, j - i)))
            rows += held[-1].num_rows
            i = j
            if rows > 2 * HELD_ROWS:
                table = _combined(held)
                held, rows = table.to_batches(), table.num_rows
                if rows > HELD_ROWS:
                    yield from held
                    held, rows = [], 0
    if held:
        yield from _combined(held).to_batches(max_chunksize=100_000)


def term_counts(texts: DataFrame) -> DataFrame:
    """``(lang, source, term, n, df)`` over :func:`distinct_texts`; ``df`` adds up over a language's sources.

    Rows are combined in their task, then dealt by language and term, which serves this sum and the
    postings after it: a frequent term brings a task one row for each source and task.
    """
    deploy(texts.sparkSession)
    partial = texts.mapInArrow(_counted, "lang string, source string, term string, n long, df long")
    return partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def postings(counts: DataFrame, min_documents: int) -> DataFrame:
    """``(lang, term, total, held)`` of the terms in at least ``min_documents`` documents of their language."""
    return counts.groupBy("lang", "term").agg(
        F.sum("df").alias("df"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("held")).filter(  # at most one entry a source
        F.col("df") >= min_documents).drop("df")


def share(count: Column, size: Column, smoothing: int, scale: int) -> Column:
    """``1 + floor(scale * (count + smoothing) / size)``, exact."""
    # products of up to 37 digits: a count of 10**18 at a scale of 10**18
    return F.lit(1).cast("long") + F.call_function("div", F.lit(scale).cast("decimal(19,0)") * (count + smoothing).cast("decimal(19,0)"), size.cast("decimal(19,0)"))


def group_sizes(rows: DataFrame, kept: DataFrame, smoothing: int, scale: int) -> DataFrame:
    """``(lang, source, size, lang_size, terms, base)`` of every group; ``size`` = N + smoothing * V, ``base`` the share of a missing term."""
    by_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("all"))
    by_source = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", F.col("h.source").alias("source")).agg(F.sum("h.n").alias("own"))
    empty = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    g = rows.distinct().join(by_lang, "lang", "left").join(by_source, ["lang", "source"], "left").select(
        "lang", "source", (empty("own") + empty("terms") * smoothing).alias("size"),
        (empty("all") + empty("terms") * smoothing).alias("lang_size"), empty("terms").alias("terms"))
    none = F.lit(0).cast("long")
    return g.withColumn("base", F.when(F.col("size") > 0, share(none, F.when(F.col("size") > 0, F.col("size")), smoothing, scale)).otherwise(none))


def pair_distances(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, other, value)`` of all ordered pairs: sum of ``abs(p - q)`` over the language's terms.

    ``cells`` = ``(lang, term, source, p, base)`` for the terms a source has.  The rows
    made are the pairs themselves, a source's distinct shares times the other
    sources, and the pairs of sources within one term's postings.
    """
    far = lambda a, b: F.abs(F.col(a) - F.col(b))
    b = groups.select(F.col("lang").alias("lang2"), F.col("source").alias("other"), F.col("base").alias("other_base"))
    among = lambda df: df.join(b, (F.col("lang") == F.col("lang2")) & (F.col("source") != F.col("other")))
    bases = among(groups).select("lang", "source", "other", (F.col("terms") * far("base", "other_base")).alias("value"))
    shares = cells.groupBy("lang", "source", "base", "p").agg(F.count("*").alias("n"))
    one = among(shares).groupBy("lang", "source", "other").agg(
        F.sum(F.col("n") * (far("p", "other_base") - far("base", "other_base"))).alias("value"))
    lists = cells.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "base"))).alias("held"))
    both = lists.select("lang", "held", F.posexplode("held").alias("i", "a")).select(
        "lang", "a", F.explode(F.slice("held", F.col("i") + 2, F.size("held"))).alias("b"))
    both = both.groupBy("lang", F.col("a.source").alias("source"), F.col("b.source").alias("other")).agg(F.sum(
        far("a.p", "b.p") - far("a.p", "b.base") - far("a.base", "b.p") + far("a.base", "b.base")).alias("value"))
    turned = lambda df: df.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")
    parts = bases.unionByName(one).unionByName(turned(one)).unionByName(both).unionByName(turned(both))
    return parts.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_documents: int = 30, smoothing: int = 5, scale: int = 1_000_000_000, top: int = 50,
          text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` ranks the other sources by distance, part
    ``term`` the ``top`` terms that a source uses beyond its language's share."""
    texts = distinct_texts(docs, text_col, lang_col, source_col)
    kept = store(postings(term_counts(texts), min_documents), "divergence-postings")
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"))
    groups = store(group_sizes(rows, kept, smoothing, scale), "divergence-groups")
    sizes = groups.select("lang", "source", "size", "lang_size", "base")
    flat = kept.select("lang", "term", "total", F.explode("held").alias("h")).select("lang", "term", "total", "h.source", "h.n")
    cells = store(flat.join(sizes, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("size"), smoothing, scale).alias("p"),
        share(F.col("total"), F.col("lang_size"), smoothing, scale).alias("q"), "base"), "divergence-cells")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pair_distances(cells, groups).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    terms = cells.filter(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                                         (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(ranked).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).filter(F.col("rank") <= top))
