"""Quality rules: a threshold table compiled into one Spark projection, built-in functions only.

:func:`with_measures` adds the counts of a whole text (words, code points in
words, symbols, stop words, lines, repeated lines, words in repeated windows);
:func:`verdict` compiles a table of :class:`Rule` rows - a measure, the measure
it is divided by, and bounds - into one boolean column over those counts.
Nothing is shuffled, collected or evaluated in Python: a text is measured where
it is read, with array functions.

Words in repeated windows: the windows of a text are sorted in the row by hash,
window and place; neighbours that are equal give the places of every window
found twice or more, and the words they cover are counted from the gaps
between consecutive places, so overlapping windows count a word once.

Defined cases: a null text counts as the empty text; a text without words has
ratio 0 wherever it would divide by them and fails the base test for its
length; a very long text is one row's arrays, about 100 bytes a word while it
is measured; equal texts get equal results, and repeated rows stay rows of
their own; an empty table gives no rows; extra columns are kept by
:func:`with_measures` and :func:`keep_good`, which read none of them whatever
their names (the measures are in one struct column with a free name).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, fresh

# FIXED VALUES: characters counted as symbols.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3

# FIXED VALUES: common short words of the corpus' languages.
STOP_WORDS = {
    "en": "a an and are as at be but by for from has have he in is it its of on or not that the this to was were which with you",
    "de": "auf aus bei das dem den der des die ein eine einen er es für im in ist mit nicht sich sie sind und von war wird zu",
    "fr": "au avec ce dans de des du elle en est et il la le les mais ne par pas plus pour qui que se son sur un une",
    "es": "al como con de del el en es la las lo los más no o para pero por que se su sus un una y",
}
# Marks that may touch a word at either end without changing it.
_MARKS = ".,;:()\"'"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``low <= measure / per <= high`` for the listed languages (all when empty); ``per`` None: the measure itself."""

    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None
    langs: tuple[str, ...] = ()


# The contract's base test, written as n_words >= 50 and 100 * n_repeat_words <= 50 * n_words.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

RULES: tuple[Rule, ...] = (
    Rule("word length", "word_chars", "n_words", low=2.5, high=12.0),
    Rule("symbols a word", "n_symbols", "n_words", high=0.3),
    # the lists are pooled: a text in another of the four languages than its label says is not rejected for that
    Rule("stop words", "n_stop_words", "n_words", low=0.05, langs=("en", "de", "fr", "es")),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.4),
)


def _repeat_words(words: Column, window: int) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the array."""
    n = F.size(words)
    joined = words
    for k in range(1, window):
        # the shorter array is padded with null, and concat of null is null: the tail has no full window
        joined = F.zip_with(joined, F.slice(words, F.lit(k + 1), n), lambda a, b: F.concat(a, F.lit(" "), b))
    placed = F.filter(F.transform(joined, lambda w, i: F.struct(F.xxhash64(w).alias("h"), w.alias("w"), i.alias("i"))),
                      lambda x: x["w"].isNotNull())
    # let-bindings: a one-element array holds a value that is used more than once
    in_order = F.array(F.sort_array(placed))
    equal = F.transform(in_order, lambda s: F.filter(
        F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.when(
            (a["h"] == b["h"]) & (a["w"] == b["w"]), F.array(a["i"], b["i"]))), lambda x: x.isNotNull()))[0]
    places = F.array(F.sort_array(F.array_distinct(F.flatten(equal))))
    gaps = F.transform(places, lambda p: F.zip_with(
        p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.lit(window), F.coalesce(b - a, F.lit(window)))))[0]
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + x)


def measures(words: Column, lines: Column, text: Column, window: int = WINDOW) -> Column:
    """Struct of :data:`MEASURES` (long) from a text's words and its lines that hold a word."""
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws.split()})
    stops = F.filter(words, lambda w: F.lower(F.btrim(w, F.lit(_MARKS))).isin(stop))
    out = {
        "n_words": F.size(words), "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, "")), "n_stop_words": F.size(stops), "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)), "n_repeat_words": _repeat_words(words, window),
    }
    return F.struct(*[out[m].cast("long").alias(m) for m in MEASURES])


def with_measures(df: DataFrame, column: str, text_col: str = "text") -> DataFrame:
    """``df`` with a struct column of :data:`MEASURES`."""
    text, words, lines = fresh(df, "rule_text", "rule_words", "rule_lines")
    held = df.select("*", F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(text))
    # words and lines are used several times, so Spark keeps this step apart and splits each text once
    split = held.select("*", F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)).alias(words),
                        F.filter(F.split(F.col(text), "\n", -1), lambda x: x.rlike(WORD)).alias(lines))
    return split.withColumn(column, measures(F.col(words), F.col(lines), F.col(text))).drop(text, words, lines)


def base_failed(m: Column) -> Column:
    """Too short, or half of the words or more in repeated windows (exact in integers)."""
    return (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)


def passes(rule: Rule, m: Column, lang: Column | None = None) -> Column:
    """Boolean column of one row of the table (never null)."""
    value = m[rule.measure].cast("double")
    if rule.per:
        value = F.when(m[rule.per] > 0, value / m[rule.per]).otherwise(F.lit(0.0))
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (value >= F.lit(float(rule.low)))
    if rule.high is not None:
        ok = ok & (value <= F.lit(float(rule.high)))
    if rule.langs and lang is not None:
        ok = ok | ~F.coalesce(lang.isin(*rule.langs), F.lit(False))
    return ok


def verdict(rules: Sequence[Rule], m: Column, lang: Column | None = None) -> Column:
    """True where every row of the table holds."""
    ok = F.lit(True)
    for rule in rules:
        ok = ok & passes(rule, m, lang)
    return ok


def failed_rules(rules: Sequence[Rule], m: Column, lang: Column | None = None) -> Column:
    """Names of the rows of the table that do not hold, in the table's order."""
    names = F.array(*[F.when(~passes(r, m, lang), F.lit(r.name)) for r in rules]) if rules else F.array().cast("array<string>")
    return F.filter(names, lambda x: x.isNotNull())


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """One row per document: its measures, base_failed, kept, and the names of the rules it fails."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    m = F.col("m")
    return with_measures(rows, "m").select(
        F.col("id").alias(id_col), *[m[x].alias(x) for x in MEASURES], base_failed(m).alias("base_failed"),
        (~base_failed(m) & verdict(rules, m, F.col("lang"))).alias("kept"),
        failed_rules(rules, m, F.col("lang")).alias("failed_rules"))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns unchanged."""
    (m,) = fresh(docs, "rule_measures")
    return with_measures(docs, m, text_col).filter(
        ~base_failed(F.col(m)) & verdict(rules, F.col(m), F.col(f"`{lang_col}`"))).select(*[F.col(f"`{c}`") for c in docs.columns])
