"""Token counts by heap-and-linked-list byte-pair merging; no token ids are made.

A text's symbols are its characters (spaces written as the space mark, one
mark put before the text).  The adjacent pair whose merged piece has the best
rank in the vocabulary is merged first, the leftmost of equals; a heap holds
the candidate pairs and a linked list the living symbols.  The count is the
initial symbols minus the merges, plus the extra bytes of characters that have
no piece of their own (byte fallback).

No piece holds a space mark after another character, so a text is merged in
units of marks followed by a word; counts of units are remembered inside a
worker up to ``CACHE`` entries, then forgotten and counted again.

Defined cases: null counts as the empty text, which has no tokens; repeated
rows are each counted; extra columns are ignored.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import deploy

MARK = "▁"
CACHE = 400_000
LONG_UNIT = 80                 # longer units are counted but not remembered


class Units(dict):
    """Unit -> tokens, for units after a given prefix."""

    def __init__(self, counter: MergeCounter, prefix: str):
        super().__init__()
        self.counter, self.prefix = counter, prefix

    def __missing__(self, unit: str) -> int:
        if "\n" in unit and self.counter.newline_alone:
            head, *rest = unit.split("\n")
            bare = self.counter.bare
            n = (self[head] if head or self.prefix else 0) + sum(1 + (bare[r] if r else 0) for r in rest)
        else:
            n = self.counter.merge(self.prefix + unit)
        if len(unit) <= LONG_UNIT:
            if len(self) >= CACHE:
                self.clear()
            self[unit] = n
        return n


class MergeCounter:
    """Counts for one vocabulary: ``rank[piece]``, smaller is merged earlier."""

    def __init__(self, rank: dict[str, float]):
        self.rank = rank
        self.newline_alone = not any("\n" in p for p in rank)
        if any(MARK in p.lstrip(MARK) for p in rank):
            raise ValueError("a piece has a space mark after another character")
        self.after_space, self.bare = Units(self, MARK), Units(self, "")

    @classmethod
    def from_model(cls, path: str) -> MergeCounter:
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path)
        return cls({sp.id_to_piece(i): -sp.get_score(i) for i in range(sp.get_piece_size())
                    if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))})

    def merge(self, symbols: str) -> int:
        rank, n = self.rank, len(symbols)
        piece = list(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 1, 2) for i in range(n - 1) if (r := rank.get(piece[i] + piece[i + 1])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            _, i, j, size = heappop(heap)
            a, b = piece[i], piece[j]
            if not a or not b or len(a) + len(b) != size:
                continue
            merges += 1
            piece[i], piece[j] = a + b, ""
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if (r := rank.get(piece[i] + piece[k])) is not None:
                    heappush(heap, (r, i, k, size + len(piece[k])))
            if (h := left[i]) >= 0 and (r := rank.get(piece[h] + piece[i])) is not None:
                heappush(heap, (r, h, i, len(piece[h]) + size))
        return n - merges + sum(len(p.encode()) - 1 for p in piece if len(p) == 1 and p not in rank)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        parts = text.split(" ")
        units = self.after_space
        if text[0] != " " and text[-1] != " " and "  " not in text:
            return sum(map(units.__getitem__, parts))
        total = marks = 0
        for p in parts:
            marks += 1
            if p:
                if marks == 1:
                    total += units[p]
                else:
                    head, *rest = p.split("\n") if self.newline_alone else [p]
                    total += self.merge(MARK * marks + head) + sum(1 + (self.bare[r] if r else 0) for r in rest)
                marks = 0
        return total + (self.merge(MARK * marks) if marks else 0)


_counters: dict[str, MergeCounter] = {}


def _counter(path: str) -> MergeCounter:
    if path not in _counters:
        _counters[path] = MergeCounter.from_model(path)
    return _counters[path]


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row."""
    deploy(docs.sparkSession)

    def tokens(texts: pa.Array) -> pa.Array:
        counter = _counter(model_path)
        out = []
        for i in range(0, len(texts), 256):                  # few texts as Python strings at a time
            out += [counter.count(t) for t in pc.fill_null(texts.slice(i, 256), "").to_pylist()]
        return pa.array(out, pa.int64())

    return docs.select(
        F.col(id_col), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"),
        arrow_udf(tokens, "long")(F.col(text_col)).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
