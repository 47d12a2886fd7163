"""Bounded-space online best-fit packing of tokenised documents into sequences.

:func:`token_pieces` turns each whole text into token ids and cuts only
documents longer than the sequence into full pieces and a rest.
:class:`BestFit` places lengths as they come: a bitset over free space finds
the open bin with the least room that still fits; at most ``open_bins`` are
open, and when another one is needed the fullest closes first.  :func:`pack`
deals the pieces (not their ids) by hash to packers whose number follows the
number of pieces, so no task sees more than about ``PIECES_PER_PACKER`` of them;
each packer works on its own stream, in a fixed order, and wastes at most its
last few bins.

Defined cases: null counts as the empty text, whose only id is the end id;
repeated rows are documents of their own; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Text, deploy, fresh, store, trim

PIECES_PER_PACKER = 40_000
UNIT_CACHE = 300_000           # distinct units that a worker remembers

# byte classes after folding A-Z: 0 white space, 1 a-z, 2 digits and marks other than ', 3 the rest (' and bytes from 0x80 on)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[0x61:0x7B] = 1
_CLASS[0x80:] = 3
_CLASS[ord("'")] = 3


def units(text: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each unit, and whether it is letters only, in folded bytes.

    A unit is a run between white space, also cut between a letter (a-z or one
    of U+00C0..U+00FF but the signs U+00D7 and U+00F7) and a digit or mark other
    than the apostrophe.  The tokenizer's pattern always splits there, so a
    text's ids are the ids of its units in order.
    """
    data = text.data
    cls = _CLASS[data]
    if len(data) > 1:
        lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        cls[lead] = cls[lead + 1] = 1
    inside = cls != 0
    cut = np.zeros(len(data) + 1, bool)                      # a unit may not go on over this place
    cut[text.offsets] = True
    cut[1:-1] |= (cls[1:] != cls[:-1]) & ((cls[1:] | cls[:-1]) == 3) & (cls[1:] != 3) & (cls[:-1] != 3)
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    owner = np.searchsorted(text.offsets, starts, "right") - 1
    letters = np.add.reduceat((cls != 1) & inside, starts) == 0 if len(starts) else np.zeros(0, bool)
    if len(starts):                                          # reduceat runs to the next start: only white space lies between
        letters &= cls[starts] == 1
    return starts, ends, owner, letters


class UnitIds:
    """Ids of units as the library gives them, remembered by the unit's 64-bit hash.

    A batch asks once for each distinct unit.  New units of letters are one
    word of the vocabulary each, so they go to the library in one call, and
    the word-end mark of their last id parts them again.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.is_end = np.zeros(tokenizer.get_vocab_size(), bool)
        self.is_end[[i for t, i in tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _add(self, key: int, ids: np.ndarray) -> None:
        k = len(self.slot)
        if k == len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[k], self.length[k] = self.used, len(ids)
        self.used += len(ids)
        self.slot[key] = k

    def _learn(self, keys: list[int], raw: list[bytes], letters: list[bool]) -> None:
        words = [(k, w.decode()) for k, w, x in zip(keys, raw, letters) if x]
        for i in range(0, len(words), 4096):
            part = words[i:i + 4096]
            ids = self.library(" ".join(w for _, w in part))
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(part):
                raise ValueError("words and word ends differ")
            for (k, _), a, b in zip(part, np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):
                self._add(k, ids[a:b])
        for k, w, x in zip(keys, raw, letters):
            if not x:
                self._add(k, self.library(w.decode()))

    def _plain(self, text: Text) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        starts, ends, owner, letters = units(text)
        distinct, first, which = np.unique(text.hashes(starts, ends), return_index=True, return_inverse=True)
        if len(self.slot) + len(distinct) > UNIT_CACHE:
            self.forget()
        keys = distinct.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.slot]
        at = first[new]
        raw = text.data.tobytes() if new else b""
        self._learn([keys[i] for i in new], [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())], letters[at].tolist())
        slots = np.fromiter((self.slot[k] for k in keys), np.int64, len(keys))[which]
        lens = self.length[slots]
        total = int(lens.sum())
        place = np.repeat(self.start[slots] - (np.cumsum(lens) - lens), lens) + np.arange(total)
        return self.flat[place], np.bincount(owner, lens, text.n).astype(np.int64)

    def texts(self, array: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text.  Texts that may hold special strings go to the library whole."""
        for _, _, part in Text.of(array).slices():
            raw = part.data.tobytes()
            odd = [i for i in range(part.n) if b"<|" in raw[part.offsets[i]:part.offsets[i + 1]]] if b"<|" in raw else []
            folded = Text(_FOLD[part.data], part.offsets)
            ids, counts = self._plain(folded)
            borders = np.concatenate([[0], np.cumsum(counts)])
            special = set(odd)
            for i in range(part.n):
                yield (self.library(raw[part.offsets[i]:part.offsets[i + 1]].decode()) if i in special
                       else ids[borders[i]:borders[i + 1]])


_known: dict[str, UnitIds] = {}


def _unit_ids(path: str) -> UnitIds:
    if path not in _known:
        from tokenizers import Tokenizer
        _known[path] = UnitIds(Tokenizer.from_file(path))
    return _known[path]


def _cut(batches: Iterator[pa.RecordBatch], path: str, length: int, end_id: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    end = np.array([end_id], "<u4")
    for batch in batches:
        row, piece, starts, lens, crc = [], [], [], [], []
        for i, ids in enumerate(_unit_ids(path).texts(batch.column(1))):
            raw = np.concatenate([ids.astype("<u4"), end]).tobytes()
            n = len(raw) // 4
            for k, start in enumerate(range(0, n, length)):
                part = raw[4 * start:4 * (start + length)]
                row.append(i)
                piece.append(k)
                starts.append(start)
                lens.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        cells = [batch.column(0).take(pa.array(row, pa.int32())), piece, starts, lens, crc]
        trim()
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cells, schema)], schema=schema)


def token_pieces(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids_crc32)``: each document's ids and the end id, cut at ``length``."""
    deploy(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_col)
    schema = pa.schema([(id_col, pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    return rows.mapInArrow(lambda it: _cut(it, tokenizer_path, length, end_id, schema),
                           f"`{id_col}` long, piece int, start long, length long, ids_crc32 long")


class BestFit:
    """Online best-fit with a bounded number of open bins."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.limit = capacity, open_bins
        self.bits = 0                                        # bit f is set: some open bin has f units free
        self.by_free: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
            del self.by_free[free]
        self.open -= 1
        return b

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of one piece of at most ``capacity`` units."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if self.open >= self.limit:                      # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            b, free = self.made, self.capacity
            self.made += 1
        rest = free - size
        if rest:
            self.by_free.setdefault(rest, []).append(b)
            self.bits |= 1 << rest
            self.open += 1
        return b, self.capacity - free


def _place(batches: Iterator[pa.RecordBatch], length: int, open_bins: int, packer: str, size: str,
           out: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    now, fit = None, None
    for batch in batches:
        seq, off = [], []
        for p, n in zip(batch.column(packer).to_pylist(), batch.column(size).to_pylist()):
            if p != now:                                     # a task may hold several packers, one after the other
                now, fit = p, BestFit(length, open_bins)
            b, o = fit.place(n)
            seq.append((p << 40) | b)
            off.append(o)
        keep = [n for n in batch.schema.names if n != packer]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                                         [*keep, *out])


def pack(pieces: DataFrame, length: int = 4096, open_bins: int = 4096, size_col: str = "length",
         per_packer: int = PIECES_PER_PACKER) -> DataFrame:
    """Every row of ``pieces`` with its ``sequence_id`` and ``offset``.

    ``size_col`` holds 1 to ``length``.  Rows are placed in the order of a hash
    of all their columns, so a run on the same rows gives the same sequences.
    """
    packer, order, seq, off = fresh(pieces, "packer", "pack_order", "sequence_id", "offset")
    rows = store(pieces.withColumn(order, F.xxhash64(*[F.col(f"`{c}`") for c in pieces.columns])), "pieces")
    packers = max(1, -(-rows.count() // per_packer))
    dealt = rows.withColumn(packer, F.pmod(F.xxhash64(order, F.lit(7)), F.lit(packers)))
    own = [F.col(f"`{c}`") for c in pieces.columns]
    lined = dealt.repartition(packers, packer).sortWithinPartitions(packer, order).select(*own, packer)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields] + [f"`{seq}` bigint", f"`{off}` bigint"])
    return lined.mapInArrow(lambda it: _place(it, length, open_bins, packer, size_col, (seq, off)), schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = 4096, open_bins: int = 4096, end_id: int = 1) -> DataFrame:
    return pack(token_pieces(docs, tokenizer_path, length, end_id), length, open_bins)
