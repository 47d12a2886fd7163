"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: words joined into 4-word shingles, XXH64 of each (seed 42), bit i
is set if it is set in over half of the hashes.

Tables: for radius r every bit position gets a non-zero vector of r + 1 bits;
table ``v`` (each of the 2^(r+1) - 1 non-zero vectors) keeps the positions whose
vector has an odd product with ``v``.  For r or fewer differing positions some
``v`` is orthogonal to all their vectors, so the pair agrees on the kept bits
of that table: no pair within the radius is missed.  Positions take the vectors
in turn, which leaves about half of the bits in every table.

Equal fingerprints are one node, so copies never make pairs.  A bucket is
compared inside tasks, in pairs of blocks of at most ``BLOCK`` fingerprints,
and gives only the edges of a spanning forest of its links; large buckets are
spread over many block pairs, all of which are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import Text, deploy, fresh, store, trim
from .graph import connected_components

BITS = 64
BLOCK = 1024
_SPACES = bytes(range(0x09, 0x0E))
_UPPER = bytes(range(0x41, 0x5B))
_FOLD = bytes.maketrans(_UPPER + _SPACES, _UPPER.lower() + b" " * len(_SPACES))


def fingerprint_of(raw: bytes, words: int = 4) -> int:
    """Fingerprint of one UTF-8 text."""
    parts = [w for w in raw.translate(_FOLD).split(b" ") if w]
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(line, 42)
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[:len(parts) - words + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], 42) for a, b in zip(starts.tolist(), ends[words - 1:].tolist())], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(texts: Column, words: int = 4) -> Column:
    """64-bit fingerprint as a signed long; null counts as the empty text."""

    def simhash(array: pa.Array) -> pa.Array:
        text = Text.of(array)
        raw, off = text.data.tobytes(), text.offsets.tolist()
        found = np.array([fingerprint_of(raw[a:b], words) for a, b in zip(off, off[1:])], np.uint64)
        del text, raw
        trim()
        return pa.array(found.view(np.int64))

    deploy()
    return arrow_udf(simhash, "long")(texts)


def masks(radius: int, bits: int = BITS) -> list[int]:
    """Kept bits of each table, as unsigned integers."""
    top = 1 << (radius + 1)
    vector = [1 + i % (top - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() & 1) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links within the radius (breadth first, one row of distances at a time)."""
    left = np.arange(len(fp))
    edges = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[i]) <= radius
            if near.any():
                found = left[near]
                edges += [(i, j) for j in found]
                queue.extend(found)
                left = left[~near]
    return edges


def _bucket_edges(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        off = lists.offsets.to_numpy()
        fp = lists.values.to_numpy().view(np.uint64)
        size = np.diff(off)
        a, b = [], []
        small = size <= 8
        for s in range(1, 8):                                   # small buckets: all together, by distance in the list
            for k in range(8 - s):
                at = off[:-1][small & (size > k + s)] + k
                hit = at[np.bitwise_count(fp[at] ^ fp[at + s]) <= radius]
                a.append(fp[hit])
                b.append(fp[hit + s])
        for g in np.flatnonzero(~small):
            own = np.unique(fp[off[g]:off[g + 1]])
            e = np.array(_forest(own, radius), np.int64).reshape(-1, 2)
            a.append(own[e[:, 0]])
            b.append(own[e[:, 1]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])


def links(fingerprints: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` of distinct fingerprints that connect every two within ``radius``.

    ``fingerprints`` has one column ``fp`` of distinct values.  The edges are a
    subset of the links with the same connected components.
    """
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for t, m in enumerate(masks(radius))])
    keyed = fingerprints.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    big = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter(F.col("n") > block).select(
        F.col("t").alias("bt"), F.col("key").alias("bkey"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    spread = keyed.join(big, (F.col("t") == F.col("bt")) & (F.col("key") == F.col("bkey")), "left").withColumn(
        "own", F.coalesce(F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"), F.lit(0)))
    others = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1))
    pairs = spread.select("fp", "t", "key", "own", others.alias("other")).select(
        "fp", "t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    buckets = pairs.groupBy("t", "key", "i", "j").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return buckets.select("fps").mapInArrow(lambda it: _bucket_edges(it, radius), "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 4, words: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(id, fingerprint, component_id)`` per row; fingerprint as a long.

    component_id is the smallest id reachable over links of at most ``radius``
    differing bits.  Null and empty texts have fingerprint 0 and link like any
    other; a null id stays null and never names a component (a component of
    null ids only has a null component_id); repeated rows are one node and each
    of them is returned.
    """
    rows = store(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("fp")), "simhash")
    nodes = store(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-nodes")
    parts = store(connected_components(links(nodes.select("fp"), radius), "a", "b"), "simhash-parts")
    linked = nodes.join(parts, nodes["fp"] == parts["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    names = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = linked.join(names, "component").select(F.col("fp").alias("node_fp"), "component_id")
    return rows.join(named, rows["fp"] == named["node_fp"], "inner").select("id", F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = 4, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component stays, with all columns: the one with the smallest id.

    Of rows that share that id the first one read stays; in a component of null
    ids only, its first row stays.
    """
    fp, row, kept = fresh(docs, "simhash_fp", "simhash_row", "simhash_kept")
    marked = store(docs.withColumn(fp, fingerprint(F.col(f"`{text_col}`"), words)).withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    # smaller structs first: rows with an id, by id, then by place
    place = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    nodes = store(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(place).alias("best")), "simhash-nodes")
    parts = store(connected_components(links(nodes.select("fp"), radius), "a", "b"), "simhash-parts")
    stay = nodes.join(parts, nodes["fp"] == parts["node"], "left").groupBy(F.coalesce("component", "fp").alias("c")).agg(
        F.min("best").alias("best")).select(F.col("best.row").alias(kept))
    return marked.join(stay, F.col(row) == F.col(kept), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
