"""MinHash document fingerprints.

Shingles are five words (a text with fewer is one shingle; one without words
has none).  Each of ``permutations`` universal hash functions ``a x + b mod
2^64`` (``a`` odd, so a permutation) is applied to a text's shingle hashes in
numpy, and the minimum kept; 16 mixed bits of each minimum make the
fingerprint.  The share of equal values in two fingerprints estimates the
Jaccard similarity of the shingle sets.  Texts without words have the
fingerprint ``ffff...`` and are alike.

:func:`near_duplicates` cuts signatures into bands, joins equal bands in Spark
and verifies candidates by the exact Jaccard similarity of their shingle sets.
In a bucket every text meets the bucket's first one; by the triangle
inequality of the Jaccard distance only texts at 2 t - 1 or more from that
leader, but below t, can be linked to texts that are linked to it, so just
those meet the leader's followers, and the texts left over go on with the next
leader until none is left.  Classes need no more; the number of each text's
links is counted over all pairs of a bucket, in salted blocks, each pair in the
first band that it shares.

Defined cases: null counts as the empty text; equal texts have equal
fingerprints and are one node; repeated rows and equal ids are kept and put in
the order of id and text; a null id comes last in descending order; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import Text, deploy, mix64, store
from .graph import connected_components

PERMUTATIONS = 128
BANDS = 32
WORDS = 5
ROWS_PER_RANGE, MOST_RANGES = 500, 4096
BLOCK = 500                    # texts of a bucket met with as many others in one task when links are counted


def functions(permutations: int, seed: int = 41) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    a = r.integers(0, 1 << 64, permutations, np.uint64) | np.uint64(1)
    return a, r.integers(0, 1 << 64, permutations, np.uint64)


def shingle_hashes(text: Text, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and each text's borders in them."""
    starts, ends, owner = text.words()
    h = text.hashes(starts, ends)
    counts = text.per_text(owner)
    first = np.concatenate([[0], np.cumsum(counts)])
    full = np.maximum(counts - words + 1, np.minimum(counts, 1))
    borders = np.concatenate([[0], np.cumsum(full)])
    who = np.repeat(np.arange(text.n), full)
    at = np.arange(borders[-1]) - borders[who] + first[who]             # first word of each shingle
    out = np.zeros(len(at), np.uint64)
    end = first[who + 1]
    with np.errstate(over="ignore"):
        for j in range(words):
            inside = at + j < end
            w = np.where(inside, h[np.minimum(at + j, max(len(h) - 1, 0))] if len(h) else np.uint64(0), np.uint64(0))
            out = mix64(out * np.uint64(0x9FB21C651E98DF25) + w)
    return out, borders


def signatures(texts: list[str], permutations: int = PERMUTATIONS) -> np.ndarray:
    """One row of 64-bit minima for each text; all ones without words."""
    a, b = functions(permutations)
    text = Text.of(pa.array(texts, pa.large_string()))
    out = np.full((len(texts), permutations), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i, _, part in text.slices():
            x, borders = shingle_hashes(part)
            for k in range(part.n):
                for s in range(borders[k], borders[k + 1], 1024):
                    block = x[s:min(s + 1024, borders[k + 1])]
                    np.minimum(out[i + k], (a[:, None] * block[None, :] + b[:, None]).min(axis=1), out=out[i + k])
    return out


def short(minima: np.ndarray) -> np.ndarray:
    """16 mixed bits of each minimum, big-endian; all ones where a text had no words."""
    low = (mix64(minima) >> np.uint64(48)).astype(">u2")
    low[(minima == np.iinfo(np.uint64).max).all(axis=1)] = 0xFFFF
    return low


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def fingerprints(texts: list[str], permutations: int = PERMUTATIONS) -> np.ndarray:
    """Short fingerprints of the texts; equal texts of the list are computed once."""
    place = {t: i for i, t in enumerate(dict.fromkeys(texts))}
    own = short(signatures(list(place), permutations)) if place else np.zeros((0, permutations), ">u2")
    return own[[place[t] for t in texts]] if texts else own


def _edited(texts: pa.Array, following: pa.Array, permutations: int) -> pa.Array:
    """Fingerprints of texts, edited texts and next texts, and their likeness."""
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    out: list[list] = [[] for _ in names]
    for i in range(0, len(texts), 128):
        now = pc.fill_null(texts.slice(i, 128), "").to_pylist()
        after = pc.fill_null(following.slice(i, 128), "").to_pylist()
        edited = [t[:len(t) - len(t) // 2] + x[:len(t) // 2] for t, x in zip(now, after)]
        f = fingerprints(now + edited + after, permutations)
        n = len(now)
        for column, values in zip(out, (
                [len(t) for t in now], [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                [x.tobytes().hex() for x in f[:n]], [x.tobytes().hex() for x in f[n:2 * n]],
                likeness(f[:n], f[n:2 * n]).tolist(), likeness(f[:n], f[2 * n:]).tolist())):
            column.extend(values)
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(out, types)], fields=[pa.field(n, t) for n, t in zip(names, types)])


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, next_text)``: the text of the next row by descending id, after the last the first.

    Rows are dealt to ranges of ids (borders are quantiles, at most
    ``MOST_RANGES`` of them) and each range's first row also goes to the range
    before it, so the texts move once and a window per range finds the next.
    """
    deploy(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    n = rows.count()
    ranges = min(MOST_RANGES, max(1, n // ROWS_PER_RANGE))
    marks = rows.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)] or [0.5], 20 * MOST_RANGES).alias("m")).first()["m"]
    borders = np.unique(np.array(marks or [], np.int64)) if ranges > 1 else np.zeros(0, np.int64)

    def range_of(ids: pa.Array) -> pa.Array:
        own = len(borders) - np.searchsorted(borders, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), "right")
        own[ids.is_null().to_numpy(zero_copy_only=False)] = len(borders)
        return pa.array(own.astype(np.int32))

    placed = rows.withColumn("g", arrow_udf(range_of, "int")(F.col("id").cast("long")))
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", "h")
    firsts = sorted((r["g"], r["o"]["id"], r["o"]["h"]) for r in placed.groupBy("g").agg(F.max(order).alias("o")).collect())
    if not firsts:
        return rows.select("id", "text", F.col("text").alias("next_text"))
    # one row for each range: at most MOST_RANGES + 1
    also = [(firsts[i - 1][0], firsts[i][1], firsts[i][2]) for i in range(len(firsts))]
    also = F.broadcast(docs.sparkSession.createDataFrame(also, "g2 int, id2 long, h2 long"))
    both = placed.join(also, F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2")), "left")
    parts = F.array(F.struct(F.col("g"), F.lit(False).alias("guest")), F.struct(F.col("g2").alias("g"), F.lit(True).alias("guest")))
    sent = both.select("id", "text", "h", F.explode(F.filter(parts, lambda p: p["g"].isNotNull())).alias("p")).select("id", "text", "h", "p.*")
    line = Window.partitionBy("g").orderBy("guest", F.col("id").desc_nulls_last(), F.desc("h"))
    return sent.withColumn("next_text", F.lead("text").over(line)).filter(~F.col("guest")).select("id", "text", "next_text")


def fingerprint_documents(docs: DataFrame, permutations: int = PERMUTATIONS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for every row.

    The edited text is the text with its last half (rounded down, in code
    points) replaced by as many first code points of the next document.
    """
    kind = ("struct<n_chars:bigint,edited_sha256:string,fingerprint:string,edited_fingerprint:string,"
            "near_edited:double,near_next:double>")

    def both(texts: pa.Array, following: pa.Array) -> pa.Array:
        return _edited(texts, following, permutations)

    rows = with_next_text(docs, id_col, text_col)
    return rows.select(F.col("id").alias(id_col), arrow_udf(both, kind)("text", "next_text").alias("x")).select(id_col, "x.*")


def _jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / F.greatest(F.size(a) + F.size(b) - both, F.lit(1))


def _likeness_of_sets(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(_jaccard(a, b))


def link_counts(nodes: DataFrame, bands: DataFrame, threshold: float) -> DataFrame:
    """``(n, links)``: for each node with a link, the nodes that share a band and are at least ``threshold`` alike.

    A bucket's pairs grow with the square of its texts, so they are dealt to
    cells of two blocks of about ``BLOCK`` texts.
    """
    sizes = bands.groupBy("band", "key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n")).filter(
        F.col("n") > 1).select(F.col("band").alias("b2"), F.col("key").alias("k2"), "blocks")
    own = bands.join(sizes, (F.col("band") == F.col("b2")) & (F.col("key") == F.col("k2"))).select(
        "node", "band", "key", "blocks", F.pmod(F.xxhash64("node", "band"), F.col("blocks")).cast("int").alias("block"))
    cells = own.join(nodes, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "band", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "s", "k")
    a, b = (cells.select("band", "key", "low", "high", *[F.col(c).alias(c + x) for c in ("node", "block", "s", "k")]) for x in "ab")
    pairs = a.join(b, ["band", "key", "low", "high"]).filter(
        (F.col("nodea") < F.col("nodeb")) & ((F.col("low") == F.col("high")) | (F.col("blocka") != F.col("blockb")))
        & (F.array_position(F.zip_with("ka", "kb", lambda x, y: x == y), True) == F.col("band") + 1))
    links = pairs.filter(_likeness_of_sets(F.col("sa"), F.col("sb")) >= threshold)
    return links.select(F.explode(F.array("nodea", "nodeb")).alias("n")).groupBy("n").agg(F.count("*").alias("links"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, permutations: int = PERMUTATIONS, bands: int = BANDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, class_id, links)`` per row: smallest id reachable over links of at least ``threshold``.

    ``links`` counts all verified links of the row's text: the other texts that
    share a band with it and are at least ``threshold`` alike.  Texts without
    words are alike.
    """
    deploy(docs.sparkSession)
    width = permutations // bands

    def prepare(texts: pa.Array) -> pa.Array:
        sets, keys = [], []
        for i in range(0, len(texts), 128):
            part = pc.fill_null(texts.slice(i, 128), "").to_pylist()
            t = Text.of(pa.array(part, pa.large_string()))
            x, borders = shingle_hashes(t)
            sets += [np.unique(x[borders[k]:borders[k + 1]]).view(np.int64) for k in range(t.n)]
            s = signatures(part, permutations).reshape(len(part), bands, width)
            key = np.zeros((len(part), bands), np.uint64)
            with np.errstate(over="ignore"):
                for j in range(width):
                    key = mix64(key * np.uint64(0x9FB21C651E98DF25) + s[:, :, j] + np.arange(bands, dtype=np.uint64))
            keys += list(key.view(np.int64))
        return pa.StructArray.from_arrays([pa.array(sets, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))], ["s", "k"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = store(docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text, F.md5(text.cast("binary"))).alias("node")), "minhash-rows")
    nodes = rows.groupBy("node").agg(F.first("text").alias("text"))
    nodes = store(nodes.select("node", arrow_udf(prepare, "struct<s:array<bigint>,k:array<bigint>>")("text").alias("x")).select("node", "x.s", "x.k"), "minhash-nodes")
    left = all_bands = store(nodes.select("node", F.posexplode("k").alias("band", "key")), "minhash-bands")
    sets = nodes.select(F.col("node").alias("n"), "s")
    found = None

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = sets.select(F.col("n").alias("na"), F.col("s").alias("sa")), sets.select(F.col("n").alias("nb"), F.col("s").alias("sb"))
        return pairs.join(a, F.col("a") == F.col("na")).join(b, F.col("b") == F.col("nb")).select(
            "a", "b", _likeness_of_sets(F.col("sa"), F.col("sb")).alias("j"))

    while True:
        leaders = left.groupBy("band", "key").agg(F.min("node").alias("lead"), F.count("*").alias("n")).filter(F.col("n") > 1).select(
            F.col("band").alias("b2"), F.col("key").alias("k2"), "lead")
        met = left.join(leaders, (F.col("band") == F.col("b2")) & (F.col("key") == F.col("k2"))).filter(
            F.col("node") != F.col("lead")).select("band", "key", "node", "lead")
        met = store(met, "minhash-met")
        if met.isEmpty():
            break
        judged = store(verified(met.select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()), "minhash-judged")
        own = met.join(judged, (F.col("lead") == F.col("a")) & (F.col("node") == F.col("b"))).select("band", "key", "node", "j")
        near, edge = own.filter(F.col("j") >= threshold), own.filter((F.col("j") < threshold) & (F.col("j") >= 2 * threshold - 1))
        cross = edge.select("band", "key", F.col("node").alias("x")).join(near.select("band", "key", F.col("node").alias("y")), ["band", "key"])
        cross = verified(cross.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        links = judged.unionByName(cross).filter(F.col("j") >= threshold).select("a", "b")
        found = links if found is None else found.unionByName(links)
        left = store(own.filter(F.col("j") < threshold).select("node", "band", "key"), "minhash-bands")
    if found is None:
        return rows.select("id", F.min("id").over(Window.partitionBy("node")).alias("class_id"), F.lit(0).cast("long").alias("links"))
    found = store(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "minhash-links")
    degree = link_counts(nodes, all_bands, threshold)
    parts = connected_components(found, "a", "b")
    named = rows.join(parts, rows["node"] == parts["node"], "left").select(
        "id", rows["node"].alias("own"), F.coalesce("component", rows["node"]).alias("component"))
    named = store(named, "minhash-named")
    names = named.groupBy("component").agg(F.min("id").alias("class_id"))
    return named.join(names, "component").join(degree, F.col("own") == F.col("n"), "left").select(
        "id", "class_id", F.coalesce("links", F.lit(0)).cast("long").alias("links"))
