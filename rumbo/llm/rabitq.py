"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

Index: each unit vector, padded with zeros to ``bits`` dimensions, is turned by
a random rotation and keeps one sign bit per dimension plus one correction
scalar ``f``, the inner product of the turned vector with its own code.  The
inner product with a query is estimated as ``<code, turned query> / f``; with
high probability the error is at most ``eps * sqrt((1 - f^2) / f^2 / (bits - 1))``.

Search: queries (a stated set) meet all codes in blocks, by an equi-join of
code blocks with query-block numbers.  Within a pair of blocks, vectors are
reranked by exact cosine in order of their upper bounds, until the bound falls
below the query's k-th exact cosine; only the few best of each pair of blocks
leave the task, and a top-k per query ends the search.

Equal vectors are one code with its k + 1 smallest ids, which are all that can
be among a query's k nearest; equal query vectors are searched once.

Defined cases: vectors that are null, zero, of another length than the
commonest, or hold null or non-finite components take no part, as candidate or
query; ids must not be null (such rows take no part); repeated rows count once;
ties go to the smaller id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import deploy, store

BITS = 256
EPS = 3.0
CODE_BLOCK, QUERY_BLOCK = 8192, 1024


def rotation(dims: int, bits: int, seed: int = 17) -> np.ndarray:
    """First ``dims`` columns of a random ``bits`` x ``bits`` rotation."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return (q * np.sign(np.diag(r)))[:, :dims]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision, components added in order."""
    dot = lambda x, y: np.add.accumulate(x * y, axis=1)[:, -1]
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))


def _matrix(array: pa.Array) -> np.ndarray:
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(array), -1)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction scalars of the rows."""
    y = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ turn.T
    return np.packbits(y > 0, axis=1), np.abs(y).sum(axis=1) / np.sqrt(turn.shape[0])


def _codes(vectors: Column, dims: int, bits: int) -> Column:
    def one_bit(array: pa.Array) -> pa.Array:
        code, f = encode(_matrix(array), rotation(dims, bits)) if len(array) else (np.zeros((0, 1), np.uint8), np.zeros(0))
        return pa.StructArray.from_arrays([pa.array([c.tobytes() for c in code], pa.binary()), pa.array(f)], ["code", "f"])

    return arrow_udf(one_bit, "struct<code:binary,f:double>")(vectors)


def search_block(codes: np.ndarray, f: np.ndarray, vectors: np.ndarray, queries: np.ndarray, turn: np.ndarray, k: int,
                 eps: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query row, vector rows, exact cosines) of each query's ``k`` best in the block, by estimate, bound and rerank."""
    bits = turn.shape[0]
    signs = np.unpackbits(codes, axis=1)[:, :bits].astype(np.float32) * 2 - 1
    margin = eps * np.sqrt(np.maximum(1 - f * f, 0) / (f * f) / (bits - 1))
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    turned = (unit @ turn.T).astype(np.float32)
    for a in range(0, len(queries), 128):
        upper = turned[a:a + 128] @ signs.T / (np.sqrt(bits) * f) + margin
        for i, bound in enumerate(upper, a):
            kth, best, score = -np.inf, np.zeros(0, np.int64), np.zeros(0)
            left, take = np.arange(len(bound)), 4 * k
            while len(left):                                  # the highest upper bounds first, in growing portions
                if len(left) > take:
                    part = np.argpartition(-bound[left], take - 1)
                    now, left = left[part[:take]], left[part[take:]]
                else:
                    now, left = left, left[:0]
                exact = cosines(vectors[now], np.broadcast_to(queries[i], (len(now), vectors.shape[1])))
                best, score = np.concatenate([best, now]), np.concatenate([score, exact])
                if len(score) > k:
                    # all that tie with the k-th stay until the ids decide
                    kth = np.partition(score, len(score) - k)[len(score) - k]
                    keep = score >= kth
                    best, score = best[keep], score[keep]
                elif len(score) == k:
                    kth = score.min()
                left = left[bound[left] >= kth]
                take *= 2
            yield i, best, score


def _search(batches: Iterator[pa.RecordBatch], dims: int, bits: int, k: int, eps: float) -> Iterator[pa.RecordBatch]:
    turn = rotation(dims, bits)
    for batch in batches:
        for r in range(batch.num_rows):
            codes, queries = batch.column("cells")[r].values, batch.column("queries")[r].values
            code = np.stack([np.frombuffer(c, np.uint8) for c in codes.field("code").to_pylist()])
            ids = codes.field("ids").to_pylist()
            first = np.array([x[0] for x in ids])
            q_ids = queries.field("q").to_numpy()
            out: list[list] = [[], [], []]
            for i, best, score in search_block(code, codes.field("f").to_numpy(), _matrix(codes.field("v")), _matrix(queries.field("v")), turn, k, eps):
                order = np.lexsort((first[best], -score))[:k]
                for j in order:
                    for x in ids[best[j]]:
                        out[0].append(q_ids[i])
                        out[1].append(x)
                        out[2].append(score[j])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                                             ["q", "vec_id", "score"])


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: x + 0.0).alias("v"))        # -0.0 becomes 0.0
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = lengths["d"] if lengths else 0
    return rows.filter(F.size("v") == dims), dims


def search(vectors: DataFrame, is_query: Column, k: int = 5, bits: int = BITS, eps: float = EPS, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every row where ``is_query`` holds (a condition on ``id``)."""
    spark = vectors.sparkSession
    deploy(spark)
    usable, dims = _usable(vectors, id_col, vec_col)
    kind = "query_id long, rank int, vec_id long, score double"
    if not dims:
        return spark.createDataFrame([], kind)
    bits = max(bits, -(-dims // 8) * 8)
    usable = store(usable, "ann-vectors")
    first = Window.partitionBy("v").orderBy("id")
    few = usable.dropDuplicates(["id", "v"]).withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    distinct = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    index = store(distinct.select("v", "ids", _codes(F.col("v"), dims, bits).alias("c")).select("v", "ids", "c.code", "c.f"), "ann-index")
    blocks = max(1, -(-index.count() // CODE_BLOCK))
    asked = usable.filter(is_query).select(F.col("id").alias("query_id"), "v").distinct()
    who = store(asked, "ann-queries")
    wanted = store(who.select("v").distinct().withColumn("q", F.monotonically_increasing_id()), "ann-query-vectors")
    groups = max(1, -(-wanted.count() // QUERY_BLOCK))
    by_query = wanted.groupBy(F.pmod(F.xxhash64("q"), F.lit(groups)).cast("int").alias("g")).agg(
        F.collect_list(F.struct("q", "v")).alias("queries"))
    by_code = index.groupBy(F.pmod(F.xxhash64(F.element_at("ids", 1), F.lit(1)), F.lit(blocks)).alias("b")).agg(
        F.collect_list(F.struct("ids", "code", "f", "v")).alias("cells"))
    paired = by_code.select("cells", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g")).join(by_query, "g").select("cells", "queries")
    found = paired.mapInArrow(lambda it: _search(it, dims, bits, k + 1, eps), "q long, vec_id long, score double")
    top = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    near = found.withColumn("n", F.row_number().over(top)).filter(F.col("n") <= k + 1)
    lists = near.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    named = who.join(wanted.select(F.col("v").alias("v2"), F.col("q").alias("q2")), F.col("v") == F.col("v2")).select("query_id", F.col("q2").alias("q"))
    answer = named.join(lists, "q").select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return answer.select("query_id", F.posexplode("near").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
