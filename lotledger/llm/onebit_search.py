"""Inner-product search with randomly rotated one-bit codes.

Vectors less their mean are turned by a random rotation; of each coordinate only the sign stays,
packed into bytes. With two scalars per vector (its distance to the mean and how well its signs
stand for its direction) the packed bits give an unbiased estimate of the inner product with any
query and a bound on its error. Only vectors whose bound reaches the best exact values found so
far are reranked with the vectors themselves.

Vectors lie in blocks of bounded size, and so do the queries; each pair of a query block and a
vector block is one task's work, of which the nearest few per query go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotledger.llm.common import python_tasks
from lotledger.session import materialise

BLOCK_ROWS = 16_384  # vectors in a block
QUERY_ROWS = 4_096  # queries in a block
BOUND = 2.5  # error bounds are this many standard deviations of the estimate
SEED = 11


def valid_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, vector`` as doubles, without vectors that are null, empty, zero or not finite."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(key).alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    return rows.where(F.size("v") > 0).where(finite & F.exists("v", lambda x: x != 0))


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64([SEED, size])).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distance to the mean, and inner product of code and direction."""
    rest = vectors - mean
    distance = np.sqrt((rest * rest).sum(axis=1))
    turned = rest @ rotation(vectors.shape[1])
    code = np.packbits(turned > 0, axis=1)
    fit = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1]) / np.maximum(distance, 1e-300)
    return code, distance, np.where(distance > 0, np.maximum(fit, 1e-9), 1.0)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision; equal rows give equal bits wherever they stand."""
    return (a * b).sum(axis=1)


def _power(largest: np.ndarray) -> np.ndarray:
    """The power of two above a number."""
    return np.frexp(largest)[1]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, mean: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query place, vector place, score)`` of the ``k`` nearest per query within a block.

    Estimates work on vectors whose largest components are scaled to one by powers of two, the block
    with its mean by one of them and each query by its own; scores come from the vectors as given.
    """
    size, out = vectors.shape[1], []
    given, asked = vectors, queries
    power = _power(np.array([np.abs(vectors).max(), np.abs(mean).max()]).max())
    powers = _power(np.abs(queries).max(axis=1))
    vectors, mean, queries = np.ldexp(vectors, -power), np.ldexp(mean, -power), np.ldexp(queries, -powers[:, None])
    code, distance, fit = encode(vectors, mean)
    turned = (queries @ rotation(size)).astype(np.float32)
    bits = np.unpackbits(code, axis=1, count=size).astype(np.float32) * 2 - 1
    scale = (distance / fit / np.sqrt(size)).astype(np.float32)
    spread = (distance * np.sqrt(np.maximum(1 - fit * fit, 0)) / fit / np.sqrt(max(size - 1, 1))).astype(np.float32)
    base, length = queries @ mean, np.sqrt((queries * queries).sum(axis=1))
    step = max(1, (4 << 20) // max(1, len(ids)))
    for first in range(0, len(queries), step):
        rows = slice(first, first + step)
        estimate = (turned[rows] @ bits.T) * scale + base[rows, None].astype(np.float32)
        estimate[query_ids[rows, None] == ids[None, :]] = -np.inf
        # Error of the query part that lies off the vector's direction; a little more for single precision.
        error = BOUND * length[rows, None].astype(np.float32) * spread + np.float32(1e-5) * (1 + np.abs(length[rows, None]).astype(np.float32) * distance.astype(np.float32))
        for i, (own, bound) in enumerate(zip(estimate, error, strict=True), first):
            top = np.argpartition(-own, min(k, len(own)) - 1)[:k]
            exact = np.sort(inner(vectors[top], queries[i][None, :])[own[top] > -np.inf])
            least = exact[max(0, len(exact) - k)] if len(exact) >= k else -np.inf
            near = np.flatnonzero((own + bound >= least) & (own > -np.inf))
            with np.errstate(over="ignore", invalid="ignore"):
                score = inner(given[near], asked[i][None, :])
                wide = ~np.isfinite(score)
                if wide.any():
                    score[wide] = np.ldexp(inner(vectors[near[wide]], queries[i][None, :]), power + powers[i])
            best = np.lexsort((ids[near], -score))[:k]
            out.append((np.full(len(best), i), near[best], score[best]))
    if not out:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()).reshape(len(column), -1)


def nearest(
    df: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 20,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, <key>, score``: the ``k`` nearest others of each row chosen by ``is_query``.

    Vectors that are null, zero or hold null or non-finite components take no part. Vectors are
    compared within their own number of components. Fewer than ``k`` others give fewer rows; ties
    go to the smaller id; rows that share an id are never each other's neighbours. Every vector is
    indexed and every block is searched. Bounds of ``BOUND`` deviations can miss a neighbour, rarely.
    Components of any finite size are compared; a score beyond the range of doubles is infinite.
    """
    spark = df.sparkSession
    python_tasks(spark)
    kind = df.schema[key].dataType.simpleString()
    rows = materialise(valid_vectors(df, key, vector).withColumn("size", F.size("v")), "vectors")
    means = rows.select("size", F.posexplode("v")).groupBy("size", "pos").agg(F.avg("col").alias("mean"))
    counts = {r["size"]: r["n"] for r in rows.groupBy("size").agg(F.count("*").alias("n")).collect()}
    mean_of = {n: np.zeros(n) for n in counts}
    for r in means.collect():  # as many numbers as a vector has components
        mean_of[r["size"]][r["pos"]] = r["mean"] if np.isfinite(r["mean"]) else 0.0
    shared = spark.sparkContext.broadcast(mean_of)

    # Blocks by a hash of the row, so that none holds more than its share.
    salt = F.xxhash64("id", "v")
    queries = rows.where(is_query(F.col("id")))
    asked = {r["size"]: r["n"] for r in queries.groupBy("size").agg(F.count("*").alias("n")).collect()}
    blocks, query_blocks = F.lit(1), F.lit(1)
    for size, n in counts.items():
        here = F.col("size") == size
        blocks = F.when(here, -(-n // block_rows)).otherwise(blocks)
        query_blocks = F.when(here, max(1, -(-asked.get(size, 0) // query_rows))).otherwise(query_blocks)
    left = (
        queries.withColumn("qb", F.pmod(F.xxhash64(F.lit("query"), salt), query_blocks))
        .withColumn("vb", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)))
        .select("size", "qb", "vb", "id", "v")
    )
    right = (
        rows.withColumn("vb", F.pmod(salt, blocks))
        .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), query_blocks.cast("long") - 1)))
        .select("size", "qb", "vb", "id", "v")
    )

    def run(keys: tuple[pa.Scalar, ...], ask: pa.Table, have: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": have.column("id")[:0], "id": have.column("id")[:0], "score": pa.array([], pa.float64())})
        if not len(ask) or not len(have):
            return empty
        vectors, queries_ = _matrix(have.column("v")), _matrix(ask.column("v"))
        ids, query_ids = have.column("id").to_numpy(), ask.column("id").to_numpy()
        mean = shared.value[vectors.shape[1]]
        q, v, score = search_block(queries_, query_ids, vectors, ids, mean, k)
        return pa.table({"query_id": query_ids[q], "id": ids[v], "score": score}).cast(empty.schema)

    by = ["size", "qb", "vb"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, f"query_id {kind}, id {kind}, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
