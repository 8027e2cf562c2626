"""Near-duplicate embeddings by navigable small-world graphs, one for each shard.

Each shard is built once and stored. Every shard is searched with the nodes of every other and its
own, and beams widen until an audit finds no miss. A node stands for a ball of vectors that lie
close to it: by the angles, two balls are linked as a whole, or not at all, or their members are
compared in double precision. So thousands of copies give counts and one edge, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.llm import hnsw
from lotledger.llm.common import python_tasks
from lotledger.llm.components import connected_components
from lotledger.llm.onebit_search import valid_vectors
from lotledger.session import materialise

SHARD_ROWS = 32_768
SHARDS = 8  # at least
SLACK = 1e-6  # radians: what angles in single precision may be off


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def compare(a: hnsw.Shard, b: hnsw.Shard, same: bool, cosine: float) -> tuple[dict[int, int], set[tuple[int, int]]]:
    """Links of each vector between two shards, and the pairs of nodes whose balls have some.

    Vectors are named by their place: those of ``a`` first, then those of ``b``.
    """
    limit = float(np.arccos(cosine))
    reach = limit + a.radius + (b.radius.max() if len(b.radius) else 0.0) + 1e-3
    least = np.cos(np.minimum(reach, np.pi)).astype(np.float32)
    who, what = hnsw.within(b, a.graph.vectors, least)
    counts = np.zeros(len(a.ids) + len(b.ids), np.int64)
    shift = 0 if same else len(a.ids)
    if same:
        # A pair counts once, whichever of its nodes found the other.
        low, high = np.minimum(who, what).astype(np.int64), np.maximum(who, what).astype(np.int64)
        pairs = np.unique((low * len(a.radius) + high)[low < high])
        who, what = pairs // len(a.radius), pairs % len(a.radius)
        # Members of one ball lie within two radii of each other.
        for ball in np.flatnonzero(np.diff(a.starts) > 1):
            rows = np.arange(a.starts[ball], a.starts[ball + 1])
            if 2 * a.radius[ball] <= limit - SLACK:
                counts[rows] += len(rows) - 1
            else:
                for first in range(0, len(rows), 1024):
                    part = rows[first:first + 1024]
                    counts[part] += (a.vectors[part] @ a.vectors[rows].T >= cosine).sum(axis=1) - 1
    size_a, size_b = np.diff(a.starts)[who], np.diff(b.starts)[what]
    near = (a.vectors[a.starts[who]] * b.vectors[b.starts[what]]).sum(axis=1)
    angle = np.arccos(np.clip(near, -1, 1))
    spread = a.radius[who] + b.radius[what]
    single = (size_a == 1) & (size_b == 1)
    whole = np.where(single, near >= cosine, angle + spread <= limit - SLACK)
    linked = {*zip(who[whole].tolist(), what[whole].tolist(), strict=True)}
    add_a, add_b = np.zeros(len(a.starts), np.int64), np.zeros(len(b.starts), np.int64)
    np.add.at(add_a, who[whole], size_b[whole])
    np.add.at(add_b, what[whole], size_a[whole])
    counts[:len(a.ids)] += np.repeat(add_a[:-1], np.diff(a.starts))
    counts[shift:shift + len(b.ids)] += np.repeat(add_b[:-1], np.diff(b.starts))
    for i, j in zip(*(x[~whole & ~single & (angle - spread <= limit + SLACK)] for x in (who, what)), strict=True):
        left, right = np.arange(a.starts[i], a.starts[i + 1]), np.arange(b.starts[j], b.starts[j + 1])
        for first in range(0, len(left), 1024):
            part = left[first:first + 1024]
            close = a.vectors[part] @ b.vectors[right].T >= cosine
            counts[part] += close.sum(axis=1)
            counts[shift + right] += close.sum(axis=0)
            if close.any():
                linked.add((int(i), int(j)))
    found = np.flatnonzero(counts)
    return dict(zip(found.tolist(), counts[found].tolist(), strict=True)), linked


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9,
    shard_rows: int = SHARD_ROWS, shards: int = SHARDS,
) -> DataFrame:
    """``<key>, n_links, component_id, kept`` for every row of ``df``.

    Vectors that are null, zero or hold null or non-finite components, and vectors with another
    number of components, are linked with nothing. A row without an id has no links and no
    component and is kept. Rows that share an id are vectors of their own whose links add up under
    the id.
    """
    spark = df.sparkSession
    python_tasks(spark)
    kind = df.schema[key].dataType.simpleString()
    rows = materialise(valid_vectors(df, key, vector).withColumn("size", F.size("v")), "vectors")
    sizes = {r["size"]: max(shards, -(-r["n"] // shard_rows)) for r in rows.groupBy("size").agg(F.count("*").alias("n")).collect()}
    parts = F.lit(1)
    for size, n in sizes.items():
        parts = F.when(F.col("size") == size, n).otherwise(parts)
    dealt = rows.select("id", "v", "size", F.pmod(F.xxhash64("id", "v"), parts).cast("int").alias("shard"), parts.alias("parts"))

    def built(keys: tuple[pa.Scalar, ...], have: pa.Table) -> pa.Table:
        v = np.asarray(have.column("v").combine_chunks().flatten()).reshape(len(have), -1)
        shard = hnsw.build(have.column("id").to_numpy(), _unit(v))
        return pa.table({
            "size": pa.array([keys[0].as_py()], pa.int32()), "shard": pa.array([keys[1].as_py()], pa.int32()),
            "parts": pa.array([have.column("parts")[0].as_py()], pa.int32()), "graph": pa.array([shard.dump()], pa.binary()),
        })

    stored = materialise(dealt.groupBy("size", "shard").applyInArrow(built, "size int, shard int, parts int, graph binary"), "shards")
    left = stored.withColumn("other", F.explode(F.sequence("shard", F.col("parts") - 1))).select("size", F.col("shard").alias("i"), F.col("other").alias("j"), "graph")
    right = stored.withColumn("i", F.explode(F.sequence(F.lit(0), "shard"))).select("size", "i", F.col("shard").alias("j"), "graph")

    def searched(keys: tuple[pa.Scalar, ...], one: pa.Table, two: pa.Table) -> pa.Table:
        out: list[tuple[int, int | None, int]] = []
        if len(one) and len(two):  # a shard without rows was never built
            a = hnsw.Shard.load(one.column("graph")[0].as_py())
            same = keys[1].as_py() == keys[2].as_py()
            b = a if same else hnsw.Shard.load(two.column("graph")[0].as_py())
            ids = np.concatenate([a.ids, b.ids])
            counts, linked = compare(a, b, same, cosine)
            out = [(ids[i].item(), None, n) for i, n in counts.items()]
            out += [(a.ids[a.starts[i]].item(), b.ids[b.starts[j]].item(), 0) for i, j in linked]
        x, y, n = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64()), "n": pa.array(n, pa.int64())})

    found = left.groupBy("size", "i", "j").cogroup(right.groupBy("size", "i", "j")).applyInArrow(searched, "a long, b long, n long")
    found = materialise(found, "links")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for blob in batch["graph"]:
                shard = hnsw.Shard.load(blob)
                yield pd.DataFrame({"id": shard.ids, "node": np.repeat(shard.ids[shard.starts[:-1]], np.diff(shard.starts))})

    balls = materialise(stored.select("graph").mapInPandas(members, "id long, node long").distinct(), "balls")
    # Rows that share an id may lie in several balls, which are then one component.
    links = found.where("b is not null").select("a", "b").unionByName(
        balls.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("a", "b")
    ).unionByName(balls.where("id <> node").join(balls.select(F.col("id").alias("node"), F.col("node").alias("b")), "node").where("node <> b").select(F.col("node").alias("a"), "b"))
    roots = connected_components(links).withColumnRenamed("component", "root")
    lowest = balls.groupBy("node").agg(F.min("id").alias("low")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = materialise(lowest, "roots")
    smallest = lowest.groupBy("root").agg(F.min("low").alias("component_id"))
    by_node = materialise(lowest.select("node", "root").join(smallest, "root").select("node", "component_id"), "node-components")
    component = balls.join(by_node, "node").groupBy("id").agg(F.min("component_id").alias("component_id"))
    count = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n_links")).withColumnRenamed("a", "id")
    result = df.select(F.col(key)).join(component.withColumnRenamed("id", key), key, "left").join(count.withColumnRenamed("id", key), key, "left")
    return result.select(
        F.col(key).cast(kind).alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", F.col(key)).cast(kind).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
