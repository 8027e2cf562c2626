"""Near-duplicate documents by min-max hashing.

Under each permutation of the shingles both the smallest and the largest value are kept, which
gives two nearly independent signature values for one evaluation. Bands of the signature are
bucket keys. Documents with equal shingle sets are one class; of each class one document goes on.

A bucket never becomes a list of pairs. Its members are compared with one member, links are
confirmed on the whole shingle sets, and linked documents become one component; the next round
concerns only members outside the component that holds most of their bucket. What is still outside
may be linked with any member, so none is passed over unless its set rules that out: a document
cannot reach the wanted overlap if too few of its shingles occur in other components at all. Those
that can are compared with every member of their buckets that can, in blocks whose overlaps are counted
together and of which only the links come out, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.llm.common import python_tasks
from lotledger.llm.components import connected_components
from lotledger.llm.shingles import U, mix, shingle_sets
from lotledger.session import materialise

PERMUTATIONS = 40  # two values each
BAND_ROWS = 4
CENTRE_ROUNDS = 2
BLOCK_DOCS = 512  # documents on one side of a block
DENSE_PAIRS = 2_048  # pairs of documents with a shingle from which a matrix product counts it

_RANDOM = np.random.Generator(np.random.PCG64(5_150))
_FACTORS = _RANDOM.integers(0, 1 << 63, 256, dtype=U) * U(2) + U(1)
_TERMS = _RANDOM.integers(0, 1 << 64, 256, dtype=U)


def minmax_bands(sets: list[np.ndarray], permutations: int, rows: int) -> np.ndarray:
    """Bucket keys, one row for each (non-empty) set; the first half from minima, then maxima."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    low, high = (np.empty((permutations, len(sets)), U) for _ in range(2))
    for i in range(permutations):
        value = flat * _FACTORS[i] + _TERMS[i]
        low[i], high[i] = np.minimum.reduceat(value, starts), np.maximum.reduceat(value, starts)
    keys = []
    for band, first in enumerate(range(0, 2 * permutations, rows)):
        half = np.vstack([low, high])[first:first + rows]
        key = np.full(len(sets), U(band + 1))
        for row in half:
            key = mix(key * U(0x9E3779B97F4A7C15) + row)
        keys.append(key)
    return np.stack(keys, axis=1).view(np.int64)


def signatures(docs: DataFrame, words: int, permutations: int = PERMUTATIONS, rows: int = BAND_ROWS) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, bands``: size, digest and bucket keys of each shingle set."""
    python_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), words))
            sizes = np.array([len(s) for s in sets], np.int64)
            d1 = np.array([mix(s).sum(dtype=U) for s in sets], U).view(np.int64)
            d2 = np.array([mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U) for s in sets], U).view(np.int64)
            full = np.flatnonzero(sizes)
            bands = np.zeros((0, 1), np.int64)
            if len(full):
                bands = np.vstack([minmax_bands([sets[i] for i in full[k:k + 256]], permutations, rows) for k in range(0, len(full), 256)])
            ends = np.concatenate([[0], np.cumsum((sizes > 0) * bands.shape[1])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(d1), pa.array(d2), lists], names=["doc_id", "n_shingles", "d1", "d2", "bands"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, d1 long, d2 long, bands array<long>"
    )


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole shingle sets overlap by ``percent`` of their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(shingle_sets(batch.column("x"), words), shingle_sets(batch.column("y"), words), strict=True):
                smaller, larger = sorted((len(x), len(y)))
                if 100 * smaller < percent * larger or not smaller:
                    keep.append(False)
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (smaller + larger - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, f"a {kind}, b {kind}")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set.

    Shingles that many sets have are counted by a matrix product, the others one by one.
    """
    out = np.zeros((len(left), len(right)), np.float32)
    owner_l = np.repeat(np.arange(len(left)), [len(s) for s in left])
    owner_r = np.repeat(np.arange(len(right)), [len(s) for s in right])
    h_l, h_r = np.concatenate([np.zeros(0, U), *left]), np.concatenate([np.zeros(0, U), *right])
    both = np.intersect1d(h_l, h_r)
    for names in ("l", "r"):
        h, owner = (h_l, owner_l) if names == "l" else (h_r, owner_r)
        at = np.searchsorted(both, h)
        inside = at < len(both)
        inside[inside] = both[at[inside]] == h[inside]
        order = np.argsort(at[inside], kind="stable")
        if names == "l":
            column_l, owner_l = at[inside][order], owner[inside][order]
        else:
            column_r, owner_r = at[inside][order], owner[inside][order]
    n_l, n_r = np.bincount(column_l, minlength=len(both)), np.bincount(column_r, minlength=len(both))
    many = n_l * n_r > DENSE_PAIRS
    dense = np.flatnonzero(many)
    for first in range(0, len(dense), 4096):
        number = np.full(len(both), -1)
        number[dense[first:first + 4096]] = np.arange(len(dense[first:first + 4096]))
        width = min(4096, len(dense) - first)
        a, b = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        pick = number[column_l] >= 0
        a[owner_l[pick], number[column_l[pick]]] = 1
        pick = number[column_r] >= 0
        b[owner_r[pick], number[column_r[pick]]] = 1
        out += a @ b.T
    # Each entry of the left meets the right's entries of the same shingle.
    rows = np.flatnonzero(~many[column_l])
    start_r = np.concatenate([[0], np.cumsum(n_r)])
    for first in range(0, len(rows), 100_000):
        part = rows[first:first + 100_000]
        times = n_r[column_l[part]]
        ends = np.cumsum(times)
        where = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - times, times) + np.repeat(start_r[column_l[part]], times)
        flat = np.bincount(np.repeat(owner_l[part], times) * len(right) + owner_r[where], minlength=out.size)
        out += flat.reshape(out.shape)
    return out


def block_links(placed: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links ``a, b`` between ``outside`` members of a ``key`` and all its members of other components.

    ``placed`` has ``key, doc_id, component, outside``. Both sides of a key are dealt out in blocks
    of bounded size; each pair of blocks is one group.
    """
    kind = placed.schema["doc_id"].dataType.simpleString()
    totals = placed.groupBy("key").agg(F.sum(F.col("outside").cast("long")).alias("s"), F.count("*").alias("m")).where("s > 0 and m > 1")
    parts = totals.select("key", F.ceil(F.col("s") / BLOCK_DOCS).alias("sp"), F.ceil(F.col("m") / BLOCK_DOCS).alias("mp"))
    dealt = placed.join(parts, "key").withColumn("x", F.pmod(F.xxhash64("doc_id"), F.col("sp"))).withColumn("y", F.pmod(F.xxhash64("doc_id"), F.col("mp")))
    left = dealt.where("outside").withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mp") - 1)))
    right = dealt.withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sp") - 1)))
    by = ["key", "x", "y"]
    one, two = (side.select(*by, "doc_id", "component").join(texts, "doc_id") for side in (left, right))
    two = two.select(*[F.col(c).alias(c) for c in two.columns])

    def run(keys: tuple[pa.Scalar, ...], asked: pa.Table, held: pa.Table) -> pa.Table:
        empty = pa.table({"a": asked.column("doc_id")[:0], "b": asked.column("doc_id")[:0]})
        if not len(asked) or not len(held):
            return empty
        sides = [list(shingle_sets(t.column("text").combine_chunks(), words)) for t in (asked, held)]
        size_l, size_r = (np.array([len(s) for s in side], np.int64) for side in sides)
        common = overlaps(*sides).astype(np.int64)
        close = 100 * common >= percent * (size_l[:, None] + size_r[None, :] - common)
        close &= asked.column("component").to_numpy()[:, None] != held.column("component").to_numpy()[None, :]
        i, j = np.nonzero(close)
        return pa.table({"a": asked.column("doc_id").to_numpy()[i], "b": held.column("doc_id").to_numpy()[j]}).cast(empty.schema)

    found = one.groupBy(*by).cogroup(two.groupBy(*by)).applyInArrow(run, f"a {kind}, b {kind}")
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def covered(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, component, size, common`` of members ``doc_id, component`` that may have links outside.

    ``common`` is how many shingles of the document occur in another component too. Links need at
    least ``percent`` of the document's own shingles to do so.
    """
    kind = members.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), words))
            sizes = np.array([len(s) for s in sets], np.int64)
            owner = pa.array(np.repeat(np.arange(len(sets)), sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owner), batch.column("component").take(owner), pa.array(np.repeat(sizes, sizes)),
                 pa.array(np.concatenate([np.zeros(0, U), *sets]).view(np.int64))],
                names=["doc_id", "component", "size", "h"],
            )

    own = texts.join(members, "doc_id").select("doc_id", "component", "text")
    shingles = materialise(own.mapInArrow(run, f"doc_id {kind}, component {kind}, size long, h long"), "shingles")
    across = shingles.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("h")
    found = shingles.join(across, "h", "left_semi").groupBy("doc_id", "component", "size").agg(F.count("*").alias("common"))
    return found.where(F.col("common") * 100 >= F.col("size") * percent)


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, permutations: int = PERMUTATIONS, rows: int = BAND_ROWS
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``doc_id, text``.

    Null and empty texts have no shingles and are linked with nothing. Rows without an id are
    linked with nothing either, have no component and are kept. Rows that share an id are one
    document with several texts. Ties go to the smallest id.
    """
    known = materialise(signatures(docs, words, permutations, rows), "signatures")
    usable = known.where("n_shingles > 0 and doc_id is not null")
    classes = materialise(usable.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    chosen = usable.join(classes.withColumnRenamed("rep", "doc_id"), ["d1", "d2", "n_shingles", "doc_id"], "left_semi")
    places = chosen.select("doc_id", F.explode("bands").alias("key"))
    shared = places.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("b")).where("n > 1")
    members = materialise(places.join(shared.select("key", "b"), "key").distinct(), "buckets")
    wanted = members.select("doc_id").distinct()
    texts = materialise(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(wanted, "doc_id", "left_semi"), "texts")

    pairs = members.select(F.col("doc_id").alias("a"), "b").where("a <> b").distinct()
    links = [materialise(confirmed(pairs, texts, words, percent), "confirmed")]
    for turn in range(CENTRE_ROUNDS):
        labels = materialise(connected_components(reduce(DataFrame.unionByName, links)), "components")
        placed = members.select("key", "doc_id").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        placed = placed.withColumn("component", F.coalesce("component", "doc_id"))
        # One row for each bucket and component, then the component that holds most of the bucket.
        held = placed.groupBy("key", "component").agg(
            F.count("*").alias("n"), F.min(F.struct(F.xxhash64("doc_id", F.lit(turn)), "doc_id")).alias("centre")
        )
        most = held.groupBy("key").agg(F.max(F.struct("n", "component", F.col("centre.doc_id").alias("b"))).alias("main"), F.count("*").alias("parts")).where("parts > 1")
        most = materialise(most.select("key", F.col("main.component").alias("largest"), F.col("main.b").alias("b")), "split-buckets")
        outside = materialise(placed.join(most, "key").where("component <> largest").select("key", "doc_id", "component", "b"), "outside")
        if outside.isEmpty():
            break
        if turn < CENTRE_ROUNDS - 1:
            pairs = outside.select(F.col("doc_id").alias("a"), "b").distinct()
        else:
            here = placed.join(most.select("key"), "key", "left_semi")
            able = covered(here.select("doc_id", "component").distinct(), texts, words, percent).select("doc_id")
            able = materialise(able.distinct(), "covered")
            marked = here.join(able, "doc_id").join(most.select("key", "largest"), "key")
            marked = marked.select("key", "doc_id", "component", (F.col("component") != F.col("largest")).alias("outside"))
            links.append(materialise(block_links(marked, texts, words, percent), "confirmed"))
            continue
        links.append(materialise(confirmed(pairs, texts, words, percent), "confirmed"))
    else:
        labels = connected_components(reduce(DataFrame.unionByName, links))
    found = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "d1", "d2", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    alone = F.col("n_shingles") == 0
    return (
        known.select("doc_id", "n_shingles", "d1", "d2")
        .join(found, ["d1", "d2", "n_shingles"], "left")
        .select("doc_id", "n_shingles", F.when(alone | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
