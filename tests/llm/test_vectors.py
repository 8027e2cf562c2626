"""Search and links of embeddings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotledger.llm import hnsw, onebit_search, queries, vector_links

NAN, INF = float("nan"), float("inf")


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def table(spark, vectors, ids=None):
    rows = [(i, [None if c is None else float(c) for c in v] if v is not None else None) for i, v in zip(ids or range(len(vectors)), vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))


def ODD():
    return [None, [], [0.0, 0.0], [NAN, 1.0], [INF, 1.0], [None, 1.0]]


def test_codes_estimate_without_bias():
    random = np.random.default_rng(0)
    x, q = random.standard_normal((4000, 64)), random.standard_normal(64)
    code, distance, fit = onebit_search.encode(x, np.zeros(64))
    bits = np.unpackbits(code, axis=1).astype(float) * 2 - 1
    estimate = bits @ (q @ onebit_search.rotation(64)) / 8 * distance / fit
    error = estimate - x @ q
    assert abs(error.mean()) < 0.3
    bound = onebit_search.BOUND * np.linalg.norm(q) * distance * np.sqrt(1 - fit**2) / fit / np.sqrt(63)
    assert (np.abs(error) <= bound).mean() > 0.97 and code.shape == (4000, 8)


def brute_nearest(vectors, k, step):
    out = {}
    for q in range(0, len(vectors), step):
        score = (vectors * vectors[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(len(vectors)), -score)) if i != q][:k]
        out[q] = [(i, score[i]) for i in order]
    return out


def test_search_against_brute_force_with_ties(spark):
    random = np.random.default_rng(1)
    x = random.standard_normal((300, 13)) * random.uniform(0.1, 3, (300, 1))
    x[50:70] = x[0]
    got = onebit_search.nearest(table(spark, x), lambda c: c % 20 == 0, block_rows=64, query_rows=8).collect()
    want = brute_nearest(x, 20, 20)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found.keys() == want.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.97 * 20 * len(want)
    assert [i for i, _ in found[0]][:20] == [i for i, _ in want[0]]


def test_search_of_odd_vectors(spark):
    odd = [*ODD(), [1.0, 2.0], [2.0, 1.0], [1.0, 2.0], [1.0, 1.0, 1.0]]
    got = onebit_search.nearest(table(spark, odd, [0, 20, 40, 60, 80, 100, 120, 1, 2, 140]), lambda c: c % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(120, 1, 2, 5.0), (120, 2, 1, 4.0)]
    assert onebit_search.nearest(table(spark, []), lambda c: c % 20 == 0).collect() == []


@pytest.mark.parametrize("size", [1e-200, 1e25, 1e100, 1e160])
def test_search_of_components_of_any_size(spark, size):
    x = np.random.default_rng(4).standard_normal((400, 12))
    got = onebit_search.nearest(table(spark, x * size), lambda c: c % 20 == 0, block_rows=100).collect()
    if size == 1e160:  # each product is beyond the range of doubles: all that is positive is infinite
        want = {q: {i for i in range(400) if i != q and x[i] @ x[q] > 0} for q in range(0, 400, 20)}
        assert len(got) == 400 and all(r.score == INF and r.vec_id in want[r.query_id] for r in got)
    else:
        want = {q: {i for i, _ in w} for q, w in brute_nearest(x, 20, 20).items()}
        assert sum(r.vec_id in want[r.query_id] for r in got) >= 0.97 * 400 or size == 1e-200
        assert len(got) == 400 and all(r.score == ((x[r.vec_id] * size) * (x[r.query_id] * size)).sum() for r in got)


def test_search_of_sizes_side_by_side(spark):
    random = np.random.default_rng(5)
    x = random.standard_normal((300, 12)) * np.where(np.arange(300) % 3 == 0, 1e25, 1.0)[:, None]
    got = onebit_search.nearest(table(spark, x), lambda c: c % 20 == 0, block_rows=64).collect()
    want = {q: {i for i, _ in w} for q, w in brute_nearest(x, 20, 20).items()}
    assert sum(r.vec_id in want[r.query_id] for r in got) >= 0.97 * 20 * len(want)


def test_search_query_recall(spark):
    path = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").orderBy("vec_id").collect()
    want = brute_nearest(np.array([r.embedding for r in rows], float), 20, 20)
    got = {}
    for r in queries.op1_onebit_search(spark, path).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {i for i, _ in w}) for q, w in want.items()) >= 0.99 * 20 * len(want)


def test_graph_finds_all_within_reach():
    random = np.random.default_rng(2)
    centres = unit(random.standard_normal((700, 24)))
    x = unit(np.concatenate([centres, centres[:200] + 0.05 * random.standard_normal((200, 24)), np.repeat(centres[:1], 150, axis=0) + 0.001 * random.standard_normal((150, 24))]))
    shard = hnsw.build(np.arange(len(x)), x)
    assert len(shard.graph.vectors) < len(x) - 140 and sorted(shard.ids.tolist()) == list(range(len(x)))
    q = x.astype(np.float32)
    who, what = hnsw.within(shard, q, np.full(len(q), 0.9, np.float32), width=8)
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(q @ shard.graph.vectors.T >= 0.9), strict=True)}
    assert len(want & set(zip(who.tolist(), what.tolist(), strict=True))) >= 0.999 * len(want)
    again = hnsw.build(np.arange(len(x))[::-1].copy(), x[::-1].copy())
    assert (again.ids == shard.ids).all() and (hnsw.Shard.load(shard.dump()).graph.layers[0] == shard.graph.layers[0]).all()


def test_pair_found_from_one_side_counts(monkeypatch):
    x = unit(np.random.default_rng(6).standard_normal((40, 8)))
    x = unit(np.concatenate([x, x + 0.2 * np.random.default_rng(7).standard_normal((40, 8))]))
    shard = hnsw.build(np.arange(len(x)), x)
    both = vector_links.compare(shard, shard, True, 0.9)
    whole = hnsw.within
    def one_sided(keep):
        def some(*args):
            who, what = whole(*args)
            return who[keep(who, what)], what[keep(who, what)]
        return some
    for keep in (lambda a, b: a > b, lambda a, b: a < b):
        monkeypatch.setattr(hnsw, "within", one_sided(keep))
        assert vector_links.compare(shard, shard, True, 0.9) == both and both[1]


def test_links_of_a_shard_that_is_walked(spark):
    """More nodes than the widest beam covers at once, so that links are found through the graph."""
    random = np.random.default_rng(8)
    centres = unit(random.standard_normal((2500, 32)))
    x = unit(np.concatenate([centres, centres[:300] + 0.06 * random.standard_normal((300, 32))]))
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    got = vector_links.near_duplicates(table(spark, x), shards=1).orderBy("vec_id").collect()
    found = np.array([r.n_links for r in got])
    assert (found <= close.sum(axis=1)).all() and found.sum() >= 0.99 * close.sum()


@pytest.mark.parametrize("noise", [0.002, 0.06, 0.15])
def test_links_against_brute_force(spark, noise):
    random = np.random.default_rng(3)
    centres = random.standard_normal((60, 16))
    x = np.concatenate([centres, centres[random.integers(0, 20, 200)] + noise * random.standard_normal((200, 16)), np.repeat(centres[:1], 60, axis=0)])
    u = unit(x)
    close = u @ u.T >= 0.9
    np.fill_diagonal(close, False)
    parent = np.arange(len(x))
    for _ in range(len(x)):
        low = np.minimum(parent, np.where(close, parent[None, :], len(x)).min(axis=1))
        if (low == parent).all():
            break
        parent = low
    got = vector_links.near_duplicates(table(spark, x), shards=3).orderBy("vec_id").collect()
    assert [r.n_links for r in got] == close.sum(axis=1).tolist()
    assert [r.component_id for r in got] == parent.tolist() and all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_links_of_odd_vectors(spark):
    odd = [*ODD(), [1.0, 2.0], [2.0, 4.0], [1.0, 2.0], [1.0, 1.0, 1.0], [1.0, 2.0]]
    got = vector_links.near_duplicates(table(spark, odd, [0, 1, 2, 3, 4, 5, 12, 9, 9, 30, None])).collect()
    found = sorted(((r.vec_id if r.vec_id is not None else -1), r.n_links, r.component_id, r.kept) for r in got)
    assert found == [(-1, 0, None, True), *((i, 0, i, True) for i in range(6)), (9, 4, 9, True), (9, 4, 9, True), (12, 2, 9, False), (30, 0, 30, True)]
    assert vector_links.near_duplicates(table(spark, [])).collect() == []
