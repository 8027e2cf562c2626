"""A hierarchical navigable small-world graph over one shard of unit vectors, in numpy.

Vectors enter in batches. A vector that lies within a small angle of a node already there joins
that node's ball instead of becoming a node, so thousands of copies cost one node. Searches run
for many queries at once: in every step each query opens the best nodes of its beam.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, field

import numpy as np

LINKS = 16  # of a node in upper layers; twice as many in the lowest
BUILD_BEAM = 48
BALL_COSINE = 0.99
OPENED = 4  # nodes of a beam that one step opens
VISITED_CELLS = 8 << 20


@dataclass
class Graph:
    vectors: np.ndarray  # unit nodes, single precision
    layers: list[np.ndarray]  # neighbours of each node by layer, -1 where there is none; lowest first
    level: np.ndarray
    entry: int = -1

    def beam(self, queries: np.ndarray, width: int, upto: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The best nodes found for each query, and their cosines, best first; -1 fills up."""
        ids = np.full((len(queries), width), -1, np.int32)
        sims = np.full((len(queries), width), -np.inf, np.float32)
        if self.entry < 0:
            return ids, sims
        step = max(1, VISITED_CELLS // len(self.vectors))
        for first in range(0, len(queries), step):
            part = queries[first:first + step]
            at = np.full((len(part), 1), self.entry, np.int32)
            for layer in range(len(self.layers) - 1, 0, -1):
                at, _ = self._layer(part, at, layer, 1)
            ids[first:first + step], sims[first:first + step] = self._layer(part, at, 0, width)
        return ids, sims

    def _layer(self, queries: np.ndarray, start: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        m, neighbours = len(queries), self.layers[layer]
        visited = np.zeros((m, len(self.vectors)), bool)
        rows = np.arange(m)
        ids = np.full((m, width), -1, np.int32)
        sims = np.full((m, width), -np.inf, np.float32)
        done = np.ones((m, width), bool)
        ids[:, 0] = start[:, 0]
        sims[:, 0] = np.einsum("ij,ij->i", self.vectors[start[:, 0]], queries)
        done[:, 0] = False
        visited[rows, start[:, 0]] = True
        live = rows
        opened = min(OPENED, width)
        while len(live):
            waiting = np.where(done[live], -np.inf, sims[live])
            best = np.argpartition(-waiting, opened - 1, axis=1)[:, :opened]
            some = np.take_along_axis(waiting, best, axis=1) > -np.inf
            going = some.any(axis=1)
            live, best, some = live[going], best[going], some[going]
            if not len(live):
                break
            opening = np.where(some, np.take_along_axis(ids[live], best, axis=1), -1)
            marks = done[live]
            np.put_along_axis(marks, best, True, axis=1)
            done[live] = marks
            near = np.where(opening[:, :, None] >= 0, neighbours[opening], -1).reshape(len(live), -1)
            fresh = (near >= 0) & ~visited[live[:, None], near]
            who, where = np.nonzero(fresh)
            found = near[who, where]
            visited[live[who], found] = True
            value = np.full(near.shape, -np.inf, np.float32)
            value[who, where] = np.einsum("ij,ij->i", self.vectors[found], queries[live[who]])
            # Two opened nodes may name the same neighbour: the second mention goes.
            order = np.argsort(near, axis=1, kind="stable")
            sorted_ids = np.take_along_axis(near, order, axis=1)
            again = np.zeros(near.shape, bool)
            np.put_along_axis(again, order[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], axis=1)
            value[again] = -np.inf
            all_ids = np.concatenate([ids[live], near], axis=1)
            all_sims = np.concatenate([sims[live], value], axis=1)
            all_done = np.concatenate([done[live], np.zeros(near.shape, bool)], axis=1)
            top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            sims[live] = np.take_along_axis(all_sims, top, axis=1)
            ids[live] = np.where(sims[live] > -np.inf, np.take_along_axis(all_ids, top, axis=1), -1)
            done[live] = np.take_along_axis(all_done, top, axis=1) | (ids[live] < 0)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)


def _spread(vectors: np.ndarray, candidates: np.ndarray, sims: np.ndarray, count: int) -> np.ndarray:
    """Neighbours in different directions: nearer to the node than to one already taken."""
    m, c = candidates.shape
    chosen = np.full((m, count), -1, np.int32)
    near = vectors[np.maximum(candidates, 0)]
    between = np.matmul(near, near.transpose(0, 2, 1))
    taken = np.zeros((m, c), bool)
    number = np.zeros(m, int)
    valid = (candidates >= 0) & (sims > -np.inf)
    for pass_ in range(2):  # first those apart, then the nearest of the rest
        for k in range(c):
            blocked = (np.where(taken, between[:, k, :], -np.inf).max(axis=1) >= sims[:, k]) if pass_ == 0 else False
            rows = np.flatnonzero(valid[:, k] & ~taken[:, k] & (number < count) & ~np.asarray(blocked))
            chosen[rows, number[rows]] = candidates[rows, k]
            taken[rows, k] = True
            number[rows] += 1
    return chosen


@dataclass
class Shard:
    """Vectors of a shard as balls around nodes of a graph; arrays are ordered by ball."""

    ids: np.ndarray
    vectors: np.ndarray  # unit vectors, double precision
    starts: np.ndarray  # of each ball; one more at the end
    radius: np.ndarray  # angle from the node to the farthest member
    graph: Graph = field(repr=False)

    def dump(self) -> bytes:
        out = io.BytesIO()
        arrays = {f"layer{i}": x for i, x in enumerate(self.graph.layers)}
        np.savez(out, ids=self.ids, vectors=self.vectors, starts=self.starts, radius=self.radius,
                 level=self.graph.level, entry=self.graph.entry, **arrays)
        return out.getvalue()

    @staticmethod
    def load(blob: bytes) -> Shard:
        with np.load(io.BytesIO(blob)) as data:
            layers = [data[f"layer{i}"] for i in range(sum(name.startswith("layer") for name in data.files))]
            starts, vectors = data["starts"], data["vectors"]
            graph = Graph(vectors[starts[:-1]].astype(np.float32), layers, data["level"], int(data["entry"]))
            return Shard(data["ids"], vectors, starts, data["radius"], graph)


def build(ids: np.ndarray, vectors: np.ndarray, seed: int = 7) -> Shard:
    """The shard of unit vectors; the same rows give the same graph in any order of arrival."""
    order = np.lexsort((*vectors.T[::-1], ids))
    order = order[np.random.Generator(np.random.PCG64(seed)).permutation(len(order))]
    ids, vectors = ids[order], vectors[order]
    n, single = len(ids), vectors.astype(np.float32)
    random = np.random.Generator(np.random.PCG64(seed + 1))
    levels_of = np.minimum((-np.log(1 - random.random(n)) / np.log(LINKS)).astype(int), 6)
    nodes: list[int] = []
    ball = np.empty(n, np.int64)
    graph = Graph(np.zeros((0, vectors.shape[1]), np.float32), [np.zeros((0, 2 * LINKS), np.int32)], np.zeros(0, int))
    first = 0
    while first < n:
        last = min(n, first + min(1024, max(64, len(nodes))))
        batch = np.arange(first, last)
        found, sims = graph.beam(single[batch], BUILD_BEAM)
        own = single[batch] @ single[batch].T
        fresh: list[int] = []  # places in the batch that become nodes
        for k in range(len(batch)):
            if found[k, 0] >= 0 and sims[k, 0] >= BALL_COSINE:
                ball[batch[k]] = found[k, 0]
            elif fresh and (best := own[k, fresh]).max() >= BALL_COSINE:
                ball[batch[k]] = len(nodes) + int(best.argmax())
            else:
                fresh.append(k)
                ball[batch[k]] = len(nodes) + len(fresh) - 1
        if fresh:
            _insert(graph, single[batch[fresh]], levels_of[batch[fresh]], found[fresh], sims[fresh])
            nodes.extend(batch[fresh].tolist())
        first = last
    # Order by ball, the node first.
    is_node = np.zeros(n, bool)
    is_node[nodes] = True
    order = np.lexsort((ids, ~is_node, ball))
    starts = np.searchsorted(ball[order], np.arange(len(nodes) + 1))
    ids, vectors = ids[order], vectors[order]
    cosine = np.einsum("ij,ij->i", vectors, vectors[starts[:-1]][ball[order]])
    angle = np.arccos(np.clip(cosine, -1, 1))
    angle[starts[:-1]] = 0.0
    radius = np.maximum.reduceat(angle, starts[:-1]) if n else np.zeros(0)
    return Shard(ids, vectors, starts, radius, graph)


def _insert(graph: Graph, new: np.ndarray, level: np.ndarray, found: np.ndarray, sims: np.ndarray) -> None:
    before, count = len(graph.vectors), len(new)
    graph.vectors = np.concatenate([graph.vectors, new])
    graph.level = np.concatenate([graph.level, level])
    for layer in range(max(len(graph.layers), int(level.max()) + 1)):
        if layer == len(graph.layers):
            graph.layers.append(np.full((before, LINKS), -1, np.int32))
        width = graph.layers[layer].shape[1]
        graph.layers[layer] = np.concatenate([graph.layers[layer], np.full((count, width), -1, np.int32)])
        members = np.flatnonzero(level >= layer)
        if not len(members):
            continue
        own = new[members] @ new[members].T
        np.fill_diagonal(own, -np.inf)
        if layer == 0:
            old_ids, old_sims = found[members], sims[members]
        else:  # upper layers are small: their nodes are compared directly
            there = np.flatnonzero(graph.level[:before] >= layer)
            near = new[members] @ graph.vectors[there].T
            top = np.argsort(-near, axis=1)[:, :BUILD_BEAM]
            old_ids, old_sims = there[top].astype(np.int32), np.take_along_axis(near, top, axis=1)
        top = np.argsort(-own, axis=1)[:, :BUILD_BEAM]
        candidates = np.concatenate([old_ids, (before + members[top]).astype(np.int32)], axis=1)
        values = np.concatenate([old_sims, np.take_along_axis(own, top, axis=1)], axis=1)
        order = np.argsort(-values, axis=1, kind="stable")[:, :BUILD_BEAM]
        candidates, values = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(values, order, axis=1)
        candidates = np.where(values > -np.inf, candidates, -1)
        for k in range(0, len(members), 256):
            part = slice(k, k + 256)
            chosen = _spread(graph.vectors, candidates[part], values[part], LINKS)
            rows = before + members[part]
            graph.layers[layer][rows, :LINKS] = chosen
            _link_back(graph, layer, np.repeat(rows, LINKS), chosen.ravel())
    if graph.entry < 0 or level.max() > graph.level[graph.entry]:
        graph.entry = before + int(level.argmax())


def _link_back(graph: Graph, layer: int, source: np.ndarray, target: np.ndarray) -> None:
    links = graph.layers[layer]
    width = links.shape[1]
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, at = np.unique(target, return_index=True)
    for node, begin, end in zip(nodes, at, np.append(at[1:], len(target))[:len(at)], strict=True):
        have = links[node]
        both = np.unique(np.concatenate([have[have >= 0], source[begin:end]]))
        if len(both) > width:
            both = both[np.argsort(-(graph.vectors[both] @ graph.vectors[node]), kind="stable")[:width]]
        links[node] = -1
        links[node, :len(both)] = both


def within(shard: Shard, queries: np.ndarray, least: np.ndarray, width: int = 32, audit: int = 64, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) with a cosine of at least ``least`` (one for each query).

    A beam full of hits is widened for its query. An audit compares a sample of queries with all
    nodes; while it finds a miss, all beams are doubled. A beam as wide as the graph is exact.
    """
    n, m = len(shard.graph.vectors), len(queries)
    if not n or not m:
        return np.zeros(0, int), np.zeros(0, int)
    sample = np.arange(m) if m <= audit else np.sort(np.random.Generator(np.random.PCG64(seed)).permutation(m)[:audit])
    truth = (queries[sample] @ shard.graph.vectors.T) >= least[sample, None]
    hits: list[np.ndarray] = [np.zeros(0, np.int64)] * m
    pending = np.arange(m)
    while True:
        redo = []
        if width * 4 >= n:  # the beam would hold much of the graph: all nodes are compared
            for first in range(0, len(pending), 512):
                rows = pending[first:first + 512]
                close = (queries[rows] @ shard.graph.vectors.T) >= least[rows, None]
                for row, mask in zip(rows, close, strict=True):
                    hits[row] = np.flatnonzero(mask)
        else:
            ids, sims = shard.graph.beam(queries[pending], width)
            good = (ids >= 0) & (sims >= least[pending, None])
            full = good.all(axis=1)
            for row, own, mask in zip(pending, ids, good, strict=True):
                hits[row] = own[mask]
            redo = pending[full]
        missed = any(truth[k].sum() > len(hits[row]) for k, row in enumerate(sample) if row not in set(redo))
        width *= 2
        pending = np.arange(m) if missed else np.asarray(redo, int)
        if not len(pending):
            break
    who = np.repeat(np.arange(m), [len(h) for h in hits])
    return who, np.concatenate(hits).astype(int)
