"""Removal of byte strings that also start in an earlier document, with suffix arrays.

Every window of 50 bytes belongs to the smallest hash of the 16-byte groups in it, so equal windows
belong to the same hash wherever they stand, and windows in a row mostly share theirs: such a run is
a segment. Hashes that only one document has cannot hold repeated windows and go first. For each
other hash the windows are told apart by more of the bytes around its group, since most segments only
share little more than that; those of several documents are put in a row and sorted by a suffix
array, built by linear grouping; neighbours in the order that agree in 50 bytes are equal windows,
and each window gets the smallest document that has it. Documents then look up their segments.

Documents that are copies as a whole are settled by their digest. A hash that more documents have
than fit a task is dealt out by the first bytes of each window, so no group grows with one passage.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.llm.common import python_tasks
from lotledger.llm.shingles import BYTE_VALUES, U, mix, parts, text_bytes
from lotledger.llm.suffix_groups import _ranges, suffix_arrays
from lotledger.session import materialise

WINDOW = 50
LIST_BYTES = 16 << 10  # text that one list of a block's hashes in a bucket stands for
BLOCK_BYTES = 48 << 20  # most text of a block of documents
BUCKET_HASHES = 4_000_000  # most hashes of a bucket
HOT_BLOCKS = 100_000  # a hash that more texts have (half as many count at least) is dealt out by windows
SORTED_BYTES = 3 << 20  # text whose segments one group of hashes sorts
GROUP_BYTES = 2_048  # longest row of segments that is sorted as one string
BATCH_BYTES = 2 << 20  # strings that are sorted together
_P = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93)]


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place on."""
    h = data.astype(U) + U(1)
    for factor, step in zip(_P, (1, 2, 4, 8), strict=True):
        h = h[:-step] * factor + h[step:]
    return mix(h)


def runs(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with the same smallest hash: text, first window, windows, hash."""
    grams = window - 15
    for first, last in parts(offsets):
        low, high = offsets[first], offsets[last]
        if high - low < window:
            continue
        h = _grams(data[low:high])
        reach = 1
        while reach < grams:
            step = min(reach, grams - reach)
            h = np.minimum(h[:-step], h[step:])
            reach += step
        bounds = offsets[first:last + 1] - low
        owner = np.repeat(np.arange(first, last), np.diff(bounds))
        at = np.flatnonzero(owner[:len(h)] == owner[window - 1:])
        if not len(at):
            continue
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (h[at[1:]] != h[at[:-1]])
        heads = np.flatnonzero(new)
        begin = at[heads]
        yield owner[begin], begin - bounds[owner[begin] - first], np.diff(heads, append=len(at)), h[begin]


def _all_runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    data, offsets = text_bytes(column)
    found = [np.concatenate(x) for x in zip(*runs(data, offsets), strict=True)]
    return data, offsets, found or [np.zeros(0, np.int64)] * 3 + [np.zeros(0, U)]


def _values(starts: np.ndarray, lengths: np.ndarray, data: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Pieces of ``data`` as a binary column, null where not valid."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    buffers = [np.packbits(valid, bitorder="little"), offsets, data[_ranges(starts, lengths)]]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [pa.py_buffer(b) for b in buffers]).cast(pa.binary())


def _bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a binary column in a row, and where each begins and ends."""
    values = pa.concat_arrays(column.cast(pa.large_binary()).chunks or [pa.array([], pa.large_binary())])
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2] or b"", np.uint8), offsets


class _Pieces:
    """Hashes of any pieces of ``data``, from sums over its bytes; equal pieces have equal ones."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        powers = np.cumprod(np.full(len(data), _P[0], U), dtype=U)
        self.inverse = np.cumprod(np.full(len(data) + 1, pow(int(_P[0]), -1, 1 << 64), U), dtype=U)
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(BYTE_VALUES[0][data] * powers, dtype=U)])

    def hashes(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix((self.sums[high] - self.sums[low]) * self.inverse[low])

    def equal(self, one: np.ndarray, other: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Whether the pieces of these lengths have the same bytes, compared one by one."""
        if not len(lengths):
            return np.zeros(0, bool)
        same = self.data[_ranges(one, lengths)] == self.data[_ranges(other, lengths)]
        return np.logical_and.reduceat(same, np.cumsum(lengths) - lengths)


def first_documents(h: np.ndarray, data: np.ndarray, lengths: np.ndarray, docs: np.ndarray, window: int, longest: int) -> np.ndarray:
    """For each window of all segments the smallest document that has it.

    ``data`` holds the segments in a row, ``h`` the hash of each. Windows of a segment lie in a row
    in the result, segment after segment. Strings over ``longest`` bytes are dealt out before they are sorted.
    """
    begins = np.cumsum(lengths) - lengths
    counts = lengths - window + 1
    owner = np.repeat(np.arange(len(h)), lengths)
    grams = _grams(data) if len(data) > 15 else np.zeros(0, U)
    hits = np.flatnonzero((grams == h[owner[:len(grams)]]) & (owner[:len(grams)] == owner[15:]))
    at = _ranges(begins, counts)
    # The group of bytes that gave a window its hash; windows dealt out singly may have none.
    low = np.append(hits, len(data))[np.searchsorted(hits, at)]
    low = np.where(low <= at + window - 16, low, at)
    return _solve(_Pieces(data), begins, counts, docs, low, low + 16, window, longest)


def _solve(pieces: _Pieces, starts, counts, docs, low, high, window: int, longest: int) -> np.ndarray:
    """``first_documents`` of runs of windows; all windows that may be equal share the bytes from ``low`` to ``high``.

    These bytes are a part of each window. They are made longer to the side where more of the
    window lies, by half of what is left, so equal windows still share theirs. Only runs that share
    them with another document's are sorted; runs that are equal as a whole count as one.
    """
    result = np.repeat(docs, counts)
    run = np.repeat(np.arange(len(counts)), counts)
    at = _ranges(starts, counts)
    left = window - (high - low)
    to_left = low - at >= (left + 1) // 2
    to_left &= left > 0
    low = np.where(to_left, low - (left + 1) // 2, low)
    high = np.where(to_left | (left == 0), high, high + left // 2 + 1)
    new = np.ones(len(at), bool)
    new[1:] = (run[1:] != run[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    heads = np.flatnonzero(new)
    sizes = np.diff(heads, append=len(at))
    first, doc = at[heads], docs[run[heads]]
    shared = pieces.hashes(low[heads], high[heads])
    # Only where several documents share these bytes can windows be equal.
    order = np.argsort(shared, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], shared[order][1:] != shared[order][:-1]]))
    several = np.minimum.reduceat(doc[order], cuts) < np.maximum.reduceat(doc[order], cuts)
    order = order[np.repeat(several, np.diff(cuts, append=len(order)))]
    if not len(order):
        return result
    heads, sizes, first, doc, shared = (x[order] for x in (heads, sizes, first, doc, shared))
    # Equal runs are one unit, with their smallest document.
    whole = pieces.hashes(first, first + sizes + window - 1)
    order = np.lexsort((doc, whole, sizes, shared))
    heads, sizes, first, doc, shared, whole = (x[order] for x in (heads, sizes, first, doc, shared, whole))
    new = np.ones(len(order), bool)
    new[1:] = (shared[1:] != shared[:-1]) | (sizes[1:] != sizes[:-1]) | (whole[1:] != whole[:-1])
    least = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    again = np.flatnonzero(~new)
    new[again[~pieces.equal(first[again], first[least[again]], sizes[again] + window - 1)]] = True
    # A run that only has the hash of the unit before it is a unit of its own.
    unit = np.cumsum(new) - 1
    unit[again[~new[again]]] = unit[least[again[~new[again]]]]
    unit_first, unit_size, unit_doc, unit_shared = first[new], sizes[new], doc[new], shared[new]
    unit_at = np.cumsum(unit_size) - unit_size
    found = np.repeat(unit_doc, unit_size)
    unit_low, unit_left = low[heads[new]], (window - (high - low))[heads[new]]
    cuts = np.flatnonzero(np.concatenate([[True], unit_shared[1:] != unit_shared[:-1]]))
    units = np.diff(cuts, append=len(unit_shared))
    length = np.add.reduceat(unit_size + window, cuts) + 1
    mixed = np.minimum.reduceat(unit_doc, cuts) < np.maximum.reduceat(unit_doc, cuts)
    far = mixed & (length > longest) & (unit_left[cuts] > 0)
    near = np.flatnonzero(mixed & ~far)
    # Strings of like length advance together.
    near = near[np.argsort(length[near], kind="stable")]
    batch = np.cumsum(length[near]) // BATCH_BYTES
    for part in np.split(near, np.flatnonzero(np.diff(batch)) + 1):
        if len(part):
            members = _ranges(cuts[part], units[part])
            found[_ranges(unit_at[members], unit_size[members])] = _sorted(
                pieces.data, unit_first[members], unit_size[members], unit_doc[members], units[part], window)
    members = np.flatnonzero(np.repeat(far, units))
    if len(members):
        sizes_ = unit_size[members]
        low_ = np.repeat(unit_low[members], sizes_)
        found[_ranges(unit_at[members], sizes_)] = _solve(
            pieces, unit_first[members], sizes_, unit_doc[members], low_, low_ + window - np.repeat(unit_left[members], sizes_), window, longest)
    result[_ranges(heads, sizes)] = found[_ranges(unit_at[unit], sizes)]
    return result


def _sorted(data, first, sizes, docs, per_string, window: int) -> np.ndarray:
    """The smallest document of each window of the units, which lie in strings one after the other."""
    # Bytes count from 2; 1 ends a unit and 0 a string.
    lengths = sizes + window - 1
    last_of = np.cumsum(per_string) - 1
    extra = np.zeros(len(first), np.int64)
    extra[last_of] = 1
    begins = np.concatenate([[0], np.cumsum(lengths + 1 + extra)])
    text = np.zeros(int(begins[-1]), np.int16)
    text[_ranges(begins[:-1], lengths)] = data[_ranges(first, lengths)].astype(np.int16) + 2
    text[begins[:-1] + lengths] = 1
    starts = np.concatenate([[0], begins[1:][last_of]])
    order = suffix_arrays(text, starts)
    # Places of windows, and where each one's result lies.
    place = _ranges(begins[:-1], sizes)
    target = np.full(len(text), -1, np.int64)
    target[place] = np.arange(len(place))
    order = order[target[order] >= 0]
    string = np.repeat(np.arange(len(per_string)), np.diff(starts))[order]
    same = string[1:] == string[:-1]
    check = np.flatnonzero(same)
    raw = np.lib.stride_tricks.sliding_window_view(text.astype(np.uint8), window)
    for k in range(0, len(check), 200_000):
        part = check[k:k + 200_000]
        same[part] = (raw[order[part]] == raw[order[part + 1]]).all(axis=1)
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    order = target[order]
    least = np.minimum.reduceat(np.repeat(docs, sizes)[order], heads)
    result = np.empty(len(order), np.int64)
    result[order] = np.repeat(least, np.diff(heads, append=len(order)))
    return result


def _packed(h: np.ndarray) -> bytes:
    """The low 48 bits of each hash; equal ones by chance only cost a comparison."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(U)


def _key(segment: bytes) -> int:
    return int.from_bytes(blake2b(segment, digest_size=8).digest(), "little", signed=True)


def _prefix_hash(segment: bytes, key: int) -> int:
    return int.from_bytes(blake2b(segment[:8] + key.to_bytes(8, "little", signed=True), digest_size=8).digest(), "little", signed=True)


def _layout(size: int) -> tuple[int, int]:
    """Blocks of documents and buckets of hashes for so many bytes of text.

    Both grow as the root of the text, so there is a list of a block's hashes in a bucket for every
    ``LIST_BYTES`` at any size. Beyond some 140 GB of text blocks stop growing, so that they fit a task,
    and lists get shorter; there are never more than hashes.
    """
    even = math.isqrt(size // LIST_BYTES) + 1
    return max(even, -(-size // BLOCK_BYTES)), max(even, -(-size // 18 // BUCKET_HASHES))


def _earlier(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, tag, found`` of the first of each set of equal texts with a window or more.

    ``tag`` is a hash of the text, ``found`` lists segments with the smallest document of each of
    their windows; it is null where no window occurs in a smaller document.
    """
    texts = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    meta = texts.select("doc_id", F.octet_length("text").alias("n"), F.sha2("text", 256).alias("sha"), F.xxhash64("text").alias("tag"))
    firsts = materialise(meta.where(f"n >= {window}").groupBy("sha", "tag", "n").agg(F.min("doc_id").alias("doc_id")), "first-copies")
    size = firsts.agg(F.sum("n")).first()[0] or 0
    blocks, buckets = _layout(size)
    block = F.pmod(F.xxhash64("doc_id", F.lit("block")), F.lit(blocks)).cast("int").alias("block")
    mine = texts.where(F.octet_length("text") >= window).select(block, "doc_id", F.xxhash64("text").alias("tag"), "text")
    hot_texts = HOT_BLOCKS

    def listed(keys: tuple[pa.Scalar, ...], own: pa.Table) -> pa.Table:
        """A block's hashes by bucket, and the number of bits in which one counts its texts."""
        owner, _, _, h = _all_runs(own.column("text").combine_chunks())[2]
        tags = own.column("tag").to_numpy()[owner] if len(owner) else np.zeros(0, np.int64)
        to = ((h >> U(32)) % U(buckets)).astype(np.int64)
        order = np.lexsort((tags, h, to))
        to, h, tags = to[order], h[order], tags[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        heads = np.flatnonzero(new)
        new[1:] |= tags[1:] != tags[:-1]
        bits = np.frexp(np.add.reduceat(new, heads, dtype=np.int64))[1].astype(np.uint8) if len(heads) else np.zeros(0, np.uint8)
        to, h = to[heads], h[heads]
        cuts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(h) else np.zeros(0, int)
        ends = np.append(cuts[1:], len(h)).tolist()
        spans = list(zip(cuts.tolist(), ends, strict=True)) if len(h) else []
        return pa.table({
            "bucket": pa.array(to[cuts], pa.int32()), "block": pa.array([keys[0].as_py()] * len(cuts), pa.int32()),
            "hashes": pa.array([_packed(h[i:j]) for i, j in spans], pa.binary()),
            "bits": pa.array([bits[i:j].tobytes() for i, j in spans], pa.binary()),
        })

    def judged(keys: tuple[pa.Scalar, ...], lists: pa.Table) -> pa.Table:
        """Which hashes of each block other texts have too, and which very many texts have."""
        values = [_unpacked(b) for b in lists.column("hashes").to_pylist()]
        bits = np.frombuffer(b"".join(lists.column("bits").to_pylist()), np.uint8)
        _, inverse = np.unique(np.concatenate(values), return_inverse=True)
        texts_ = np.bincount(inverse, weights=np.exp2(bits.astype(np.float64) - 1))[inverse]
        cuts = np.cumsum([len(v) for v in values])[:-1]
        out = [
            (b, _packed(v[s]), np.packbits(o[s]).tobytes())
            for b, v, s, o in zip(lists.column("block").to_pylist(), values, np.split(texts_ > 1, cuts), np.split(texts_ > hot_texts, cuts), strict=True) if s.any()
        ]
        b, v, o = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"block": pa.array(b, pa.int32()), "hashes": pa.array(v, pa.binary()), "hot": pa.array(o, pa.binary())})

    lists = mine.groupBy("block").applyInArrow(listed, "bucket int, block int, hashes binary, bits binary")
    shared = lists.groupBy("bucket").applyInArrow(judged, "block int, hashes binary, hot binary")
    none = F.lit(None)
    alive = firsts.select(block, "doc_id", "tag", none.cast("binary").alias("hashes"), none.cast("binary").alias("hot"))
    side = shared.select("block", none.cast("long").alias("doc_id"), none.cast("long").alias("tag"), "hashes", "hot").unionByName(alive)

    def cut(keys: tuple[pa.Scalar, ...], own: pa.Table, facts: pa.Table) -> pa.Table:
        """Segments of the block's texts: one row for each occurrence, its bytes with one of them."""
        names = ["h", "k", "doc_id", "tag", "start", "segment", "least", "most"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        empty = pa.table({n: pa.array([], t) for n, t in zip(names, kinds, strict=True)})
        if not len(own) or not len(facts):
            return empty
        ids, tags = facts.column("doc_id").to_pylist(), facts.column("tag").to_pylist()
        alive_ = {(i, t) for i, t in zip(ids, tags, strict=True) if i is not None}
        keep, seen = [], set()
        for row in zip(own.column("doc_id").to_pylist(), own.column("tag").to_pylist(), strict=True):
            keep.append(row in alive_ and row not in seen)
            seen.add(row)
        own = own.filter(pa.array(keep))
        blobs = [x for x in facts.column("hashes").to_pylist() if x]
        if not len(own) or not blobs:
            return empty
        values = np.concatenate([_unpacked(x) for x in blobs])
        hot = np.concatenate([np.unpackbits(np.frombuffer(o, np.uint8), count=len(x) // 6) for o, x in zip(facts.column("hot").to_pylist(), facts.column("hashes").to_pylist(), strict=True) if x])
        values, at = np.unique(values, return_index=True)
        hot = hot[at]
        data, offsets, (owner, start, count, h) = _all_runs(own.column("text").combine_chunks())
        low = h & U((1 << 48) - 1)
        spot = np.minimum(np.searchsorted(values, low), len(values) - 1)
        found = np.flatnonzero(values[spot] == low)
        owner, start, count, h, warm = owner[found], start[found], count[found], h[found], hot[spot[found]] > 0
        doc, tag = own.column("doc_id").to_numpy(), own.column("tag").to_numpy()
        if not len(owner):
            return empty
        # Hot segments go window by window.
        pieces = np.where(warm, count, 1)
        of = np.repeat(np.arange(len(owner)), pieces)
        start = start[of] + _ranges(np.zeros(len(owner), np.int64), pieces)
        owner, warm, g = owner[of], warm[of], h.view(np.int64)[of]
        length = np.where(warm, 1, count[of]) + window - 1
        begin = offsets[owner] + start
        raw = data.tobytes()
        k = np.fromiter((_key(raw[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)), np.int64, len(begin))
        for i in np.flatnonzero(warm).tolist():
            g[i] = _prefix_hash(raw[begin[i]:begin[i] + 8], int(g[i]))
        order = np.lexsort((k, g))
        new = np.ones(len(order), bool)
        new[1:] = (g[order][1:] != g[order][:-1]) | (k[order][1:] != k[order][:-1])
        cuts = np.flatnonzero(new)
        head = np.zeros(len(order), bool)
        head[order[cuts]] = True
        ids_ = doc[owner]
        least, most = ids_.copy(), ids_.copy()
        least[order[cuts]] = np.minimum.reduceat(ids_[order], cuts)
        most[order[cuts]] = np.maximum.reduceat(ids_[order], cuts)
        columns = [pa.array(g), pa.array(k), pa.array(ids_), pa.array(tag[owner]), pa.array(start, pa.int32()),
                   _values(begin, np.where(head, length, 0), data, head), pa.array(least, mask=~head), pa.array(most, mask=~head)]
        return pa.table(dict(zip(names, columns, strict=True)))

    pieces = mine.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(
        cut, "h long, k long, doc_id long, tag long, start int, segment binary, least long, most long"
    )
    # Segments in a row overlap, which a stronger codec makes use of.
    pieces = materialise(pieces, "segments", codec="zstd")

    groups = max(1, -(-size // SORTED_BYTES))
    longest = GROUP_BYTES
    empty = pa.table({"h": pa.array([], pa.int64()), "k": pa.array([], pa.int64()), "first": pa.array([], pa.list_(pa.int64())), "lengths": pa.array([], pa.list_(pa.int32()))})

    def sorted_groups(keys: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        h, k, least, most = (table.column(c).to_numpy() for c in ("h", "k", "least", "most"))
        data, offsets = _bytes(table.column("segment"))
        # The same segment of several blocks is one.
        order = np.lexsort((k, h))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (k[order][1:] != k[order][:-1])
        cuts = np.flatnonzero(new)
        if not len(cuts):
            return empty
        at = order[cuts]
        h, k, least, most = h[at], k[at], np.minimum.reduceat(least[order], cuts), np.maximum.reduceat(most[order], cuts)
        starts, lengths = offsets[:-1][at], np.diff(offsets)[at]
        counts = lengths - window + 1
        first = np.repeat(least, counts)
        # A hash with one segment has nothing to compare.
        alone = np.ones(len(h), bool)
        alone[1:] &= h[1:] != h[:-1]
        alone[:-1] &= h[1:] != h[:-1]
        begins = np.cumsum(counts) - counts
        some = np.flatnonzero(~alone)
        if len(some):
            first[_ranges(begins[some], counts[some])] = first_documents(
                h[some].view(U), data[_ranges(starts[some], lengths[some])], lengths[some], least[some], window, longest)
        # Segments that a later document has a window of, as documents and numbers of windows in a row.
        kept = np.flatnonzero(np.minimum.reduceat(first, begins) < most)
        sizes = counts[kept]
        first = first[_ranges(begins[kept], sizes)]
        new = np.ones(len(first), bool)
        new[1:] = first[1:] != first[:-1]
        new[np.cumsum(sizes) - sizes] = True
        heads = np.flatnonzero(new)
        ends = np.searchsorted(heads, np.cumsum(sizes))
        lists = pa.array(np.concatenate([[0], ends]), pa.int32())
        return pa.table({
            "h": pa.array(h[kept]), "k": pa.array(k[kept]),
            "first": pa.ListArray.from_arrays(lists, pa.array(first[heads])),
            "lengths": pa.ListArray.from_arrays(lists, pa.array(np.diff(heads, append=len(first)), pa.int32())),
        })

    small = pieces.where("segment is not null").select("h", "k", "segment", "least", "most").withColumn("g", F.pmod(F.xxhash64("h"), F.lit(groups)))
    first = small.groupBy("g").applyInArrow(sorted_groups, "h long, k long, first array<long>, lengths array<int>")
    first = materialise(first, "first-documents")
    hits = pieces.select("h", "k", "doc_id", "tag", "start").join(first, ["h", "k"])
    hits = hits.where(F.exists("first", lambda d: d < F.col("doc_id")))
    found = hits.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "first", "lengths")).alias("found"))
    return firsts.select("doc_id", "tag").join(found, ["doc_id", "tag"], "left")


def _spans(doc_id: int, found: list[dict], window: int) -> tuple[list[int], list[int]]:
    """Where the bytes that are covered begin and end."""
    begins, ends = [], []
    for piece in found:
        at = piece["start"]
        for first, n in zip(piece["first"], piece["lengths"], strict=True):
            if first < doc_id:
                begins.append(at)
                ends.append(at + n - 1 + window)
            at += n
    if not begins:
        return [], []
    order = np.argsort(begins, kind="stable")
    begin, end = np.array(begins)[order], np.maximum.accumulate(np.array(ends)[order])
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    heads = np.flatnonzero(new)
    return begin[heads].tolist(), end[np.append(heads[1:], len(begin)) - 1].tolist()


def remove_repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_bytes, begins, ends, kept``: the spans that repeat, and the bytes that are left.

    A byte goes if it lies in ``window`` bytes that also start in a document with a smaller id, as
    the texts were. Null counts as empty. Rows without an id lose nothing and take nothing from
    others; rows that share an id take nothing from each other. Adjoining spans are one.
    """
    python_tasks(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    side = _earlier(docs, window).select(F.col("doc_id").alias("__doc"), F.col("tag").alias("__tag"), "found")
    own = docs.select("doc_id", text.alias("text")).withColumn("tag", F.xxhash64("text"))
    joined = own.join(side, (own["doc_id"].cast("long") == side["__doc"]) & (own["tag"] == side["__tag"]), "left")
    # A text that is long enough but not the first of its kind is a copy as a whole.
    copied = F.col("__doc").isNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") >= window)
    joined = joined.select("doc_id", F.col("text").cast("binary").alias("raw"), "found", copied.alias("copied"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, ends, kept, sizes = [], [], [], []
            for doc, raw, found, whole in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                begin, end = ([0], [len(raw)]) if whole else _spans(doc, found, window) if found else ([], [])
                kept.append(b"".join(raw[a:b] for a, b in zip([0, *end], [*begin, len(raw)], strict=True)) if begin else raw)
                begins.append(begin)
                ends.append(end)
                sizes.append(len(raw))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (begins, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists, pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "begins", "ends", "kept"],
            )

    schema = f"doc_id {kind}, n_bytes long, begins array<long>, ends array<long>, kept binary"
    return joined.mapInArrow(run, schema)
