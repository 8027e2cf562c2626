"""Removal of repeated passages by content-defined chunks of lines.

A rolling hash over the hashes of two lines in a row tells where a chunk ends, so chunks of a
passage come out alike wherever the passage stands. A chunk has several lines; a line with as
many words as a passage ends the chunk before it and is one in itself. Chunks are compared by a
256-bit digest of their bytes; the first of equal ones stays.

Passages that are no chunks of lines, inside a line or over a few short ones, are found by words.
Each run of 50 words belongs to the smallest hash of the 16-word groups in it, so equal runs share
theirs wherever they stand; runs in a row with one hash are a segment. Equal segments repeat as a
whole. Where a hash has several segments, each one's runs are compared, by a digest of their bytes;
the digests of a segment lie in one row, and those of many hashes are sorted together.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotledger.llm.common import python_tasks
from lotledger.llm.shingles import SPACE, U, mix, parts, text_bytes
from lotledger.llm.suffix_groups import _ranges
from lotledger.session import discard, materialise

ENDS_ONE_IN = 3  # a boundary follows one line in so many
BUCKET_WINDOWS = 500_000  # windows that are compared together
HOT_KINDS = 2_000  # a hash with more different segments, or a longer one, has its windows compared in a join
BUCKET_HASHES = 1_000_000  # hashes that are looked through together for those that stand twice
RANGE_BYTES = 1 << 17  # texts whose words are hashed together: working arrays of ten times that stay near the CPU
LIST_SEGMENTS = 1 << 16  # segments, and chunks, in a row of their lists, at most
PASSAGE_WORDS = 50  # a line of so many words is a chunk in itself
_FACTOR = 0x9E3779B97F4A7C15
_BYTES = np.random.Generator(np.random.PCG64(20_240_602)).integers(1, 1 << 64, 256, dtype=U)
#: Powers of the factor and of its inverse, for ranges of texts of the usual size.
_POWERS, _INVERSE = (np.cumprod(np.full(RANGE_BYTES * 5 // 4, x, U), dtype=U) for x in (_FACTOR, pow(_FACTOR, -1, 1 << 64)))
#: Bytes that are no space of one byte, and those that spaces of more bytes begin with in UTF-8.
_INSIDE = ~SPACE
_INSIDE[0x1C:0x20] = False
_WIDE_BEGIN = np.zeros(256, bool)
_WIDE_BEGIN[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Those spaces that ``str.split`` knows, as numbers of three bytes; of the first two, the third is any byte.
_WIDE_TWO = np.array([0xC285, 0xC2A0])
_WIDE_THREE = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])


def chunks(text: str | None, passage_words: int = PASSAGE_WORDS) -> list[tuple[int, int, bytes]]:
    """``(first line, line after the last, digest)`` of each chunk; a lone short line is none."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass") + b"\n"
    _, first, last, keys = _chunks(raw, words(raw)[0], np.array([0, len(raw)]), passage_words)
    return list(zip(first.tolist(), last.tolist(), keys, strict=True))


def _lines(raw: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each line begins and ends, and the first line of each text."""
    stops = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
    return np.append(0, stops[:-1] + 1), stops, np.searchsorted(stops, bounds)


def _chunks(raw: bytes, begin: np.ndarray, bounds: np.ndarray, passage_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Chunks of lines of texts in a row: text, first line, line after the last, digest."""
    starts, stops, lines_at = _lines(raw, bounds)
    raws = b"".join([blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(starts.tolist(), stops.tolist(), strict=True)])
    h = np.frombuffer(raws, "<u8").astype(U)
    long = np.diff(np.searchsorted(begin, np.append(starts, len(raw)))) >= passage_words
    for i in np.flatnonzero(long).tolist():
        long[i] = raw.count(b" ", starts[i], stops[i]) + 1 >= passage_words
    ends = np.append(False, ((h[:-1] * U(_FACTOR) + h[1:]) >> U(32)) % U(ENDS_ONE_IN) == 0)
    marks = np.flatnonzero(ends | long)
    marked = zip(marks.tolist(), long[marks].tolist(), strict=True)
    found, (i, alone) = [], next(marked, (len(stops), False))
    for text, (first, end) in enumerate(zip(lines_at.tolist(), lines_at[1:].tolist(), strict=False)):
        while i < end:
            if alone:
                if i - first > 1:
                    found.append((text, first, i))
                found.append((text, i, i + 1))
                first = i + 1
            elif i > first:
                found.append((text, first, i + 1))
                first = i + 1
            i, alone = next(marked, (len(stops), False))
        if end - first > 1:
            found.append((text, first, end))
    text, first, last = np.array(found, np.int64).reshape(-1, 3).T
    keys = [_digest(raw[a:b], 32) for a, b in zip(starts[first].tolist(), stops[last - 1].tolist(), strict=True)]
    return text, first - lines_at[text], last - lines_at[text], keys


def words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends."""
    data = np.frombuffer(raw + b"\0\0", np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _INSIDE[data[:-2]]
    wide = np.flatnonzero(_WIDE_BEGIN[data])
    if len(wide):
        two = data[wide].astype(np.int64) << 8 | data[wide + 1]
        three = two << 8 | data[np.minimum(wide + 2, len(raw))]
        for found, size in ((wide[np.isin(two, _WIDE_TWO)], 2), (wide[np.isin(three, _WIDE_THREE)], 3)):
            for k in range(1, size + 1):
                inside[found + k] = False
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _parts(column: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in ranges: number of the first, bytes with a line break after each, words, first word and first byte of each."""
    data, offsets = text_bytes(column)
    for first, last in parts(offsets, RANGE_BYTES):
        raw = b"\n".join([data[a:b].tobytes() for a, b in zip(offsets[first:last], offsets[first + 1:last + 1], strict=True)] + [b""])
        bounds = offsets[first:last + 1] - offsets[first] + np.arange(last - first + 1)
        begin, end = words(raw)
        yield first, raw, begin, end, np.searchsorted(begin, bounds), bounds


def _segments(raw: bytes, begin: np.ndarray, end: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same smallest hash: text, first word in the range, windows, hash."""
    none = np.zeros(0, np.int64)
    if len(begin) < window:
        return none, none, none, np.zeros(0, U)
    data = np.frombuffer(raw, np.uint8)
    powers, inverse = _POWERS, _INVERSE
    if len(data) > len(powers):
        powers, inverse = (np.cumprod(np.full(len(data), x, U), dtype=U) for x in (_FACTOR, pow(_FACTOR, -1, 1 << 64)))
    sums = np.zeros(len(data) + 1, U)
    values = _BYTES[data]
    values *= powers[:len(data)]
    np.cumsum(values, out=sums[1:])
    h = mix((sums[end] - sums[begin]) * inverse[begin])
    group = 1
    while group * 2 <= window // 3:
        # A power for each place in a group.
        h = h[:-group] * powers[group - 1] + h[group:]
        group *= 2
    h = mix(h)
    grams, reach = window - group + 1, 1
    while reach < grams:
        step = min(reach, grams - reach)
        h = np.minimum(h[:-step], h[step:])
        reach += step
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    valid = np.flatnonzero(owner[:len(h)] == owner[window - 1:])
    if not len(valid):
        return none, none, none, np.zeros(0, U)
    new = np.ones(len(valid), bool)
    new[1:] = (np.diff(valid) != 1) | (h[valid[1:]] != h[valid[:-1]])
    heads = np.flatnonzero(new)
    return owner[valid[heads]], valid[heads], np.diff(heads, append=len(valid)), h[valid[heads]]


def _digest(raw: bytes, size: int = 16) -> bytes:
    return blake2b(raw, digest_size=size).digest()


def _listed(whole: DataFrame, window: int) -> DataFrame:
    """One row for the segments and the chunks of lines of a batch of texts, or a few rows.

    ``docs, tags, counts`` are the texts with segments and how many each has, ``h, place, n, key`` the
    segments' hashes, places, windows and digests.
    """
    kind = whole.schema["doc_id"].dataType.simpleString()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, found, keys, lines, line_keys = [], [], [], [], []
            for first, raw, begin, end, at, bounds in _parts(batch.column("text")):
                owner, start, n, h = _segments(raw, begin, end, at, window)
                keys += [_digest(raw[a:b]) for a, b in zip(begin[start].tolist(), end[start + n + window - 2].tolist(), strict=True)]
                owners.append(owner + first)
                found.append((h.view(np.int64), (start - at[owner]).astype(np.int32), n.astype(np.int32)))
                text, begins, ends, more = _chunks(raw, begin, bounds, window)
                lines.append((text + first, begins.astype(np.int32), ends.astype(np.int32)))
                line_keys += more
            owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
            for i in range(0, max(len(owner), len(line_keys)), LIST_SEGMENTS):
                own = slice(i, i + LIST_SEGMENTS)
                texts, counts = np.unique(owner[own], return_counts=True)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), batch.column(c).take(pa.array(texts))) for c in ("doc_id", "tag")]
                blobs = [counts.astype(np.int32), *(np.concatenate(x)[own] for x in zip(*found, strict=True))]
                blobs = [pa.array([x.tobytes()], pa.binary()) for x in blobs]
                text, begins, ends = (pa.array(np.concatenate(x)[own]) for x in zip(*lines, strict=True))
                chunk = [batch.column("doc_id").take(text), batch.column("tag").take(text), begins, ends, pa.array(line_keys[own], pa.binary())]
                chunk = pa.StructArray.from_arrays(chunk, names=["doc_id", "tag", "first", "last", "key"])
                chunk = pa.ListArray.from_arrays(pa.array([0, len(chunk)], pa.int32()), chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid4().bytes], pa.binary()), *lists, *blobs, pa.array([b"".join(keys[own])], pa.binary()), chunk],
                    names=["part", "docs", "tags", "counts", "h", "place", "n", "key", "chunks"],
                )

    lists = f"part binary, docs array<{kind}>, tags array<long>, counts binary, h binary, place binary, n binary, key binary"
    return materialise(whole.mapInArrow(listed, f"{lists}, chunks array<struct<doc_id:{kind},tag:long,first:int,last:int,key:binary>>"), "segments")


def _passages(whole: DataFrame, placed: DataFrame, window: int) -> DataFrame:
    """``doc_id, tag, place, n``: ``n`` windows from word ``place`` on that occur before, in another text or apart in this one.

    ``placed`` are the lists of ``whole``; they are discarded.
    """
    kind = whole.schema["doc_id"].dataType.simpleString()

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The hashes of a list by bucket, more than once if there is something to compare within it."""
        for batch in batches:
            for part, h, n in zip(*(batch.column(c).to_pylist() for c in ("part", "h", "n")), strict=True):
                values = np.frombuffer(h, np.int64)
                one, times = np.unique(values, return_counts=True)
                # A segment longer than a window may repeat itself.
                sent = np.concatenate([one, one[times > 1], np.repeat(np.unique(values[np.frombuffer(n, np.int32) > window]), 2)])
                place = sent % parted
                sent = sent[np.argsort(place, kind="stable")]
                held, cuts = np.unique(place, return_counts=True)
                cuts = np.concatenate([[0], np.cumsum(cuts)]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held, pa.int64()), pa.array([part] * len(held), pa.binary()),
                     pa.array([sent[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                    names=["bucket", "part", "hashes"],
                )

    def met(keys: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
        """The hashes of each list that are sent twice."""
        blobs = sent.column("hashes").to_pylist()
        values = np.frombuffer(b"".join(blobs), np.int64)
        order = np.argsort(values, kind="stable")
        alike = values[order[1:]] == values[order[:-1]]
        twice = np.zeros(len(values), bool)
        twice[order[1:][alike]] = twice[order[:-1][alike]] = True
        cuts = np.cumsum([0, *(len(x) // 8 for x in blobs)]).tolist()
        found = [values[a:b][twice[a:b]].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.table({"part": sent.column("part"), "hashes": pa.array(found, pa.binary())})

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The segments with hashes that were met elsewhere, each in a row."""
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                counts, place, n = (np.frombuffer(row[c].as_py(), np.int32) for c in ("counts", "place", "n"))
                h = np.frombuffer(row["h"].as_py(), np.int64)
                at = np.flatnonzero(np.isin(h, np.frombuffer(b"".join(row["asked"].as_py()), np.int64)))
                texts, keys = pa.array(np.repeat(np.arange(len(counts)), counts)[at]), row["key"].as_py()
                yield pa.RecordBatch.from_arrays(
                    [row["docs"].values.take(texts), row["tags"].values.take(texts), pa.array(place[at], pa.int32()), pa.array(n[at], pa.int32()),
                     pa.array(h[at], pa.int64()), pa.array([keys[16 * k:16 * k + 16] for k in at.tolist()], pa.binary())],
                    names=["doc_id", "tag", "place", "n", "h", "key"],
                )

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digests of the windows of each piece in a row; those of hot pieces in rows of their own."""
        for batch in batches:
            counts = pc.list_value_length(batch.column("asked")).to_numpy()
            pieces = batch.column("asked").flatten()
            piece_at = np.append(0, np.cumsum(counts))
            place, n, h, hot = (pc.struct_field(pieces, c).to_numpy(zero_copy_only=False) for c in ("place", "n", "h", "hot"))
            for first, raw, begin, end, at, _ in _parts(batch.column("text")):
                own = slice(piece_at[first], piece_at[first + len(at) - 1])
                rows = np.where(hot[own], n[own], 1).astype(np.int64)
                texts = np.repeat(np.repeat(np.arange(len(at) - 1), counts[first:first + len(at) - 1]), rows)
                places, hashes, hots = _ranges(place[own].astype(np.int64), rows), np.repeat(h[own], rows), np.repeat(hot[own], rows)
                sizes = np.repeat(np.where(hot[own], 1, n[own]).astype(np.int64), rows)
                word = _ranges(at[texts] + places, sizes)
                keys = b"".join([_digest(raw[a:b]) for a, b in zip(begin[word].tolist(), end[word + window - 1].tolist(), strict=True)])
                cuts = np.concatenate([[0], np.cumsum(sizes) * 16]).tolist()
                texts = pa.array(texts + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(texts), batch.column("tag").take(texts), pa.array(places, pa.int32()), pa.array(hashes, pa.int64()),
                     pa.array(hots, pa.bool_()), pa.array([keys[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                    names=["doc_id", "tag", "place", "h", "hot", "key"],
                )

    def compared(keys: tuple[pa.Scalar, ...], pieces: pa.Table) -> pa.Table:
        """Windows in a row that have an equal one before them, apart from them."""
        blobs = pieces.column("key").to_pylist()
        digests = np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, 2)
        sizes = np.array([len(x) // 16 for x in blobs], np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = _ranges(pieces.column("place").to_numpy().astype(np.int64), sizes)
        tag, doc = pieces.column("tag").to_numpy(), pc.rank(pieces.column("doc_id"), tiebreaker="dense").to_numpy()
        again = np.zeros(len(row), bool)
        # Most windows have a half digest of their own.
        order = np.argsort(digests[:, 0], kind="stable")
        alike = digests[order, 0][1:] == digests[order, 0][:-1]
        order = order[np.append(alike, False) | np.append(False, alike)]
        if len(order):
            order = order[np.lexsort((place[order], tag[row[order]], doc[row[order]], digests[order, 1], digests[order, 0]))]
            new = np.append(True, (digests[order[1:]] != digests[order[:-1]]).any(axis=1))
            first = order[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
            one, other = row[order], row[first]
            again[order] = (doc[one] != doc[other]) | (tag[one] != tag[other]) | (place[order] >= place[first] + window)
        found = np.flatnonzero(again)
        new = np.ones(len(found), bool)
        new[1:] = (np.diff(found) != 1) | (row[found[1:]] != row[found[:-1]])
        heads = np.flatnonzero(new)
        of = pa.array(row[found[heads]])
        return pa.table({
            "doc_id": pieces.column("doc_id").take(of), "tag": pieces.column("tag").take(of),
            "place": pa.array(place[found[heads]], pa.int32()), "n": pa.array(np.diff(heads, append=len(found)), pa.int32()),
        })

    def firsts(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
        return rows.groupBy(*keys).agg(F.min(F.struct("doc_id", "tag", "place")).alias("first"), F.count("*").alias("copies"), *more)

    # Equal words that overlap in one text do not repeat each other.
    apart = F.expr(f"doc_id <> first.doc_id or tag <> first.tag or place >= first.place + {window}")
    # A hash that stands once has nothing to compare, unless its segment is long enough to repeat itself.
    parted = -(-(placed.agg(F.sum(F.octet_length("h"))).first()[0] or 0) // (8 * BUCKET_HASHES)) or 1
    sent = placed.select("part", "h", "n").mapInArrow(dealt, "bucket long, part binary, hashes binary")
    several = sent.groupBy("bucket").applyInArrow(met, "part binary, hashes binary").where("octet_length(hashes) > 0")
    several = placed.drop("chunks").join(several.groupBy("part").agg(F.collect_list("hashes").alias("asked")), "part")
    shared = materialise(several.mapInArrow(chosen, f"doc_id {kind}, tag long, place int, n int, h long, key binary"), "shared-segments")
    discard(placed)
    known = stored_known = materialise(firsts(shared, ["h", "key"], F.max("n").alias("most")), "first-segments")
    # All windows of a hash are compared in the same way, in a bucket or, of very many segments, in a join.
    kinds = known.groupBy("h").agg(F.count("*").alias("kinds"), F.max("most").alias("most"))
    kinds = kinds.select("h", "most", F.expr("kinds > 1").alias("mixed"), F.expr(f"kinds > {HOT_KINDS} or most > {HOT_KINDS}").alias("hot"))
    known = known.drop("most").join(kinds, "h").where(f"copies > 1 or mixed or most > {window}").select("key", "first", "copies", "mixed", "hot")
    # A segment that is long enough to repeat itself is asked in any case.
    judged = shared.join(known, "key").withColumn("again", apart).select(
        "doc_id", "tag", "place", "n", "h", "hot", "again",
        F.expr(f"n > {window} or not again and (mixed or doc_id <> first.doc_id or tag <> first.tag or place <> first.place)").alias("asked"),
    )
    judged = materialise(judged, "judged-segments")
    discard(stored_known, shared)
    asked = judged.where("asked")
    size = asked.agg(F.sum("n")).first()[0] or 0
    buckets = -(-size // BUCKET_WINDOWS) or 1
    asked = asked.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("place", "n", "h", "hot")).alias("asked"))
    windows = whole.join(asked, ["doc_id", "tag"]).select("doc_id", "tag", "text", "asked")
    windows = materialise(windows.mapInArrow(single, f"doc_id {kind}, tag long, place int, h long, hot boolean, key binary"), "windows")
    packed = windows.where("not hot").withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets))).groupBy("bucket")
    packed = packed.applyInArrow(compared, f"doc_id {kind}, tag long, place int, n int")
    hot = windows.where("hot")
    hot = hot.join(firsts(hot, ["key"]).where("copies > 1"), "key").where(apart).select("doc_id", "tag", "place", F.lit(1).alias("n"))
    return judged.where("again").select("doc_id", "tag", "place", "n").unionByName(packed).unionByName(hot)


def _without(
    raw: bytes, begin: np.ndarray, end: np.ndarray, at: np.ndarray, bounds: np.ndarray,
    dropped: tuple[np.ndarray, np.ndarray, np.ndarray], cuts: tuple[np.ndarray, np.ndarray, np.ndarray], window: int,
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts in a row without some lines and words; lines that went, and words that went besides those.

    ``dropped`` and ``cuts`` are texts, places in them and numbers of lines and of windows.
    """
    starts, stops, lines_at = _lines(raw, bounds)

    def covered(which: tuple[np.ndarray, np.ndarray, np.ndarray], first: np.ndarray, more: int) -> np.ndarray:
        text, place, n = which
        fits = place + n + more <= first[text + 1] - first[text]
        place, n = (first[text] + place)[fits], n[fits] + more
        edges = np.bincount(place, minlength=first[-1] + 1) - np.bincount(place + n, minlength=first[-1] + 1)
        return np.cumsum(edges)[:-1] > 0

    drop, gone = covered(dropped, lines_at, 0), covered(cuts, at, window - 1)
    word_at = np.searchsorted(begin, np.append(starts, len(raw)))
    first_word, after = word_at[:-1], word_at[1:]
    gone_to = np.append(0, np.cumsum(gone))
    lost, size = np.diff(gone_to[word_at]), after - first_word
    owner = np.repeat(np.arange(len(lines_at) - 1), np.diff(lines_at))
    # A blank line inside a passage goes with it.
    inside = np.zeros(len(stops), bool)
    blank = np.flatnonzero((size == 0) & (first_word > at[owner]) & (first_word < at[owner + 1]))
    inside[blank] = gone[first_word[blank] - 1] & gone[first_word[blank]]
    # A text of which no word is left is empty.
    words_left = np.bincount(owner, np.where(drop, 0, size - lost), len(lines_at) - 1)
    stays = ~drop & ~inside & ((size == 0) | (lost < size)) & (words_left[owner] > 0)
    kept = np.zeros(len(raw) + 1, np.int8)

    def keep(first: np.ndarray, last: np.ndarray) -> None:
        kept[first] += 1
        kept[last] -= 1

    plain, parted = np.flatnonzero(stays & (lost == 0)), np.flatnonzero(stays & (lost > 0))
    keep(starts[plain], stops[plain])
    # A line break stands before each line but the first that stays.
    follows = np.flatnonzero(stays)
    follows = follows[:-1][owner[follows[1:]] == owner[follows[:-1]]]
    keep(stops[follows], stops[follows] + 1)
    word = _ranges(first_word[parted], size[parted])
    line = np.repeat(parted, size[parted])[~gone[word]]
    word = word[~gone[word]]
    keep(begin[word], end[word])
    # What separates a word from the one before stays with it; the first that stays begins as its line did.
    later = word[1:][line[1:] == line[:-1]]
    keep(end[later - 1], begin[later])
    keep(starts[parted], begin[first_word[parted]])
    keep(end[after[parted] - 1], stops[parted])
    mask = np.cumsum(kept[:-1], dtype=np.int8) > 0
    offsets = np.append(0, np.cumsum(np.add.reduceat(mask, bounds[:-1], dtype=np.int64))).astype(np.int32)
    left = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(np.frombuffer(raw, np.uint8)[mask]))
    return left, np.add.reduceat(drop, lines_at[:-1], dtype=np.int64), np.bincount(owner, np.where(drop, 0, lost), len(lines_at) - 1).astype(np.int64)


def remove_repeated(docs: DataFrame, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """``docs`` with the text that is left, and ``n_lines, n_removed, n_cut`` at the end.

    Lines of repeated chunks are in ``n_removed``; words of repeated passages outside of these are
    in ``n_cut``. A passage has ``passage_words`` words or more with the same bytes between them.
    Of equal chunks and passages the one in the smallest ``doc_id``, there the first, stays. Null texts stay
    null and empty ones empty. Rows without an id take no part. Rows that share an id and a
    text count as one document. A line break that ends a removed chunk goes with it.
    """
    python_tasks(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    whole = texts.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("tag"), "text")
    placed = _listed(whole, passage_words)
    each = placed.select(F.explode("chunks").alias("chunk")).select("chunk.*")
    repeated = each.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "tag", "first")).alias("stays")).where("n > 1")
    same = each.join(repeated, "key").where("struct(doc_id, tag, first) <> stays")
    # Lines stand in this list with a negative number, windows with a positive one.
    same = materialise(same.select("doc_id", "tag", F.col("first").alias("place"), F.expr("first - last").alias("n")), "repeated-chunks")
    gone = same.unionByName(_passages(whole, placed, passage_words))
    gone = gone.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("place", "n")).alias("__gone"))

    names = docs.columns
    schema = T.StructType([f for f in docs.schema.fields if f.name not in ("n_lines", "n_removed", "n_cut")])
    kept = [f.name for f in schema.fields]
    schema = schema.add("n_lines", T.LongType()).add("n_removed", T.LongType()).add("n_cut", T.LongType())

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, pieces = batch.column("text"), batch.column("__gone")
            lines = pc.add(pc.count_substring(text, "\n"), 1).cast(pa.int64())
            lines = pc.if_else(pc.equal(pc.fill_null(pc.binary_length(text), 0), 0), 0, lines)
            changed = pc.is_valid(pieces)
            at = np.flatnonzero(changed.to_numpy(zero_copy_only=False))
            removed, cut = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
            if len(at):
                pieces, out = pieces.take(pa.array(at)), []
                owner = np.repeat(np.arange(len(at)), pc.list_value_length(pieces).to_numpy())
                place, n = (pc.struct_field(pieces.flatten(), c).to_numpy().astype(np.int64) for c in ("place", "n"))
                for first, raw, begin, end, words_at, bounds in _parts(text.take(pa.array(at))):
                    own = slice(*np.searchsorted(owner, [first, first + len(bounds) - 1]))
                    which = [(owner[own][x] - first, place[own][x], abs(n[own][x])) for x in (n[own] < 0, n[own] > 0)]
                    left, dropped, went = _without(raw, begin, end, words_at, bounds, *which, passage_words)
                    out.append(left)
                    removed[at[first:first + len(left)]], cut[at[first:first + len(left)]] = dropped, went
                text = pc.replace_with_mask(text, changed, pa.concat_arrays(out))
            columns = [text if n == "text" else batch.column(n) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, lines, pa.array(removed), pa.array(cut)], names=[*kept, "n_lines", "n_removed", "n_cut"])

    gone = gone.withColumnRenamed("doc_id", "__doc").withColumnRenamed("tag", "__tag")
    source = docs.select(*[F.col(n).cast("string").alias(n) if n == "text" else F.col(n) for n in names])
    joined = source.join(gone, (source["doc_id"] == gone["__doc"]) & (F.xxhash64(source["text"]) == gone["__tag"]), "left").drop("__doc", "__tag")
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "text" else f for f in schema.fields])
    return joined.mapInArrow(rewrite, schema)
