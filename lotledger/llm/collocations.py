"""Collocations from a weighted de Bruijn graph of words.

Nodes are pairs of words in a row, edges triples; an edge joins two nodes that overlap in a
word. Texts are cut into pieces and words once, and only edges are counted: every word begins
one edge, whose later words are missing where the piece ends. What flows out of a node, piece
ends included, is the count of its pair, and what flows out of all nodes of a first word is the
count of the word, so shorter phrases are never counted in the texts.

An unbranched path, along which the whole flow goes on in one edge, is stored as that one row
with the counts of all its leading words, instead of a row for each length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotledger.llm.common import bounded_sample, python_tasks
from lotledger.llm.shingles import LOWER, U, mix, parts, text_bytes
from lotledger.session import materialise

LEAST = 10
LONGER_PERCENT = 50
TOP = 2000
#: Edges are dealt out over one bucket for each so many bytes of text.
BUCKET_BYTES = 8 << 20
#: Only the layout of the shuffle depends on these. Of so many rows at most it is found which
#: words and pairs begin more than half a bucket, or this share of all edges.
LAYOUT_ROWS = 4000
HOT_SHARE = 1 / 20_000
#: A batch is cut into parts of about this many bytes of text, each counted on its own.
PART_BYTES = 4 << 20
MARK, BLANK, LETTER = range(3)
BYTE_CLASS = np.full(256, LETTER, np.uint8)
BYTE_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = MARK
BYTE_CLASS[[0x20, 0x09]] = BLANK
PACKED = "lang string, bucket long, edges binary"
COMPACT = "lang string, w1 string, w2 string, w3 string, n3 long, n2 long, n1 long"


class Edges(NamedTuple):
    """Counted edges of some texts; words are places in ``words``, -1 after the end of a piece."""

    langs: pa.Array
    words: pa.Array
    lang: np.ndarray
    first: np.ndarray
    second: np.ndarray
    third: np.ndarray
    n: np.ndarray


class Layout(NamedTuple):
    """Buckets, and the words and pairs whose edges are dealt out by their later words as well."""

    buckets: int
    words: list[str]
    pairs: list[str]


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of some texts, the text and the piece each one lies in."""
    low = LOWER[data]
    kinds = BYTE_CLASS[low]
    inside = kinds == LETTER
    before = np.zeros(len(low), bool)
    before[1:] = inside[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    before[first] = False
    begins = np.flatnonzero(inside & ~before)
    letters = np.flatnonzero(inside)
    at = np.append(np.searchsorted(letters, begins), len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(begins), [None, pa.py_buffer(at), pa.py_buffer(low[letters])])
    text = np.searchsorted(bounds, begins, "right") - 1
    return words, text, np.cumsum(kinds == MARK, dtype=np.int64)[begins]


def count_edges(texts: pa.Array, langs: pa.Array) -> Iterator[Edges]:
    """Edges of a batch of texts with their counts."""
    data, offsets = text_bytes(texts)
    langs = langs.cast(pa.string()).fill_null("und").dictionary_encode()
    lang_of = langs.indices.to_numpy()
    for begin, end in parts(offsets, PART_BYTES):
        words, text, piece = _words(data[offsets[begin]:offsets[end]], offsets[begin:end + 1] - offsets[begin])
        if not len(words):
            continue
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy()
        goes_on = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
        second = np.full(len(code), -1, np.int32)
        second[:-1][goes_on] = code[1:][goes_on]
        third = np.full(len(code), -1, np.int32)
        twice = goes_on[:-1] & goes_on[1:]
        third[:-2][twice] = code[2:][twice]
        keys = ["lang", "first", "second", "third"]
        counted = pa.table([pa.array(x) for x in (lang_of[begin + text], code, second, third)], names=keys)
        counted = counted.group_by(keys, use_threads=False).aggregate([([], "count_all")])
        yield Edges(langs.dictionary, coded.dictionary, *[counted[k].to_numpy() for k in (*keys, "count_all")])


def _spelled(words: pa.Array, codes: np.ndarray) -> pa.Array:
    """Words by their place; an empty one stands for the end of a piece."""
    return pa.concat_arrays([words, pa.array([""])]).take(pa.array(np.where(codes < 0, len(words), codes)))


def _bytes_of(strings: pa.Array, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and bytes of some strings in a row."""
    at = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset + begin:strings.offset + end + 1]
    return np.diff(at), np.frombuffer(strings.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]


def _pack(columns: list[pa.Array], n: np.ndarray, begin: int, end: int) -> bytes:
    """Some rows of string columns and counts as one compressed value."""
    sizes, texts = zip(*[_bytes_of(c, begin, end) for c in columns], strict=True)
    whole = np.concatenate([np.array([end - begin], np.int64).view(np.uint8), n[begin:end].astype(np.int64).view(np.uint8),
                            *[s.astype(np.int32).view(np.uint8) for s in sizes], *texts]).tobytes()
    return len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def _unpack(values: list[bytes], width: int = 3) -> tuple[list[pa.Array], np.ndarray]:
    """The rows of several packed values together."""
    sizes, texts, counts = [[] for _ in range(width)], [[] for _ in range(width)], []
    for value in values:
        whole = np.frombuffer(pa.decompress(value[8:], int.from_bytes(value[:8], "little"), codec="zstd"), np.uint8)
        rows = int(whole[:8].view(np.int64)[0])
        counts.append(whole[8:8 + 8 * rows].view(np.int64))
        at = 8 + 8 * rows
        for k in range(width):
            sizes[k].append(whole[at:at + 4 * rows].view(np.int32))
            at += 4 * rows
        for k in range(width):
            step = int(sizes[k][-1].sum())
            texts[k].append(whole[at:at + step])
            at += step
    columns = []
    for size, text in zip(sizes, texts, strict=True):
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.concatenate(size), dtype=np.int64)])
        columns.append(pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(text))]))
    return columns, np.concatenate(counts)


def _heat(words: pa.Array, first: np.ndarray, second: np.ndarray, layout: Layout) -> np.ndarray:
    """2 for edges of a hot pair, 1 for other edges of a hot word, 0 for the rest."""
    if not layout.words or not len(words):
        return np.zeros(len(first), np.int8)
    heat = pc.is_in(words, pa.array(layout.words, words.type)).to_numpy(zero_copy_only=False)[first].astype(np.int8)
    if layout.pairs:
        left, right = (pc.index_in(pa.array(side, words.type), words).fill_null(-1).to_numpy().astype(np.int64)
                       for side in zip(*[p.split(" ") for p in layout.pairs], strict=True))
        known = (left >= 0) & (right >= 0)
        pairs = left[known] * len(words) + right[known]
        heat[np.isin(first.astype(np.int64) * len(words) + second, pairs) & (second >= 0)] = 2
    return heat


def packed_edges(docs: DataFrame, layout: Layout) -> DataFrame:
    """Edges of all texts by language and bucket of their first word, counted in parts and packed."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for e in count_edges(batch.column("text"), batch.column("lang")):
                hashes = np.fromiter((zlib.crc32(w) for w in [*e.words.cast(pa.binary()).to_pylist(), b""]), U, len(e.words) + 1)
                heat = _heat(e.words, e.first, e.second, layout)
                key = mix(hashes[e.first])
                for level, codes in ((1, e.second), (2, e.third)):
                    key = np.where(heat >= level, mix(key + hashes[codes]), key)
                bucket = (key % U(layout.buckets)).astype(np.int64)
                order = np.lexsort((e.first, bucket, e.lang))
                lang, bucket = e.lang[order], bucket[order]
                cuts = np.flatnonzero((np.diff(lang) != 0) | (np.diff(bucket) != 0)) + 1
                bounds = [0, *cuts.tolist(), len(order)]
                columns, n = [_spelled(e.words, codes[order]) for codes in (e.first, e.second, e.third)], e.n[order]
                values = [_pack(columns, n, a, b) for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [e.langs.take(pa.array(lang[bounds[:-1]])), pa.array(bucket[bounds[:-1]]), pa.array(values, pa.binary())],
                    names=["lang", "bucket", "edges"])

    return docs.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(batches, PACKED)


def _layout(docs: DataFrame) -> Layout:
    """Buckets by the size of all texts, hot words and pairs by a sample: 20,000 each at most."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + total // BUCKET_BYTES
    python_tasks(docs.sparkSession)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for e in count_edges(batch.column("text"), batch.column("lang")):
                first, second = _spelled(e.words, e.first), _spelled(e.words, e.second)
                pair = pc.binary_join_element_wise(first, second, " ")
                yield pa.RecordBatch.from_arrays([first, pc.if_else(pa.array(e.second >= 0), pair, pa.scalar(None, pa.string()))], names=["word", "pair"])

    keyed = bounded_sample(docs.select("text", "lang", F.xxhash64("text").alias("__key")), "__key", LAYOUT_ROWS)
    seen = materialise(keyed.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(batches, "word string, pair string"), "edge-sample")
    least = seen.count() * max(0.5 / buckets, HOT_SHARE)

    def frequent(name: str) -> list[str]:
        return [row[0] for row in seen.where(F.col(name).isNotNull()).groupBy(name).count().where(F.col("count") > least).select(name).collect()]

    words = frequent("word")
    return Layout(buckets, words, frequent("pair") if words else [])


def compact_graph(packed: DataFrame, layout: Layout, least: int) -> DataFrame:
    """Frequent edges, nodes and words of every bucket, an unbranched path in one row.

    ``n3`` counts the triple, ``n2`` the pair it begins with and ``n1`` its first word; what is
    not frequent, or stands in another row, is null. Of hot words ``n1`` and of hot pairs ``n2``
    are partial sums. A row without words has the number of all words of the bucket.
    """

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        (w1, w2, w3), n = _unpack(table["edges"].to_pylist())
        coded = [w.dictionary_encode() for w in (w1, w2, w3)]
        codes = [c.indices.to_numpy() for c in coded]
        order = np.lexsort(codes[::-1])
        codes = [c[order] for c in codes]

        def changes(upto: int) -> np.ndarray:
            """Where any of the first ``upto`` words differs from the row before."""
            new = np.zeros(len(order), bool)
            new[0] = True
            for c in codes[:upto]:
                new[1:] |= c[1:] != c[:-1]
            return np.flatnonzero(new)

        triples = changes(3)
        n = np.add.reduceat(n[order], triples)
        codes = [c[triples] for c in codes]
        order = order[triples]
        first, second, third = (c.dictionary.take(pa.array(x)) for c, x in zip(coded, codes, strict=True))
        has2, has3 = (pc.not_equal(w, "").to_numpy(zero_copy_only=False) for w in (second, third))
        spelled = pa.concat_arrays([w.cast(pa.string()) for w in (first, second)]).dictionary_encode()
        places = spelled.indices.to_numpy()
        heat = _heat(spelled.dictionary, places[:len(first)], np.where(has2, places[len(first):], -1), layout)
        flows = []
        for upto in (1, 2):
            at = changes(upto)
            flow = np.zeros(len(order), np.int64)
            flow[at] = np.add.reduceat(n, at)
            flows.append(flow)
        n1 = np.where((flows[0] >= least) | (heat > 0), flows[0], 0)
        n2 = np.where(has2 & ((flows[1] >= least) | (heat == 2)), flows[1], 0)
        n3 = np.where(has3 & (n >= least), n, 0)
        kept = np.flatnonzero((n1 > 0) | (n2 > 0) | (n3 > 0))
        lang = key[0]
        words = [w.take(pa.array(kept)).cast(pa.string()) for w in (first, second, third)]
        words = [pc.if_else(pc.equal(w, ""), pa.scalar(None, pa.string()), w) for w in words]
        counts = [pa.array(x[kept], mask=x[kept] == 0) for x in (n3, n2, n1)]
        names = [c.split()[0] for c in COMPACT.split(", ")]
        found = pa.table([pa.array([lang.as_py()] * len(kept), pa.string()), *words, *counts], names=names)
        total = [pa.array([x], t) for x, t in zip((lang.as_py(), None, None, None, None, None, int(n.sum())), found.schema.types, strict=True)]
        return pa.concat_tables([found, pa.table(total, names=names)])

    return packed.groupBy("lang", "bucket").applyInArrow(merged, COMPACT)


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, w1, w2, w3, size, n`` of every phrase of up to three words that occurs ``least`` times.

    One shuffle deals edges out by their first word. Sums over the edges of a pair or word that
    is dealt out wider are partial there, and merged afterwards. A row of size 1 without a word
    has the number of all words of the language.
    """
    layout = _layout(docs)
    compact = materialise(compact_graph(packed_edges(docs, layout), layout, least), "compact-graph")
    none = F.lit(None).cast("string")
    levels = F.array(
        F.struct("w1", "w2", "w3", F.lit(3).alias("size"), F.col("n3").alias("n")),
        F.struct("w1", "w2", none.alias("w3"), F.lit(2).alias("size"), F.col("n2").alias("n")),
        F.struct("w1", none.alias("w2"), none.alias("w3"), F.lit(1).alias("size"), F.col("n1").alias("n")))
    found = compact.select("lang", F.inline(levels)).where("n IS NOT NULL")
    return found.groupBy("lang", "w1", "w2", "w3", "size").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | F.col("w1").isNull())


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimals of 38 digits, exact for counts up to 10**15."""
    a, left, right = (f"cast({c} AS decimal(16,0))" for c in (a, left, right))
    return F.expr(f"(cast(1000000 AS decimal(7,0)) * cast({a} * {a} AS decimal(31,0))) div ({left} * {right})")


def collocations(docs: DataFrame, least: int = LEAST, longer_percent: int = LONGER_PERCENT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two and three words of each language.

    A phrase of ``least`` occurrences is scored at the cut that binds it least; it is dropped if
    a longer one holds it that has ``longer_percent`` of its occurrences. A null text is empty,
    a null language ``und``. Repeated rows count as often as they occur; a language without
    candidates has no rows. Other columns are not read.
    """
    counts = materialise(phrase_counts(docs.select("text", "lang"), least), "phrase-counts")
    ones = counts.where("size = 1 AND w1 IS NOT NULL").select("lang", "w1", "n")
    twos = counts.where("size = 2").select("lang", "w1", "w2", "n")
    threes = counts.where("size = 3").select("lang", "w1", "w2", "w3", F.col("n").alias("a"))
    pairs = (
        twos.withColumnRenamed("n", "a")
        .join(ones.select("lang", "w1", F.col("n").alias("l")), ["lang", "w1"])
        .join(ones.select("lang", F.col("w1").alias("w2"), F.col("n").alias("r")), ["lang", "w2"])
    )
    longer = F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))
    held = threes.select("lang", "a", F.inline(longer)).groupBy("lang", "w1", "w2").agg(F.max("a").alias("longest"))
    pairs = pairs.join(held, ["lang", "w1", "w2"], "left").where(
        f"longest IS NULL OR cast(100 AS decimal(3,0)) * longest < cast({int(longer_percent)} AS decimal(3,0)) * a")
    cuts = (
        threes.join(twos.select("lang", "w1", "w2", F.col("n").alias("l2")), ["lang", "w1", "w2"])
        .join(twos.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("r1")), ["lang", "w2", "w3"])
        .join(ones.select("lang", "w1", F.col("n").alias("l1")), ["lang", "w1"])
        .join(ones.select("lang", F.col("w1").alias("w3"), F.col("n").alias("r2")), ["lang", "w3"])
        .withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    )
    early = F.col("s1") <= F.col("s2")
    scored = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score")).unionByName(
        cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                    F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # A language may hold most rows: its shares are ranked first, and only their best meet.
    shares = scored.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(256)))
    best = shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("w1 IS NULL").select("lang", F.col("n").alias("words"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
