"""How filters over texts interact: what each removes, alone and in every order.

Texts are read once as UTF-8 bytes by a transducer whose tables give, for each byte, its class
and the next state. A word is emitted where the state returns to the space between words; the
spans are put into an open hash table in which equal hashes only count as equal words after
their bytes have been compared. The five outcomes of a text are bits of a mask; everything
after that is aggregation of masks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.llm.common import python_tasks
from lotledger.llm.shingles import U, mix, parts, text_bytes
from lotledger.session import materialise

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 2
#: Bytes: white space, A-Z, the listed symbols, bytes that go on a character, and all others.
BLANK, CAPITAL, SYMBOL, INNER, OTHER = range(5)
BYTE_CLASS = np.full(256, OTHER, np.uint8)
BYTE_CLASS[[0x20, *range(0x09, 0x0E)]] = BLANK
BYTE_CLASS[65:91] = CAPITAL
BYTE_CLASS[list(b"#$%&*|")] = SYMBOL
BYTE_CLASS[0x80:0xC0] = INNER
#: The state after a byte is 1 inside a word and 0 between words, whatever the state before.
NEXT_STATE = (BYTE_CLASS != BLANK).astype(np.uint8)
LONG_WORD = 64


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every maximal run of the state inside a word; texts end runs."""
    state = NEXT_STATE[data]
    before = np.zeros(len(data), np.uint8)
    before[1:] = state[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    before[first] = 0
    begins = np.flatnonzero(state & ~before & 1)
    after = np.zeros(len(data), np.uint8)
    after[:-1] = state[1:]
    after[first[1:] - 1] = 0
    return begins, np.flatnonzero(state & ~after & 1) + 1


def _blocks(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, block: int) -> np.ndarray:
    """Bytes ``8 * block`` up to ``8 * block + 8`` of each word as one number, zeros behind its end.

    ``data`` has eight more bytes than the words need, so that eight can be read anywhere.
    """
    eight = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,))
    left = np.clip(sizes - 8 * block, 1, 8)
    return eight[begins + 8 * block] & (U(0xFFFFFFFFFFFFFFFF) >> (8 * (8 - left)).astype(U))


def distinct_words(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Exact number of distinct words of each owner, by an open hash table over all of them.

    In every round each word looks at its slot. An empty slot is taken by one of the words
    that meet there; a word leaves when the slot holds the same word of the same owner, byte
    for byte, and goes to the next slot otherwise.
    """
    if not len(begins):
        return np.zeros(owners, np.int64)
    sizes = ends - begins
    data = np.append(data, np.zeros(8, np.uint8))
    low = _blocks(data, begins, sizes, 0)
    # The first eight bytes and the length are the word itself when it is no longer than that.
    key = mix(low ^ mix(sizes.astype(U) + (owner.astype(U) << U(24))))
    most = int(sizes.max())
    blocks = [low]
    for block in range(1, (min(most, LONG_WORD) + 7) // 8):
        long = np.flatnonzero(sizes > 8 * block)
        number = np.zeros(len(begins), U)
        number[long] = _blocks(data, begins[long], sizes[long], block)
        key[long] = mix(key[long] ^ number[long])
        blocks.append(number)
    longest = np.flatnonzero(sizes > LONG_WORD)
    texts = {int(i): data[begins[i]:ends[i]].tobytes() for i in longest}
    for i, text in texts.items():
        key[i] = mix(key[i:i + 1] ^ U(hash(text) & (1 << 63) - 1))[0]
    width = 1 << int(2 * len(begins)).bit_length()
    table = np.full(width, -1, np.int64)
    slot = (key & U(width - 1)).astype(np.int64)
    waiting = np.arange(len(begins))
    fresh = np.zeros(len(begins), bool)
    while len(waiting):
        at = slot[waiting]
        empty = table[at] < 0
        table[at[empty]] = waiting[empty]
        holder = table[at]
        fresh[holder[holder == waiting]] = True
        same = (owner[holder] == owner[waiting]) & (sizes[holder] == sizes[waiting])
        for number in blocks:
            same &= number[holder] == number[waiting]
        if texts:
            for k in np.flatnonzero(same & (sizes[waiting] > LONG_WORD)):
                same[k] = texts[int(holder[k])] == texts[int(waiting[k])]
        waiting = waiting[~same]
        slot[waiting] = (slot[waiting] + 1) & (width - 1)
    return np.bincount(owner[fresh], minlength=owners)


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """``words, distinct, capitals, characters, symbols`` of every text; null counts as empty."""
    data, offsets = text_bytes(column)
    found: dict[str, list[np.ndarray]] = {name: [] for name in ("words", "distinct", "capitals", "characters", "symbols")}
    for first, last in parts(offsets):
        piece = data[offsets[first]:offsets[last]]
        bounds = offsets[first:last + 1] - offsets[first]
        kinds = BYTE_CLASS[piece]

        def per_text(hits: np.ndarray, bounds: np.ndarray = bounds) -> np.ndarray:
            return np.diff(np.searchsorted(np.flatnonzero(hits), bounds))

        begins, ends = word_spans(piece, bounds)
        counts = np.diff(np.searchsorted(begins, bounds))
        owner = np.repeat(np.arange(len(counts)), counts)
        found["words"].append(counts)
        found["distinct"].append(distinct_words(piece, begins, ends, owner, len(counts)))
        found["capitals"].append(per_text(kinds == CAPITAL))
        found["characters"].append(np.diff(bounds) - per_text(kinds == INNER))
        found["symbols"].append(per_text(kinds == SYMBOL))
    return {name: np.concatenate([np.zeros(0, np.int64), *arrays]).astype(np.int64) for name, arrays in found.items()}


MEASURED = "words long, distinct long, capitals long, characters long, symbols long"


def with_measures(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the five counts of every row, in one pass over the bytes."""
    python_tasks(docs.sparkSession)
    names = [field.split()[0] for field in MEASURED.split(", ")]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            counts = measure(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(counts[n]) for n in names], names=[*keep, *names])

    kept = docs.select(*keep, text)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name in keep] + [MEASURED])
    return kept.mapInArrow(batches, schema)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n``: how many documents of a part fail which filters.

    Bit 0 stands for the first filter. Texts are compared as SHA-256 digests of all bytes;
    documents are grouped by digest, part and labels in their tasks before anything is
    shuffled, so a text with very many copies is a few rows.
    """
    keyed = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), "text")
    counted = with_measures(keyed, ["doc_id", "part", "digest"])
    fails = [
        F.col("words") < LEAST_WORDS,
        100 * F.col("distinct") < LEAST_DISTINCT_PERCENT * F.col("words"),
        100 * F.col("capitals") > MOST_CAPITALS_PERCENT * F.col("characters"),
        F.col("symbols") > 0,
    ]
    bits = sum((F.when(fail, 1 << k).otherwise(0) for k, fail in enumerate(fails)), F.lit(0))
    marks = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = counted.select("doc_id", "part", "digest", bits.alias("mask")).join(marks, "doc_id", "left")
    rows = rows.select("doc_id", "part", "digest", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    kind = ["digest", "part", "mask", "good", "toxic"]
    # Rows of one id are counted together first: they are copies of each other, none is later.
    of_id = rows.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))
    groups = materialise(of_id.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without_id")), "text-groups")
    lowest = groups.groupBy("digest").agg(F.min("first.doc_id").alias("lowest"))
    leading = F.when(F.col("first.doc_id") == F.col("lowest"), F.col("first.n")).otherwise(0)
    split = groups.join(lowest, "digest").withColumn("unique", leading + F.col("without_id"))
    both = F.array(F.struct("mask", F.col("unique").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("unique")).alias("n")))
    return split.select("part", "good", "toxic", F.inline(both)).where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with what the step does.

    A: under 200 words. B: under half of the words distinct. C: over 2 % of the characters A-Z.
    D: any of ``#$%&*|``. E: the same text as a document with a smaller id, wherever it is.
    A null text is empty and a null source the part ``''``. Rows that share an id are not
    duplicates of each other; rows without an id are neither duplicates nor originals. Of
    several labels of an id any 1 counts; labels of unknown ids count nowhere. Empty documents
    give no rows. Other columns of either table are not read.
    """
    spark = docs.sparkSession
    found = materialise(masks(docs.select("doc_id", "source", "text"), labels.select("doc_id", "quality", "toxic")), "filter-masks")
    # A step is told by its filter and the set before it: 80 cases, fixed.
    cases = [(before, k) for k in range(5) for before in range(32) if not before >> k & 1]
    weight = {case: factorial(case[0].bit_count()) * factorial(4 - case[0].bit_count()) for case in cases}
    known = spark.createDataFrame([(b, k, 1 << k, weight[b, k]) for b, k in cases], "before int, filter int, bit int, weight long")
    reaches, fails = F.col("mask").bitwiseAND(F.col("before")) == 0, F.col("mask").bitwiseAND(F.col("bit")) != 0
    n = F.col("n")

    def total(condition, alias):
        return F.sum(F.when(condition, n).otherwise(0)).cast("long").alias(alias)

    # Each of at most 128 rows of a part meets the 80 cases.
    per_case = found.withColumn("case", F.explode(F.array(*[F.struct(*[F.lit(x).alias(a) for x, a in zip(
        (b, k, 1 << k), ("before", "filter", "bit"), strict=True)]) for b, k in cases]))).select("part", "mask", "good", "toxic", "n", "case.*")
    steps = per_case.groupBy("part", "before", "filter").agg(
        total(reaches & ~fails, "kept"), total(reaches & fails, "removed"), total(~reaches & fails, "redundant"),
        total(F.col("mask") == F.col("bit"), "unique_fails"), total(reaches & fails & (F.col("good") == 1), "good_lost"),
        total(reaches & fails & (F.col("toxic") == 1), "toxic_lost"))
    steps = materialise(steps, "filter-steps")
    shares = steps.join(F.broadcast(known.select("before", "filter", "weight")), ["before", "filter"]).groupBy("part", "filter").agg(
        F.sum(F.col("removed") * F.col("weight")).cast("long").alias("shapley"))
    orders = []
    for order in permutations(range(5)):
        for step, k in enumerate(order):
            orders.append(("".join(FILTERS[i] for i in order), step + 1, sum(1 << i for i in order[:step]), k))
    listed = spark.createDataFrame(orders, "filter_order string, step int, before int, filter int")
    return steps.join(shares, ["part", "filter"]).join(F.broadcast(listed), ["before", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
