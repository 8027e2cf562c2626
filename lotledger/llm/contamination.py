"""Benchmark decontamination: item-sized windows of words that occur in documents.

A set join with prefix filter, in Spark expressions only. The tokens of a window are the
shingles of ``SHINGLE`` words in it. As a window has to be contained whole, one token is a
necessary prefix: the one that is rarest in the documents. Only places at which the text has
such a token become candidates; the place of the token in its window bounds where the window
can lie, and what is within the text is compared word for word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.session import materialise

WINDOW = 10
SHINGLE = 3
#: Windows are sent to every task only while their words and ids take no more than this.
BROADCAST_BYTES = 32 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of digits, letters and non-ASCII characters, A-Z lowered; null has none."""
    known = F.coalesce(text, F.lit(""))
    # For ASCII texts the quick general lowering does the same.
    low = F.when(F.octet_length(known) == F.length(known), F.lower(known)).otherwise(F.translate(known, UPPER, UPPER.lower()))
    return F.array_remove(F.split(low, NO_WORD), "")


def _token(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, at + i) for i in range(size)])


def _windows(items: DataFrame) -> DataFrame:
    """Distinct windows with the ids of their items; an item without id takes no part."""
    listed = items.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    size = F.least(F.size("words"), F.lit(WINDOW))
    cut = listed.where((F.size("words") > 0) & F.col("item").isNotNull()).select(
        "item", F.transform(F.sequence(F.lit(0), F.size("words") - size), lambda i: F.slice("words", i + 1, size)).alias("all"))
    return (
        cut.select("item", F.explode("all").alias("window"))
        .groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
        .withColumn("size", F.size("window"))
    )


def _tokens(windows: DataFrame) -> DataFrame:
    """``window, token, offset`` for every shingle; windows of fewer words are one shingle."""
    kinds = []
    for size in range(1, SHINGLE + 1):
        of_size = windows.where(F.col("size") >= SHINGLE if size == SHINGLE else F.col("size") == size)
        places = of_size.select("*", F.explode(F.sequence(F.lit(0), F.col("size") - size)).alias("offset"))
        kinds.append(places.withColumn("token", _token(F.col("window"), F.col("offset"), size)).withColumn("shingle", F.lit(size)))
    return reduce(DataFrame.unionByName, kinds)


def _places(texts: DataFrame, size: int, keep: list[str]) -> DataFrame:
    """Every shingle of ``size`` words of every text with its place."""
    at = texts.select(*keep, "words", F.size("words").alias("n_words"), F.posexplode("words").alias("place", "first"))
    rest = [F.get("words", F.col("place") + i) for i in range(1, size)]
    token = F.xxhash64(F.lit(size), F.col("first"), *rest).alias("token")
    return at.where(F.col("place") + size <= F.col("n_words")).select(*keep, "words", "n_words", "place", token)


def _within(places: DataFrame) -> DataFrame:
    """Candidates whose window would begin and end inside the text."""
    start = F.col("place") - F.col("offset")
    return places.withColumn("start", start).where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))


def _small(table: DataFrame, bytes_of: Column, limit: int) -> bool:
    return (table.agg(F.sum(bytes_of)).first()[0] or 0) <= limit


def hits(texts: DataFrame, items: DataFrame, keep: list[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``start, size, items`` of every window found in ``words`` of ``texts``, beside ``keep``.

    Two passes over the texts: one counts the tokens of items, one joins the rarest token of
    every window. Windows are broadcast while they take ``broadcast_bytes`` or less. Beyond
    that places are shuffled by token without their words, and the candidates of a text are
    compared with it in a join on ``keep``, which then has to identify the text.
    """
    tokens = materialise(_tokens(_windows(items)), "item-tokens")
    sizes = [row[0] for row in tokens.select("shingle").distinct().collect()]  # three at most
    if not sizes:
        return texts.select(*keep, F.lit(0).alias("start"), F.lit(0).alias("size"), F.array(F.lit("")).alias("items")).where("false")
    distinct = materialise(tokens.select("shingle", "token").distinct(), "distinct-tokens")
    few = _small(distinct, F.lit(16), broadcast_bytes)
    counted = []
    for size in sizes:
        looked_for = distinct.where(F.col("shingle") == size).select("token")
        seen = _places(texts, size, []).select("token").join(F.broadcast(looked_for) if few else looked_for, "token", "left_semi")
        counted.append(seen.groupBy("token").agg(F.count("*").alias("seen")).withColumn("shingle", F.lit(size)))
    seen = materialise(reduce(DataFrame.unionByName, counted), "token-counts")
    # A window with a token that no document has cannot occur.
    rarest = tokens.join(seen, ["shingle", "token"], "left").groupBy("window", "size", "shingle").agg(
        F.min(F.struct("seen", "token", "offset")).alias("rarest"), F.first("items").alias("items"),
        F.bool_and(F.col("seen").isNotNull()).alias("possible"))
    prefixes = materialise(
        rarest.where("possible").select("shingle", "window", "size", "items", "rarest.token", "rarest.offset"), "prefixes")
    weight = F.lit(48) + F.octet_length(F.array_join("window", " ")) + F.octet_length(F.array_join("items", " ")) + 16 * F.size("items")
    few = _small(prefixes, weight, broadcast_bytes)
    found = []
    for size in sizes:
        wanted = prefixes.where(F.col("shingle") == size).drop("shingle")
        places = _places(texts, size, keep)
        if few:
            near = _within(places.join(F.broadcast(wanted), "token"))
            found.append(near.where(F.slice("words", F.col("start") + 1, F.col("size")) == F.col("window")).select(*keep, "start", "size", "items"))
            continue
        near = _within(places.drop("words").join(wanted, "token"))
        listed = near.groupBy(*keep).agg(F.collect_list(F.struct("start", "size", "items", "window")).alias("near"))
        same = reduce(Column.__and__, [F.col(f"t.{c}").eqNullSafe(F.col(f"n.{c}")) for c in keep])
        both = texts.alias("t").join(listed.alias("n"), same).select(*[F.col(f"t.{c}").alias(c) for c in keep], "words", "near")
        equal = F.filter("near", lambda n: F.slice("words", n["start"] + 1, n["size"]) == n["window"])
        found.append(both.select(*keep, F.explode(equal).alias("n")).select(*keep, "n.start", "n.size", "n.items"))
    return reduce(DataFrame.unionByName, found)


def decontaminate(docs: DataFrame, items: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items, contaminated``.

    ``n_hit`` counts words inside any occurrence of a window, ``items`` are the ids of items
    with occurring windows, as text and sorted. Null and empty texts have no words. Repeated
    rows give repeated results; rows with one id but different texts are kept apart. Items
    without words or without id take no part, items that share an id count once. Other columns
    of either table are not read.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    keep = ["doc_id", "text_key"]
    found = hits(texts, items.select("item_id", "text"), keep, broadcast_bytes)
    base = texts.select(*keep, F.size("words").cast("long").alias("n_words"), F.lit(1).alias("copies"),
                        F.lit(None).cast("struct<start:int,size:int>").alias("span"), F.lit(None).cast("array<string>").alias("items"))
    placed = found.select(*keep, F.lit(0).cast("long").alias("n_words"), F.lit(0).alias("copies"),
                          F.struct(F.col("start").cast("int").alias("start"), F.col("size").cast("int").alias("size")).alias("span"), "items")
    # Places of a text are at most ten for each of its words, so a row holds what its text allows.
    per_text = base.unionByName(placed).groupBy(*keep).agg(
        F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"),
        F.sort_array(F.collect_set("span")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda done, s: F.struct(
            (done["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(done["end"], s["start"]))).cast("long").alias("n"),
            F.greatest(done["end"], s["start"] + s["size"]).alias("end")),
        lambda done: done["n"])
    one = per_text.select("doc_id", "n_words", covered.alias("n_hit"), "items", (F.size("spans") > 0).alias("contaminated"), "copies")
    return one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies")
