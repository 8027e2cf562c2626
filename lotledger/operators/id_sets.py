"""Exact sets of ids as bitmaps over id ranges, stored once and extended by what is new.

A set is a table ``bucket, bits`` with one bitmap of 4 KB for each range of 32,768 ids that holds
any. Sets merge bit by bit, so a resumed run shuffles bitmaps of the new ids and never the ids that
are stored already. Ids are whole numbers; bitmaps pay where a range holds more than a few hundred.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.operators.id_filter import holds

#: Ids of one bitmap, a fixed value of the bitmap functions.
RANGE = 32768
_WORD = 8  # bytes
#: Ids that a range has to hold for its bitmap to take 8 bytes an id at most.
FULL = 512
#: Bitmaps that every task is sent: 16 MB whatever the number of ids.
SENT = 4096


def id_set(ids: DataFrame, key: str = "id") -> DataFrame:
    """The set of the ids; null is in no set and copies collapse in each task."""
    found = ids.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"))
    return found.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def split_full(ids: DataFrame, key: str = "id", least: int = FULL, most: int = SENT) -> tuple[DataFrame, DataFrame]:
    """The set of the ids in the fullest ranges, at most ``most`` bitmaps, and the ids that are not in it.

    ``ids`` are distinct; they are counted by range before any bitmap is made, so ids that lie far
    apart cost no bitmaps. Null is among the other ids.
    """
    bucket = F.bitmap_bucket_number(F.col(key).cast("long"))
    counted = ids.where(F.col(key).isNotNull()).groupBy(bucket.alias("__bucket")).agg(F.count("*").alias("n"))
    full = F.broadcast(counted.where(F.col("n") >= least).orderBy(F.desc("n"), "__bucket").limit(most).select("__bucket"))
    same = bucket == F.col("__bucket")
    return id_set(ids.join(full, same, "left_semi"), key), ids.join(full, same, "left_anti")


def merge_sets(*sets: DataFrame) -> DataFrame:
    """The union of sets."""
    united = reduce(DataFrame.unionAll, [s.select("bucket", "bits") for s in sets])
    return united.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _id(bucket: Column, position: Column) -> Column:
    return F.when(bucket > 0, (bucket - 1) * RANGE + position + 1).otherwise(bucket * RANGE - position)


def ids_between(all_ids: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Ids that are in the first set and not in the second.

    Ranges, and words of 64 ids in them, that the second holds as well are not looked into.
    """
    theirs = done.select("bucket", F.col("bits").alias("done"))
    open_ranges = all_ids.join(theirs, "bucket", "left").where("done IS NULL OR bits <> done")
    nothing = F.lit(bytes(_WORD))
    word = F.explode(F.sequence(F.lit(0), F.lit(RANGE // 8 // _WORD - 1)))
    words = open_ranges.select("bucket", "bits", "done", word.alias("word")).select(
        "bucket", "word",
        F.substring("bits", F.col("word") * _WORD + 1, F.lit(_WORD)).alias("mine"),
        F.coalesce(F.substring("done", F.col("word") * _WORD + 1, F.lit(_WORD)), nothing).alias("theirs"),
    ).where((F.col("mine") != nothing) & (F.col("mine") != F.col("theirs")))
    bits = words.select("*", F.explode(F.sequence(F.lit(0), F.lit(8 * _WORD - 1))).alias("bit"))
    left = bits.where(holds("mine", F.col("bit")) & ~holds("theirs", F.col("bit")))
    return left.select(_id(F.col("bucket"), F.col("word") * 8 * _WORD + F.col("bit")).alias(key))


def rows_outside(rows: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is not in the set; rows without an id and copies stay."""
    held = ids.select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits"))
    number = F.col(key).cast("long")
    same = F.bitmap_bucket_number(number) == F.col("__bucket")
    return rows.join(held, same & holds("__bits", F.bitmap_bit_position(number)), "left_anti")


def set_progress(all_ids: DataFrame, done: DataFrame) -> DataFrame:
    """One row: ``total``, ``done`` and ``remaining`` ids, from the bits of both sets and their union."""
    counted = reduce(DataFrame.unionAll, [
        part.select(F.lit(name).alias("part"), F.bitmap_count("bits").alias("n"))
        for name, part in (("total", all_ids), ("done", done), ("both", merge_sets(all_ids, done)))
    ])
    n = {name: F.coalesce(F.sum(F.when(F.col("part") == name, F.col("n"))), F.lit(0)) for name in ("total", "done", "both")}
    return counted.agg(n["total"].alias("total"), n["done"].alias("done"), (n["both"] - n["done"]).alias("remaining"))
