"""Sets of ids as bitmaps of fixed size, to leave rows out before they are worked on or shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**27 bits are 4096 bitmaps of 4 KB: 16 MB whatever the number of ids.
BITS = 1 << 27


def _slot(key: Column, bits: int) -> Column:
    """The bit of an id, counted from 1 as the bitmap functions do."""
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def holds(bits: str, position: Column) -> Column:
    """Whether the bit at a position, counted from 0, is set."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (position % 8).cast("int"))) != 0


def id_filter(ids: DataFrame, key: str = "id", bits: int = BITS) -> DataFrame:
    """The ids as bits of at most ``bits / 32768`` bitmaps; null is in no set.

    Every task sends its bitmaps, not its ids, and they are merged bit by bit. A set too large
    for its bits only lets more other ids pass.
    """
    slots = ids.where(F.col(key).isNotNull()).select(_slot(F.col(key), bits).alias("slot"))
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("__bitmap")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("__bits"))


def merge_filters(*filters: DataFrame) -> DataFrame:
    """The filter of the union of the sets; all have to have the same number of bits."""
    united = filters[0]
    for other in filters[1:]:
        united = united.unionAll(other)
    return united.groupBy("__bitmap").agg(F.bitmap_or_agg("__bits").alias("__bits"))


def may_be_in(rows: DataFrame, passing: DataFrame, key: str = "id", bits: int = BITS) -> DataFrame:
    """Rows whose id is in the set, and a share of others given by how full its bits are.

    The bitmaps, of fixed size, go to every task, so the rows stay where they are scanned.
    """
    slot = _slot(F.col(key), bits)
    held = holds("__bits", F.bitmap_bit_position(slot))
    return rows.join(F.broadcast(passing), (F.bitmap_bucket_number(slot) == F.col("__bitmap")) & held, "left_semi")
