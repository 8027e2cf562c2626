"""Renames, joins, set algebra, caps and projections over listing tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.operators.selection import first_rows
from lotledger.schemas import INSURANCE_NAMES, NOT_FEATURES, ROW_CAP


def rename_all(df: DataFrame, names: list[str]) -> DataFrame:
    """Replace every column name by position."""
    return df.toDF(*names)


def harmonise(df: DataFrame, scheme: str, target: str = "current") -> DataFrame:
    """Insurance columns from one header style to another; other columns stay."""
    return df.withColumnsRenamed(dict(zip(INSURANCE_NAMES[scheme], INSURANCE_NAMES[target], strict=True)))


def join_vehicles(price: DataFrame, history: DataFrame, status: DataFrame) -> DataFrame:
    """Listings with a price, a history and a status, ``id`` kept once.

    Adaptive execution splits the partitions of hot ids in both joins, see ``build_session``.
    """
    return price.join(history, "id").join(status, "id")


def join_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join on differently named keys; only the left key is kept."""
    return left.join(right.withColumnRenamed(right_key, left_key), left_key)


def _per_id(all_ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row per distinct id with ``listed`` and ``stored`` as 0 or 1.

    A tagged union needs one shuffle, and copies of an id collapse before it.
    """
    tagged = all_ids.select(key, F.lit(1).alias("listed"), F.lit(0).alias("stored")).unionAll(
        done.select(key, F.lit(0), F.lit(1))
    )
    return tagged.groupBy(key).agg(F.max("listed").alias("listed"), F.max("stored").alias("stored"))


def remaining_ids(all_ids: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids of ``all_ids`` that are not in ``done``."""
    return _per_id(all_ids, done, key).where("listed = 1 AND stored = 0").select(key)


def exclude_ids(all_ids: DataFrame, *excluded: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is in none of the ``excluded`` tables; duplicates stay."""
    seen = reduce(DataFrame.unionAll, [e.select(key) for e in excluded]).distinct()
    return all_ids.join(seen, key, "left_anti")


def dedupe_last(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the one that comes last in ``order``.

    ``max_by`` keeps one candidate per key and task before the shuffle, where a ranking
    window would send every copy of a key to one task.
    """
    rest = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return df.groupBy(key).agg(last).select(key, "last.*").select(*df.columns)


def lookup_default(
    df: DataFrame, dim: DataFrame, key: str, value: str, default: str, order: list[str]
) -> DataFrame:
    """Add ``value`` looked up by ``key`` as text, or ``default`` when the key is unknown.

    The last row of ``dim`` in ``order`` wins when a key is repeated.
    """
    last = dedupe_last(dim.select(key, value, *[c for c in order if c not in (key, value)]), key, order)
    text = F.coalesce(F.col(value).cast("string"), F.lit(default))
    return df.join(last.select(key, value), key, "left").withColumn(value, text)


def concat_tables(tables: list[DataFrame]) -> DataFrame:
    """All rows of all tables, columns matched by name, gaps filled with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def cap_rows(df: DataFrame, order: list[str], cap: int = ROW_CAP) -> DataFrame:
    """At most ``cap + 1`` rows: the cap is tested after a row has been taken."""
    return first_rows(df, order, cap + 1)


def cap_to_target(new: DataFrame, done: DataFrame, target: int, order: list[str], key: str = "id") -> DataFrame:
    """As many new rows as are missing from ``target``, given the distinct ids already stored."""
    stored = done.select(key).distinct().count()
    return first_rows(new, order, max(0, target - stored))


def filter_min(df: DataFrame, column: str, least: float) -> DataFrame:
    return df.where(F.col(column) >= least)


def filter_model(df: DataFrame, model: str, column: str = "model") -> DataFrame:
    return df.where(F.col(column) == model)


def drop_cols(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*columns)


def columns_except(df: DataFrame, excluded: list[str] = NOT_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in excluded]


def project_label(df: DataFrame, columns: list[str | Column], label: str = "price") -> DataFrame:
    """The given columns, and ``label`` under the name ``label``."""
    return df.select(*columns, F.col(label).alias("label"))


def preview(df: DataFrame, rows: int = 5, order: list[str] | None = None) -> DataFrame:
    """Some rows, or the first ones in ``order``."""
    return (df.orderBy(*order) if order else df).limit(rows)


def progress_counts(all_ids: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """One row: distinct ``total``, ``done`` and ``remaining`` ids."""
    listed, stored = F.col("listed") == 1, F.col("stored") == 1
    return _per_id(all_ids, done, key).where(F.col(key).isNotNull()).agg(
        F.count_if(listed).alias("total"),
        F.count_if(stored).alias("done"),
        F.count_if(listed & ~stored).alias("remaining"),
    )
