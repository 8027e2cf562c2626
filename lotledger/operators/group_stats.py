"""Per-group statistics on every row, z-scores and outlier filters.

A window brings each group whole into one task, which fails for a group that holds a third
of the rows. Statistics are therefore aggregated first (each task sends one partial row per
group) and joined to the rows by the group. Spark broadcasts them while they are small; beyond
that adaptive execution splits the rows of a large group over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.schemas import OUTLIER_Z

_SD = {0: F.stddev_pop, 1: F.stddev_samp}


def group_stats(df: DataFrame, key: str, value: str, ddof: int = 1) -> DataFrame:
    """One row per group: ``__mean`` and ``__sd`` of ``value``."""
    return df.groupBy(F.col(key).alias("__key")).agg(
        F.avg(value).alias("__mean"),
        _SD[ddof](value).alias("__sd"),
    )


def attach_stats(df: DataFrame, key: str, value: str, ddof: int = 1) -> DataFrame:
    """Add ``__mean`` and ``__sd`` of the row's group; null keys form one group."""
    stats = group_stats(df, key, value, ddof)
    return df.join(stats, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def _with(df: DataFrame, key: str, value: str, ddof: int, **columns: Column) -> DataFrame:
    """Add ``columns``, written over ``__mean`` and ``__sd`` of the row's group."""
    return attach_stats(df, key, value, ddof).withColumns(columns).drop("__mean", "__sd")


def with_group_mean(df: DataFrame, key: str, value: str, name: str = "mean_price") -> DataFrame:
    return _with(df, key, value, 1, **{name: F.col("__mean")})


def with_group_stddev(df: DataFrame, key: str, value: str, ddof: int = 1, name: str = "stddev_price") -> DataFrame:
    return _with(df, key, value, ddof, **{name: F.col("__sd")})


def _z(value: str) -> Column:
    return F.try_divide(F.col(value) - F.col("__mean"), F.col("__sd"))


def with_zscore(df: DataFrame, key: str, value: str, ddof: int = 1, name: str = "z_score") -> DataFrame:
    """Distance from the group mean in standard deviations; null where there is no spread."""
    return _with(df, key, value, ddof, **{name: _z(value)})


def drop_outliers(
    df: DataFrame, key: str, value: str, ddof: int = 1, passes: int = 1, limit: float = OUTLIER_Z
) -> DataFrame:
    """Rows strictly within ``limit`` standard deviations of their group's mean.

    Groups without spread have no z-score and are dropped. Each further pass works on the
    survivors with fresh statistics.
    """
    for _ in range(passes):
        df = with_zscore(df, key, value, ddof, "__z").where(F.abs("__z") < limit).drop("__z")
    return df


def mean_by(df: DataFrame, key: str, value: str, name: str = "price") -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name))
