"""Count, mean and squared deviations per group as a stored state that appended rows extend.

The state of a table is one row per group. After an append only the new rows are aggregated and
the two states are merged, which gives the statistics of all rows without reading the old ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.schemas import OUTLIER_Z


def group_moments(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per group with values: ``key, n, mean, m2``; null keys form one group."""
    v = F.col(value).cast("double")
    return df.where(v.isNotNull()).groupBy(key).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"))


def _joint(a: Column, b: Column) -> Column:
    """The moments of two disjoint sets of values from those of each."""
    n, delta = a["n"] + b["n"], b["mean"] - a["mean"]
    return F.struct(
        n.alias("n"),
        (a["mean"] + delta * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + delta * delta * a["n"] * b["n"] / n).alias("m2"),
    )


def merge_moments(*states: DataFrame, key: str) -> DataFrame:
    """The state of all rows behind the given states, which share no rows.

    A group has as many rows to merge as there are states. They are merged in a fixed order.
    """
    united = reduce(DataFrame.unionAll, [s.select(key, "n", "mean", "m2") for s in states])
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    parts = F.sort_array(F.collect_list(F.struct("n", "mean", "m2")))
    return united.groupBy(key).agg(F.aggregate(parts, none, _joint).alias("all")).select(key, "all.*")


def spread(ddof: int = 1) -> Column:
    """Standard deviation from a state; null where the group has no more than ``ddof`` values."""
    return F.sqrt(F.try_divide(F.col("m2"), F.col("n") - ddof))


def zscore_by(df: DataFrame, state: DataFrame, key: str, value: str, ddof: int = 1, name: str = "z_score") -> DataFrame:
    """Distance of each row from its group's stored mean; null without a state or spread."""
    known = state.select(F.col(key).alias("__key"), F.col("mean").alias("__mean"), spread(ddof).alias("__sd"))
    z = F.try_divide(F.col(value) - F.col("__mean"), F.col("__sd"))
    joined = df.join(known, F.col(key).eqNullSafe(F.col("__key")), "left")
    return joined.withColumn(name, z).drop("__key", "__mean", "__sd")


def outliers_by(df: DataFrame, state: DataFrame, key: str, value: str, ddof: int = 1, limit: float = OUTLIER_Z) -> DataFrame:
    """Rows strictly within ``limit`` standard deviations of their group's stored mean."""
    return zscore_by(df, state, key, value, ddof, "__z").where(F.abs("__z") < limit).drop("__z")
