"""Missing amounts filled with the rounded column mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rounded_mean(column: str) -> Column:
    """Aggregate: mean of an integer column rounded half to even.

    The sum is exact, so the value does not depend on the order tasks finish in.
    """
    total = F.sum(F.col(column).cast("decimal(38,0)")).cast("double")
    return F.bround(F.try_divide(total, F.count(column))).cast("long")


def to_int(number: Column) -> Column:
    """Round half to even, as LONG."""
    return F.bround(number).try_cast("long")


def impute_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill the nulls of each column with its rounded mean; known zeros count in the mean.

    All means come from one scalar subquery, which reads only these columns.
    """
    means = df.agg(F.struct(*[rounded_mean(c).alias(c) for c in columns]).alias("means")).scalar()
    return df.withColumns({c: F.coalesce(to_int(F.col(c)), means[c]) for c in columns})
