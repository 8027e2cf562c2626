"""One-hot coding and standardised columns."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.session import materialise


def levels(df: DataFrame, column: str) -> list[str]:
    """The distinct values of a category, sorted. They come to the driver: for few values only."""
    return sorted(row[0] for row in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def one_hot_columns(df: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    """Replace categories by 0/1 columns ``<column>_<value>``, the first of the given values left out."""
    coded = {}
    for column, known in values.items():
        for value in known[1:]:
            coded[f"{column}_{value}"] = F.when(F.col(column) == value, 1).otherwise(0)
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in values],
        *[expression.alias(name) for name, expression in coded.items()],
    )


def numbered(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """``column, number`` of every distinct value in ascending order from 0, and how many there are.

    Values are dealt out over sorted ranges, as many as the session has shuffle partitions; a
    number is the place in its range and the sizes of the ranges before. Only these sizes come
    to the driver.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(F.col(f"`{column}`").alias(column)).where(F.col(f"`{column}`").isNotNull()).distinct()
    dealt = materialise(
        values.repartitionByRange(ranges, f"`{column}`").withColumn("__range", F.spark_partition_id())
        .sortWithinPartitions(f"`{column}`").withColumn("__place", F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))),
        "category-values")
    sizes = sorted(tuple(r) for r in dealt.groupBy("__range").count().collect())
    before, total = [], 0
    for at, size in sizes:
        before.append((at, total))
        total += size
    offsets = spark.createDataFrame(before, "__range int, __before long")
    return dealt.join(F.broadcast(offsets), "__range").select(F.col(f"`{column}`"), (F.col("__before") + F.col("__place")).alias("number")), total


def one_hot(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each category by a sparse 0/1 vector of the same name, for any number of values.

    Places count from the last value in ascending order, and the first value has none. Missing
    values count as it: all zeros. With one value, with missing values only or without rows the
    vectors are empty.
    """
    coded = df
    for column in columns:
        numbers, total = numbered(df, column)
        if total < 2:
            coded = coded.withColumn(f"__{column}", array_to_vector(F.array().cast("array<double>")))
            continue
        numbers = numbers.withColumnRenamed(column, f"__value_{column}")
        place = (F.lit(total - 1) - F.coalesce("number", F.lit(0))).cast("double")
        at = place.alias(f"__at_{column}", metadata={"ml_attr": {"type": "nominal", "num_vals": total, "name": column}})
        joined = coded.join(numbers, F.col(f"`{column}`") == F.col(f"`__value_{column}`"), "left")
        indexed = joined.select(*[F.col(f"`{c}`") for c in coded.columns], at)
        encoder = OneHotEncoder(inputCols=[f"__at_{column}"], outputCols=[f"__{column}"], dropLast=True)
        coded = encoder.fit(indexed).transform(indexed).drop(f"__at_{column}")
    return coded.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in columns], *[F.col(f"`__{c}`").alias(c) for c in columns]
    )


def standardise(df: DataFrame, columns: list[str], ddof: int = 0) -> DataFrame:
    """Mean 0 and standard deviation 1; a constant column becomes 0. One pass finds all moments."""
    spread = F.stddev_samp if ddof else F.stddev_pop
    moments = df.agg(
        *[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[spread(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()

    def scaled(i: int, column: str):
        centred = F.col(f"`{column}`") - F.lit(moments[f"m{i}"])
        return centred / F.lit(moments[f"s{i}"] or 1.0)

    place = {c: i for i, c in enumerate(columns)}
    return df.select(*[
        scaled(place[c], c).alias(c) if c in place else F.col(f"`{c}`") for c in df.columns
    ])
