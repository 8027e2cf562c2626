"""Joins, set algebra and caps, also where keys are hot."""

import pytest
from pyspark.sql import functions as F

from lotledger.operators import relational as rel
from lotledger.operators.group_stats import attach_stats
from lotledger.schemas import INSURANCE_NAMES


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def three(spark):
    """Key 7 fills most of the first table, key 9 most of the second; null keys never match."""
    a = spark.createDataFrame([(7, i) for i in range(60)] + [(9, 1), (1, 1), (None, 1)], "id long, a int")
    b = spark.createDataFrame([(9, i) for i in range(60)] + [(7, 1), (7, 2), (1, 5), (None, 2)], "id long, b int")
    c = spark.createDataFrame([(7, 1), (9, 1), (9, 2), (1, 1), (3, 3)], "id long, c int")
    return a, b, c


def test_joins_are_split_on_hot_keys(spark, three):
    """Both joins of a chain, and the join to group statistics, are split by adaptive execution."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        price = spark.range(20_000).repartition(8).select(F.when(F.col("id") < 15_000, 7).otherwise(F.col("id")).alias("id"), F.col("id").alias("price"))
        other = spark.range(20_000).repartition(8)
        joined = rel.join_vehicles(price, other.withColumn("h", F.lit(1)), other.withColumn("s", F.lit(2)))
        assert len(joined.collect()) == 20_000
        assert joined._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin(skew=true)") >= 2
        stats = attach_stats(price.withColumn("model", F.col("id")), "model", "price")
        assert len(stats.collect()) == 20_000
        assert "SortMergeJoin(skew=true)" in stats._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_join_keeps_repeats_and_drops_nulls(three):
    a, b, c = three
    assert rel.join_vehicles(a, b, c).count() == 60 * 2 + 60 * 2 + 1


def test_rename_and_harmonise(spark):
    current = spark.createDataFrame([tuple("abcdefghi")], INSURANCE_NAMES["current"])
    old = rel.rename_all(current, INSURANCE_NAMES["report"])
    assert rel.harmonise(old, "report").columns == INSURANCE_NAMES["current"]
    assert rel.harmonise(old.withColumn("brand", F.lit("x")), "report", "merge").columns == [*INSURANCE_NAMES["merge"], "brand"]


def test_join_on_keeps_left_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    right = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e")], "price_id long, y string")
    assert rows(rel.join_on(left, right, "id", "price_id")) == [(2, "b", "c"), (2, "b", "d")]


def test_remaining_and_excluded(spark):
    everything, done, failed = ids(spark, [1, 1, 2, 3, 4, 4]), ids(spark, [2, 2]), ids(spark, [3, 9])
    assert rows(rel.remaining_ids(everything, done)) == [(1,), (3,), (4,)]
    assert rows(rel.exclude_ids(everything, done, failed)) == [(1,), (1,), (4,), (4,)]


def test_dedupe_last_and_lookup(spark):
    prices = spark.createDataFrame([(1, 10, 0), (1, 20, 1), (2, 30, 0), (2, None, 5)], "id long, price int, pos int")
    assert rows(rel.dedupe_last(prices, "id", ["pos"])) == [(1, 20, 1), (2, None, 5)]
    looked = rel.lookup_default(ids(spark, [1, 2, 3]), prices, "id", "price", "가격 없음", ["pos"])
    assert rows(looked) == [(1, "20"), (2, "가격 없음"), (3, "가격 없음")]


def test_concat_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "b string, id long")
    assert rows(rel.concat_tables([a, b])) == [(1, "x", None), (2, None, "y"), (2, None, "y")]


def test_caps(spark):
    df = spark.range(1000).repartition(16).withColumnRenamed("id", "id")
    assert rows(rel.cap_rows(df, ["id"], 5)) == [(i,) for i in range(6)]
    assert rel.cap_rows(df, ["id"], 5000).count() == 1000
    done = ids(spark, [1, 1, 2, 3])
    assert rows(rel.cap_to_target(df, done, 5, ["id"])) == [(0,), (1,)]
    assert rel.cap_to_target(df, done, 2, ["id"]).count() == 0


def test_projections(spark):
    df = spark.createDataFrame([(1, 100, "m", 5)], "id long, price int, model string, cc int")
    assert rel.drop_cols(df, ["cc", "absent"]).columns == ["id", "price", "model"]
    assert rel.columns_except(df) == ["id"]
    assert rel.project_label(df, ["id"]).columns == ["id", "label"]
    assert rel.filter_min(df, "price", 200).count() == 0
    assert rel.filter_model(df, "m").count() == 1
    assert rel.preview(df, 5).count() == 1


def test_progress_counts(spark):
    out = rel.progress_counts(ids(spark, [1, 1, 2, 3]), ids(spark, [2, 2, 9])).first()
    assert (out.total, out.done, out.remaining) == (3, 2, 2)
