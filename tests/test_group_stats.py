"""Outlier filters against a plain Python computation, on every join-back path."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lotledger.operators import group_stats as gs


def sample_rows():
    rng = random.Random(5)
    groups = {"a": 400, "b": 60, "c": 11, "one": 1, None: 40}
    rows = [(g, float(rng.gauss(100, 10)), i) for g, n in groups.items() for i in range(n)]
    rows += [("a", 1000.0, 1), ("b", -900.0, 2), (None, 5000.0, 3), ("same", 3.0, 1), ("same", 3.0, 2)]
    return rows


def expected(rows, ddof):
    by_group = {}
    for g, v, _ in rows:
        by_group.setdefault(g, []).append(v)
    kept = []
    for g, v, i in rows:
        values = by_group[g]
        if len(values) <= ddof:
            continue
        sd = statistics.stdev(values) if ddof else statistics.pstdev(values)
        if sd and abs((v - statistics.fmean(values)) / sd) < 3:
            kept.append((g, v, i))
    return sorted(kept, key=repr)


@pytest.mark.parametrize("ddof", [0, 1])
@pytest.mark.parametrize("passes", [1, 2])
def test_drop_outliers(spark, ddof, passes):
    rows = sample_rows()
    df = spark.createDataFrame(rows, "g string, v double, i int")
    want = rows
    for _ in range(passes):
        want = expected(want, ddof)
    got = gs.drop_outliers(df, "g", "v", ddof, passes)
    assert got.columns == df.columns
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_statistics_of_each_row(spark):
    df = spark.createDataFrame(sample_rows(), "g string, v double, i int")
    got = gs.attach_stats(df, "g", "v")
    by_group = {}
    for g, v, _ in sample_rows():
        by_group.setdefault(g, []).append(v)
    rows = got.collect()
    assert len(rows) == len(sample_rows())
    for r in rows:
        assert r["__mean"] == pytest.approx(statistics.fmean(by_group[r.g]))
        if len(by_group[r.g]) == 1:
            assert r["__sd"] is None
        else:
            assert r["__sd"] == pytest.approx(statistics.stdev(by_group[r.g]), abs=1e-9)


def test_broadcast_path_does_not_shuffle_rows(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    plan = gs.drop_outliers(df, "g", "v")._jdf.queryExecution().executedPlan().toString()
    # The one exchange is that of the partial statistics.
    assert "BroadcastHashJoin" in plan and "Window" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_zscore_and_means(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "g string, v double")
    z = {(r.g, r.v): r.z_score for r in gs.with_zscore(df, "g", "v").collect()}
    assert z[("a", 1.0)] == pytest.approx(-1 / math.sqrt(2)) and z[("b", 2.0)] is None
    assert {r.g: r.mean_price for r in gs.with_group_mean(df, "g", "v").collect()} == {"a": 2.0, "b": 2.0}
    assert {r.g: r.stddev_price for r in gs.with_group_stddev(df, "g", "v", ddof=0).collect()} == {"a": 1.0, "b": 0.0}
    assert {r.g: r.price for r in gs.mean_by(df, "g", "v").collect()} == {"a": 2.0, "b": 2.0}
