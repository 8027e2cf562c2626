"""Model operators against closed forms and numpy."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lotledger.operators import categories, model as models
from lotledger.plans import jobs


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2]
    y = 4 + x @ [2.0, -1.0, 7.0] + rng.normal(size=400)
    rows = [(int(i), float(a), float(b), float(c), float(p)) for i, ((a, b, c), p) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, price double"), x, y


def test_assemble_order_and_nulls(spark):
    df = spark.createDataFrame([(1, 2, 3, "m", 9), (None, 5, 6, "m", 8)], "a int, b int, `c.d` int, model string, price int")
    got = models.assemble(df, on_null="skip").select(vector_to_array("features"), "label").collect()
    assert [list(r[0]) for r in got] == [[1.0, 2.0, 3.0]] and got[0].label == 9
    with pytest.raises(Exception, match="(?i)null"):
        models.assemble(df).collect()


def test_hash_split_is_stable(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    share = models.hash_split(df, "k").where("is_train").count() / 20_000
    assert abs(share - 0.8) < 0.01
    again = models.hash_split(df.repartition(7), "k")
    assert again.exceptAll(models.hash_split(df, "k")).count() == 0
    train, test = models.random_split(df)
    assert train.count() + test.count() == 20_000


def test_linear_matches_least_squares(table):
    df, x, y = table
    vectors = models.assemble(df, exclude=["id", "price"])
    fitted = models.fit_linear(vectors)
    want, *_ = np.linalg.lstsq(np.c_[np.ones(len(x)), x], y, rcond=None)
    assert np.allclose([fitted.intercept, *fitted.coefficients], want, atol=1e-6)
    metrics = models.evaluate(models.predict(fitted, vectors)).first()
    error = y - np.c_[np.ones(len(x)), x] @ want
    assert metrics.mse == pytest.approx((error**2).mean()) and metrics.rmse == pytest.approx(math.sqrt(metrics.mse))


def test_forest_beats_the_mean(table):
    df, _, y = table
    vectors = models.assemble(df, exclude=["id", "price"])
    metrics = models.evaluate(models.predict(models.fit_forest(vectors, trees=10, depth=5), vectors)).first()
    assert metrics.mse < y.var() / 2


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, "a", "y"), (3, None, "x"), (4, "c", "x")], "id int, k string, j string")
    wide = categories.one_hot_columns(df, {"k": ["a", "b", "c"], "j": ["x", "y"]}).orderBy("id")
    assert wide.columns == ["id", "k_b", "k_c", "j_y"]
    assert [tuple(r) for r in wide.collect()] == [(1, 1, 0, 0), (2, 0, 0, 1), (3, 0, 0, 0), (4, 0, 1, 0)]
    sparse = categories.one_hot(df, ["k", "j"]).orderBy("id").collect()
    assert [(r.k.toArray().tolist(), r.j.toArray().tolist()) for r in sparse] == [
        ([0, 1], [0]), ([0, 0], [1]), ([0, 0], [0]), ([1, 0], [0])]


def test_one_hot_of_many_values(spark):
    df = spark.range(12_000).select("id", F.format_string("%06d", F.col("id")).alias("k"))
    first, last = (categories.one_hot(df.where(f"id in (0, {n})").unionAll(df), ["k"]).where(f"id = {n}").first().k for n in (0, 11_999))
    assert first.size == last.size == 11_999 and first.numNonzeros() == 0 and last.indices.tolist() == [0]


def test_one_hot_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, None)], "id int, k string, `j.x` string")
    for table in (df, df.where("false")):
        coded = categories.one_hot(table, ["k", "j.x"])
        assert coded.columns == ["id", "k", "j.x"]
        assert [(r.k.size, r["j.x"].size) for r in coded.collect()] == [(0, 0)] * table.count()
    mixed = categories.one_hot(df.withColumn("m", F.col("id") % 2).withColumn("m", F.col("m").cast("string")), ["k", "m"])
    assert sorted((r.id, r.k.size, r.m.toArray().tolist()) for r in mixed.collect()) == [(1, 0, [1.0]), (2, 0, [0.0]), (3, 0, [1.0])]


def test_numbers_of_values_are_dense_and_ordered(spark):
    df = spark.range(5000).select(F.md5((F.col("id") % 1700).cast("string")).alias("k")).unionAll(spark.sql("SELECT NULL"))
    numbers, total = categories.numbered(df, "k")
    rows = sorted((r.number, r.k) for r in numbers.collect())
    assert total == 1700 and [n for n, _ in rows] == list(range(1700)) and [k for _, k in rows] == sorted(k for _, k in rows)


@pytest.mark.parametrize("ddof", [0, 1])
def test_standardise(spark, table, ddof):
    df, x, _ = table
    got = categories.standardise(df.withColumn("k", F.lit(3)), ["a", "b", "c", "k"], ddof).orderBy("id").collect()
    want = (x - x.mean(0)) / x.std(0, ddof=ddof)
    assert np.allclose([[r.a, r.b, r.c] for r in got], want) and {r.k for r in got} == {0.0}


def test_pca_matches_eigenvectors(table):
    df, x, _ = table
    scaled = categories.standardise(df, ["a", "b", "c"])
    vectors = models.assemble(scaled, exclude=["id", "price"])
    fitted = models.fit_pca(vectors, 3)
    z = (x - x.mean(0)) / x.std(0)
    values, loadings = np.linalg.eigh(np.cov(z.T))
    order = values.argsort()[::-1]
    ratios = [r.ratio for r in models.pca_ratios(fitted, vectors).orderBy("component").collect()]
    assert np.allclose(ratios, values[order] / values.sum())
    first = loadings[:, order[0]]
    first = first * np.sign(first[np.abs(first).argmax()])
    got = models.pca_scores(fitted, vectors, 2)
    assert got.columns == ["pc1", "pc2", "label"]
    assert np.allclose(sorted(r.pc1 for r in got.collect()), sorted(z @ first), atol=1e-6)


def test_training_jobs(spark, table):
    df, _, _ = table
    features = df.withColumn("model", F.lit("m")).withColumn("fuel", F.when(F.col("id") % 2 == 0, "x").otherwise("y"))
    held_out = models.hash_split(df, "id").where(~F.col("is_train")).count()
    for train in (jobs.train_linear, lambda f, m, split_key: jobs.train_forest(f, m, trees=5, depth=3, split_key=split_key)):
        predictions, metrics = train(features, "m", split_key="id")
        assert predictions.columns == ["prediction", "label"] and predictions.count() == held_out
        assert metrics.first().mse == pytest.approx(metrics.first().rmse ** 2)
    ratios, scores = jobs.pca_diagnosis(features.drop("id"), "m")
    assert ratios.agg(F.sum("ratio")).first()[0] == pytest.approx(1.0)
    assert ratios.count() == 4 and scores.count() == 400
