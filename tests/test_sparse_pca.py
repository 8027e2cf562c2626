"""Principal components from sparse entries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotledger.operators.sparse_pca import fit_sparse_pca, sparse_entries
from lotledger.plans import jobs

KIND = "row long, column string, value double"


def entries_of(spark, x):
    return spark.createDataFrame([(int(i), f"c{j:03d}", float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], KIND)


def standard(x):
    x = x[:, x.std(0) > 0]
    return (x - x.mean(0)) / x.std(0)


def test_equals_eigenvectors_of_the_correlations(spark):
    random = np.random.default_rng(0)
    x = (random.standard_normal((120, 3)) * [5, 3, 2]) @ random.standard_normal((3, 25)) + 0.3 * random.standard_normal((120, 25))
    x[random.random(x.shape) < 0.05] = 0
    x[:, 7] = 2.0  # does not vary
    x[5] = 0
    x[:, 7] = 2.0
    fitted = fit_sparse_pca(entries_of(spark, x), 3, tolerance=1e-6)
    z = standard(x)
    values, vectors = np.linalg.eigh(z.T @ z / len(z))
    values, vectors = values[::-1], vectors[:, ::-1]
    assert np.allclose([r.ratio for r in fitted.ratios.orderBy("component").collect()], values[:3] / values.sum(), atol=1e-6)
    got = fitted.loadings.orderBy("column").collect()
    assert [r["column"] for r in got] == [f"c{j:03d}" for j in range(25) if j != 7]
    for i in range(3):
        want = vectors[:, i] * np.sign(vectors[np.abs(vectors[:, i]).argmax(), i])
        assert np.allclose([r[f"pc{i + 1}"] for r in got], want, atol=5e-3)
    first = {r.row: r.pc1 for r in fitted.scores().collect()}
    want = vectors[:, 0] * np.sign(vectors[np.abs(vectors[:, 0]).argmax(), 0])
    assert np.allclose([first.get(i, np.nan) for i in range(120) if i in first], [(z @ want)[i] for i in range(120) if i in first], atol=5e-3)


def test_rows_without_entries_repeated_entries_and_bad_values(spark):
    x = np.array([[1.0, 2.0], [2.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 0.0]])
    rows = [(0, "c000", 0.5), (0, "c000", 0.5), (0, "c001", 2.0), (1, "c000", 2.0), (2, "c001", 1.0),
            (1, "c001", None), (2, "c000", float("nan")), (0, None, 3.0)]
    fitted = fit_sparse_pca(spark.createDataFrame(rows, KIND), 5, n_rows=5)
    r = np.corrcoef(x.T)[0, 1]
    assert np.allclose([c.ratio for c in fitted.ratios.orderBy("component").collect()], sorted([(1 + r) / 2, (1 - r) / 2], reverse=True))
    nothing = fit_sparse_pca(spark.createDataFrame([], KIND), 2)
    assert nothing.ratios.count() == nothing.loadings.count() == nothing.scores().count() == 0
    same = fit_sparse_pca(spark.createDataFrame([(1, "a", 2.0), (2, "a", 2.0)], KIND), 2)
    assert same.ratios.collect() == []


def test_columns_that_depend_on_each_other(spark):
    a = np.random.default_rng(1).standard_normal(50)
    fitted = fit_sparse_pca(entries_of(spark, np.stack([a, 2 * a, -a], axis=1)), 3)
    assert [round(r.ratio, 6) for r in fitted.ratios.collect()] == [1.0]


def test_more_columns_than_a_square_matrix_allows(spark):
    """20,000 columns whose first component is known: half the rows hold the even ones, half the odd ones."""
    entries = spark.range(200).select(
        F.col("id").alias("row"),
        F.explode(F.sequence(F.col("id") % 2, F.lit(19_999).cast("long"), F.lit(2).cast("long"))).alias("column"), F.lit(1.0).alias("value"))
    fitted = fit_sparse_pca(entries, 1, extra=1)
    assert [round(r.ratio, 6) for r in fitted.ratios.collect()] == [1.0]
    assert fitted.loadings.where(F.abs(F.abs("pc1") - F.lit(20_000.0) ** -0.5) < 1e-9).count() == 20_000


def test_same_components_as_the_dense_job(spark):
    random = np.random.default_rng(2)
    rows = [(i, "m", float(a), float(a + b), "x" if b > 0 else None if b < -1 else "y", float(3 * a - b))
            for i, (a, b) in enumerate(random.standard_normal((150, 2)).tolist())]
    features = spark.createDataFrame(rows, "id long, model string, a double, b double, fuel string, price double").dropna()
    dense = [r.ratio for r in jobs.pca_diagnosis(features.drop("id"), "m")[0].orderBy("component").collect()]
    ratios, scores = jobs.pca_diagnosis_sparse(features, "m", ["id"], components=2)
    assert [r.ratio for r in ratios.orderBy("component").collect()] == pytest.approx(dense[:2], abs=1e-6)
    assert scores.columns == ["id", "pc1", "pc2", "label"] and scores.count() == features.count()
    assert scores.agg(F.avg("pc1")).first()[0] == pytest.approx(0, abs=1e-6)
    assert scores.agg(F.var_pop("pc1")).first()[0] == pytest.approx(3 * dense[0], abs=1e-5)


def test_entries_of_a_table(spark):
    df = spark.createDataFrame([(1, 2, "b", 0.0), (2, None, "a", 1.5), (3, 4, None, None)], "id long, `n.x` int, t string, z double")
    got = {(r.row.id, r["column"], r.value) for r in sparse_entries(df, ["id"]).collect()}
    assert got == {(1, "n.x", 2.0), (1, "t_b", 1.0), (2, "z", 1.5), (3, "n.x", 4.0)}
    assert sparse_entries(df.select("id"), ["id"]).count() == 0
