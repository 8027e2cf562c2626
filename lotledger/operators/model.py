"""Price models with Spark ML: assembling, splitting, fitting, scoring and PCA."""

from __future__ import annotations

from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    LinearRegression, LinearRegressionModel, RandomForestRegressionModel, RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.operators.relational import columns_except, project_label
from lotledger.schemas import NOT_FEATURES


def assemble(
    df: DataFrame, exclude: list[str] = NOT_FEATURES, keep: list[str] | None = None,
    label: str = "price", on_null: str = "error",
) -> DataFrame:
    """``features`` vector of every column not excluded, beside ``label`` and the ``keep`` columns."""
    keep = keep or []
    inputs = columns_except(df, [*exclude, *keep])
    # Names may hold dots or blanks after one-hot coding; the assembler only sees plain ones.
    plain = df.select(
        *[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(inputs)],
        *[F.col(f"`{c}`") for c in dict.fromkeys([*keep, label])],
    )
    names = [f"f{i}" for i in range(len(inputs))]
    vectors = VectorAssembler(inputCols=names, outputCol="features", handleInvalid=on_null).transform(plain)
    return project_label(vectors, [*keep, "features"], label)


def hash_split(df: DataFrame, key: str, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``is_train``: the same rows whatever the file layout, chosen by a hash of ``key``."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000
    return df.withColumn("is_train", bucket < int(share * 10_000))


def random_split(df: DataFrame, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([share, 1 - share], seed=seed)
    return train, test


def fit_linear(train: DataFrame) -> LinearRegressionModel:
    """Least squares without regularisation."""
    return LinearRegression(featuresCol="features", labelCol="label", regParam=0.0).fit(train)


def fit_forest(train: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42) -> RandomForestRegressionModel:
    return RandomForestRegressor(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed
    ).fit(train)


def predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row with ``rmse`` and ``mse``, from one pass over the predictions."""
    error = F.col("label") - F.col("prediction")
    mse = F.avg(error * error)
    return predictions.agg(F.sqrt(mse).alias("rmse"), mse.alias("mse"))


def fit_pca(vectors: DataFrame, components: int) -> PCAModel:
    return PCA(k=components, inputCol="features", outputCol="scores").fit(vectors)


def pca_ratios(model: PCAModel, vectors: DataFrame) -> DataFrame:
    """Explained share of variance per component, first component first."""
    ratios = [(i + 1, float(r)) for i, r in enumerate(model.explainedVariance.toArray())]
    return vectors.sparkSession.createDataFrame(ratios, "component int, ratio double")


def pca_scores(model: PCAModel, vectors: DataFrame, components: int = 2) -> DataFrame:
    """``pc1 .. pcN`` beside ``label``.

    A component's sign is arbitrary: it is set so that the largest loading is positive, the
    first of them when several are equally large.
    """
    loadings = model.pc.toArray()
    largest = abs(loadings).round(9).argmax(axis=0)
    signs = [1.0 if loadings[largest[i], i] >= 0 else -1.0 for i in range(components)]
    scores = vector_to_array("scores")
    return model.transform(vectors).select(
        *[(scores[i] * F.lit(signs[i])).alias(f"pc{i + 1}") for i in range(components)],
        "label",
    )
