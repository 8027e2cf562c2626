"""Principal components of tables with very many columns.

The table is kept as its entries that are not zero. A block of a few directions is multiplied with the
correlation matrix by two joins a round, without forming that matrix; only products of the block with
itself, a number for each pair of its directions, come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.operators.categories import numbered
from lotledger.session import discard, materialise


def sparse_entries(df: DataFrame, key: list[str], texts: list[str] | None = None) -> DataFrame:
    """``row, column, value`` of what is not zero: numbers as they are, categories as 0/1 columns.

    ``row`` is a struct of the ``key`` columns. Categories are the ``texts``, by default all text
    columns; their columns are named ``<column>_<value>``, the first value in ascending order left
    out, so its rows count as zero. Missing values count as zero.
    """
    others = [c for c in df.columns if c not in key]
    if texts is None:
        texts = [name for name, kind in df.select(*[F.col(f"`{c}`") for c in others]).dtypes if kind == "string"]
    first = df.agg(F.lit(1), *[F.min(F.col(f"`{c}`").cast("string")).alias(f"t{i}") for i, c in enumerate(texts)]).first()
    parts = []
    for name in others:
        value = F.col(f"`{name}`")
        if name in texts:
            least = first[f"t{texts.index(name)}"]
            one = F.when(value.cast("string") != least, 1.0) if least is not None else F.lit(None).cast("double")
            parts.append(F.struct(F.concat(F.lit(f"{name}_"), value.cast("string")).alias("column"), one.alias("value")))
        else:
            parts.append(F.struct(F.lit(name).alias("column"), value.cast("double").alias("value")))
    empty = F.array().cast("array<struct<column:string,value:double>>")
    filled = F.filter(F.array(*parts), lambda e: e["value"].isNotNull() & (e["value"] != 0)) if parts else empty
    return df.select(F.struct(*[F.col(f"`{c}`") for c in key]).alias("row"), F.inline(filled))


@dataclass
class SparsePCA:
    """Fitted components: ``ratios`` is ``component, ratio``; ``loadings`` is ``column, pc1, ..``."""

    ratios: DataFrame
    loadings: DataFrame
    _scaled: DataFrame
    _numbered: DataFrame
    components: int

    def zero_scores(self) -> dict[str, float]:
        """The scores of a row without entries."""
        names = [f"pc{i + 1}" for i in range(self.components)]
        centre = self._numbered.agg(F.lit(1), *[F.sum(F.col("mean") * F.col(c)).alias(c) for c in names]).first()
        return {c: -centre[c] for c in names}

    def scores(self) -> DataFrame:
        """``row, pc1, ..`` of every row that holds an entry of a column that varies."""
        sums = [(F.sum(F.col("value") * F.col(c)) + F.lit(zero)).alias(c) for c, zero in self.zero_scores().items()]
        if not sums:
            return self._scaled.select("row").distinct()
        return self._scaled.join(self._numbered, "number").groupBy("row").agg(*sums)


def _total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def _mixed(names: list[str], weights: np.ndarray, alias: str, start: int = 0) -> list[Column]:
    """Combinations of columns, one for each column of ``weights``."""
    return [
        _total([F.col(n) * F.lit(float(w)) for n, w in zip(names, weights[:, i], strict=True)]).alias(f"{alias}{i + start}")
        for i in range(weights.shape[1])
    ]


def _products(df: DataFrame, left: list[str], right: list[str]) -> np.ndarray:
    """The symmetric matrix of sums of products."""
    pairs = [(i, j) for i in range(len(left)) for j in range(i + 1)]
    sums = df.agg(*[F.sum(F.col(left[i]) * F.col(right[j])).alias(f"s{i}_{j}") for i, j in pairs]).first()
    out = np.zeros((len(left), len(left)))
    for i, j in pairs:
        out[i, j] = out[j, i] = sums[f"s{i}_{j}"]
    return out


def fit_sparse_pca(
    entries: DataFrame, components: int, n_rows: int | None = None, extra: int = 6,
    rounds: int = 40, tolerance: float = 1e-8,
) -> SparsePCA:
    """Components of the standardised columns of ``row, column, value``, by randomised subspace iteration.

    Rows without entries are all zeros and only known by ``n_rows``. Entries of one row and column
    add up; nulls, and values that are not finite, count as zero. Columns that do not vary are left
    out, and there are never more components than columns that vary. Rounds end when no wanted
    ratio moves by more than ``tolerance`` of itself; components of nearly equal variance need more
    of them, and ``extra`` directions beside the wanted ones make them fewer. A component's sign is
    set so that the largest loading is positive, the first in ascending order when several are
    equally large.
    """
    spark = entries.sparkSession
    value = F.col("value").cast("double")
    usable = entries.where(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")) & F.col("column").isNotNull())
    cells = materialise(
        usable.groupBy("row", "column").agg(F.sum(value).alias("value")).where("value <> 0"), "pca-cells")
    n = n_rows if n_rows is not None else entries.select("row").distinct().count()
    # The moments of a column from those of its entries and the number of its zeros.
    held = cells.groupBy("column").agg(F.count("*").alias("k"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    share = F.col("k") / F.lit(float(max(n, 1)))
    variance = share * F.col("v") + share * (1 - share) * F.col("m") * F.col("m")
    moments = held.select("column", F.sqrt(variance).alias("sd"), (share * F.col("m")).alias("mean")).where("sd > 0")
    moments = materialise(moments, "pca-moments")
    numbers, size = numbered(moments, "column")
    columns = materialise(moments.join(numbers, "column").select("column", "number", "sd", (F.col("mean") / F.col("sd")).alias("mean")), "pca-columns")
    width = min(size, components + extra)
    components = min(components, size)
    if not size:
        return SparsePCA(
            spark.createDataFrame([], "component int, ratio double"), columns.select("column"),
            cells.select("row", F.lit(0).cast("long").alias("number"), "value").where("false"), columns.select("number", "mean"), 0)
    scaled = materialise(
        cells.join(columns, "column").select("row", "number", (F.col("value") / F.col("sd")).alias("value")), "pca-scaled")

    # Directions to begin with: numbers between -1 and 1 from a hash, the same in every attempt of a task.
    q = [f"q{j}" for j in range(width)]
    uniform = [(F.xxhash64("column", F.lit(j)) / F.lit(2.0**63)).alias(c) for j, c in enumerate(q)]
    begun = columns.select("number", "mean", *uniform)
    values, vectors = np.linalg.eigh(_products(begun, q, q))
    block = begun.select("number", "mean", *_mixed(q, vectors / np.sqrt(values), "q"))
    stored, before = None, None
    for _ in range(max(1, rounds)):
        block = materialise(block, "pca-block")
        if stored is not None:
            discard(stored)
        t, y = [f"t{j}" for j in range(len(q))], [f"y{j}" for j in range(len(q))]
        centre = block.agg(*[F.sum(F.col("mean") * F.col(c)).alias(c) for c in q]).first()
        # Rows times directions, centred; then columns times these. The sum of centred rows is zero.
        rows = scaled.join(block.select("number", *q), "number").groupBy("row").agg(
            *[(F.sum(F.col("value") * F.col(a)) - F.lit(centre[a])).alias(b) for a, b in zip(q, y, strict=True)])
        turned = scaled.join(rows, "row").groupBy("number").agg(
            *[(F.sum(F.col("value") * F.col(a)) / F.lit(float(n))).alias(b) for a, b in zip(y, t, strict=True)])
        stored = materialise(block.join(turned, "number"), "pca-turned")
        discard(block)
        values, vectors = np.linalg.eigh(_products(stored, q, t))
        order = [i for i in np.argsort(-values) if values[i] > 1e-12 * values.max()]
        values, vectors = values[order], vectors[:, order]
        now = values[:components]
        if before is not None and len(now) == len(before) and np.all(np.abs(now - before) <= tolerance * np.abs(now)):
            break
        before = now
        # Turned to the directions found and scaled, the block is nearly orthogonal before it is made so.
        gram = vectors.T @ _products(stored, t, t) @ vectors
        scale = 1 / np.sqrt(np.diag(gram))
        lengths, axes = np.linalg.eigh(gram * scale[:, None] * scale)
        good = lengths > 1e-12
        block = stored.select("number", "mean", *_mixed(t, (vectors * scale) @ (axes[:, good] / np.sqrt(lengths[good])), "q"))
        q = q[:int(good.sum())]
    components = min(components, len(values))
    names = [f"pc{i + 1}" for i in range(components)]
    found = stored.select("number", "mean", *_mixed([f"q{j}" for j in range(vectors.shape[0])], vectors[:, :components], "pc", 1))
    largest = [
        F.max_by(F.signum(c), F.struct(F.round(F.abs(F.col(c)), 9), -F.col("number"))).alias(c) for c in names
    ]
    signs = found.agg(*largest).first()
    signed = found.select("number", "mean", *[(F.col(c) * F.lit(signs[c] or 1.0)).alias(c) for c in names])
    ratios = [(i + 1, float(v) / size) for i, v in enumerate(values[:components])]
    return SparsePCA(
        spark.createDataFrame(ratios, "component int, ratio double"),
        columns.select("column", "number").join(signed.drop("mean"), "number").drop("number"), scaled, signed, components)
