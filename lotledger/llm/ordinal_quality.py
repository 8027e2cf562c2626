"""Text quality by ordinal regression with cumulative links.

A text becomes the square roots of its shares of hashed byte groups and word shapes. One weight
vector serves all grades; ordered thresholds cut its score, so that the chance of a grade above
``k`` is the logistic of the score less threshold ``k``. The expected grade and the chance of the
upper grades come from the same score.

The weights are fitted on a bounded sample of graded rows; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotledger.llm.common import bounded_sample, held_out, python_tasks
from lotledger.llm.shingles import SPACE, U, mix, parts, text_bytes
from lotledger.session import materialise

FIT_ROWS = 6_000  # graded rows that the weights are fitted on, at most about
BUCKETS = 2_048  # places of the hashed features
ROUNDS = 300
RIDGE = 1e-4

# Byte classes of word shapes, fixed values: other, upper, lower, digit, space, mark, beyond ASCII.
CLASSES = np.zeros(256, np.uint64)
CLASSES[65:91], CLASSES[97:123], CLASSES[48:58], CLASSES[128:] = 1, 2, 3, 6
CLASSES[SPACE] = 4
CLASSES[[i for i in range(33, 127) if not chr(i).isalnum()]] = 5


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Matrices of features, some texts at a time; an empty text has none but the first."""
    data, offsets = text_bytes(column)
    for first, last in parts(offsets):
        raw = data[offsets[first]:offsets[last]].astype(U)
        bounds = offsets[first:last + 1] - offsets[first]
        n = last - first
        out = np.zeros((n, BUCKETS), np.float32)
        owner = np.repeat(np.arange(n), np.diff(bounds))
        shapes = CLASSES[raw.astype(np.int64)]
        for salt, signal, size in ((1, raw, 3), (2, shapes, 5)):
            if len(raw) < size:
                continue
            group = np.zeros(len(raw) - size + 1, U)
            for k in range(size):
                group = group * U(257) + signal[k:k + len(group)]
            own = owner[size - 1:] == owner[:len(group)]
            place = (mix(group + U(salt << 50)) % U(BUCKETS // 2)).astype(np.int64) + (salt - 1) * (BUCKETS // 2)
            flat = np.bincount(owner[:len(group)][own] * BUCKETS + place[own], minlength=n * BUCKETS)
            out += flat.reshape(n, BUCKETS)
        half = out.reshape(n, 2, BUCKETS // 2)
        half /= np.maximum(half.sum(axis=2, keepdims=True), 1)
        out = np.sqrt(half).reshape(n, BUCKETS)
        out[:, 0] += np.diff(bounds) == 0
        yield out


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than the grades

    def tails(self, x: np.ndarray) -> np.ndarray:
        """For each row the chance of a grade above 0, above 1, ..."""
        return 1 / (1 + np.exp(-np.clip((x @ self.weights)[:, None] - self.thresholds[None, :], -30, 30)))


def fit_matrix(x: np.ndarray, grade: np.ndarray, grades: int) -> Model:
    """Maximum likelihood with a ridge, by accelerated gradient steps from zero.

    Thresholds stay ordered: they are a first one and positive distances.
    """
    n = max(1, len(x))
    share = np.array([(np.sum(grade > k) + 1) / (n + 2) for k in range(grades - 1)])
    start = np.log((1 - share) / share)
    start = np.maximum.accumulate(start + np.arange(grades - 1) * 1e-3)
    first, gaps = start[0], np.log(np.maximum(np.diff(start), 1e-3))
    w = np.zeros(x.shape[1])
    parameters = np.concatenate([w, [first], gaps])
    moment, square = np.zeros_like(parameters), np.zeros_like(parameters)
    x64 = x.astype(np.float32)
    for turn in range(1, ROUNDS + 1):
        w, first, gaps = parameters[:x.shape[1]], parameters[x.shape[1]], parameters[x.shape[1] + 1:]
        edges = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        score = x64 @ w.astype(np.float32)
        upper = np.column_stack([np.ones(len(x)), 1 / (1 + np.exp(-np.clip(score[:, None] - edges, -30, 30))), np.zeros(len(x))])
        rows = np.arange(len(x))
        above, beyond = upper[rows, grade], upper[rows, grade + 1]
        chance = np.maximum(above - beyond, 1e-12)
        slope_above, slope_beyond = above * (1 - above), beyond * (1 - beyond)
        by_score = -(slope_above - slope_beyond) / chance / n
        by_edge = np.zeros(grades - 1)
        for k in range(grades - 1):
            by_edge[k] = (np.sum((slope_above / chance)[grade == k + 1]) - np.sum((slope_beyond / chance)[grade == k])) / n
        later = np.cumsum(by_edge[::-1])[::-1]
        gradient = np.concatenate([x64.T @ by_score.astype(np.float32) + RIDGE * w, [later[0]], later[1:] * np.exp(gaps)])
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient * gradient
        parameters = parameters - 0.1 * (moment / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    w, first, gaps = parameters[:x.shape[1]], parameters[x.shape[1]], parameters[x.shape[1] + 1:]
    return Model(w.astype(np.float32), first + np.concatenate([[0], np.cumsum(np.exp(gaps))]))


def fit(docs: DataFrame, labels: DataFrame, grade: Column, grades: int, rows: int = FIT_ROWS) -> Model:
    """A model from at most about ``rows`` graded texts whose ids are not held out.

    ``grade`` is computed over ``labels`` and counts from 0. Rows without an id, grade or text take
    no part; without any row all texts get the same chances.
    """
    python_tasks(docs.sparkSession)
    graded = labels.withColumn("__grade", grade.cast("int")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    graded = graded.where((F.col("__grade") >= 0) & (F.col("__grade") < grades))
    chosen = bounded_sample(graded.groupBy("doc_id").agg(F.max("__grade").alias("__grade")), "doc_id", rows)
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null").join(F.broadcast(chosen), "doc_id")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grades_, at = batch.column("__grade"), 0
            for x in features(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0] * len(x), pa.int32()), pa.array([r.tobytes() for r in x], pa.binary()), grades_.slice(at, len(x))],
                    names=["one", "x", "grade"],
                )
                at += len(x)

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        rows_, found = sorted_rows(group)
        model = fit_matrix(np.frombuffer(b"".join(rows_), np.float32).reshape(-1, BUCKETS), np.array(found), grades)
        return pd.DataFrame({"w": [model.weights.tobytes()], "t": [model.thresholds.tolist()]})

    table = materialise(sample.select("text", "__grade").mapInArrow(rows_of, "one int, x binary, grade int"), "graded-sample")
    found = table.groupBy("one").applyInPandas(fitted, "w binary, t array<double>").first()
    if found is None:
        return Model(np.zeros(BUCKETS, np.float32), np.arange(grades - 1, dtype=float))
    return Model(np.frombuffer(found["w"], np.float32), np.array(found["t"]))


def sorted_rows(group: pd.DataFrame) -> tuple[list[bytes], list[int]]:
    """Features and grades in an order that does not depend on how the rows arrived."""
    pairs = sorted(zip(group["x"], group["grade"], strict=True))
    return [x for x, _ in pairs], [g for _, g in pairs]


def score(docs: DataFrame, model: Model, upper: int = 1) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability``, the chance of a grade of ``upper`` or more.

    Null counts as empty. Other columns stay; columns named like the results are replaced.
    """
    python_tasks(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in docs.schema.fields if f.name not in ("expected_grade", "tail_probability")]
    names = [f.name for f in fields]
    schema = T.StructType(fields).add("expected_grade", T.DoubleType()).add("tail_probability", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = [shared.value.tails(x) for x in features(batch.column("text").cast(pa.string()))]
            tails = np.vstack([np.zeros((0, len(shared.value.thresholds))), *tails])
            results = [pa.array(tails.sum(axis=1)), pa.array(tails[:, upper - 1].copy())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *results], names=[*names, "expected_grade", "tail_probability"])

    return docs.select(*names).mapInArrow(run, schema)
