"""Merged group states against statistics of all rows."""

import random
import statistics

import pytest

from lotledger.operators import moments
from lotledger.operators.group_stats import drop_outliers, with_zscore
from lotledger.session import materialise

SCHEMA = "model string, price double, n long"


def sample():
    rng = random.Random(11)
    rows = [(m, rng.gauss(1e9, 3.0), i) for m, n in {"a": 300, "b": 40, None: 30, "one": 1}.items() for i in range(n)]
    rows += [("same", 4.0, 1), ("same", 4.0, 2), ("none", None, 1), ("a", None, 5), ("a", 1e9 + 900, 6)]
    rng.shuffle(rows)
    return rows


def state_of(spark, parts):
    states = [moments.group_moments(spark.createDataFrame(p, SCHEMA), "model", "price") for p in parts]
    return moments.merge_moments(*states, key="model")


@pytest.mark.parametrize("cuts", [[], [0], [100], [5, 6, 200], [376]])
def test_states_of_parts_are_that_of_the_whole(spark, cuts):
    rows = sample()
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
    got = {r.model: r for r in state_of(spark, parts).select("*", moments.spread(1).alias("s"), moments.spread(0).alias("p")).collect()}
    values = {}
    for model, price, _ in rows:
        if price is not None:
            values.setdefault(model, []).append(price)
    assert got.keys() == values.keys()
    for model, v in values.items():
        assert got[model].n == len(v) and got[model].mean == pytest.approx(statistics.fmean(v), rel=1e-12)
        assert got[model].p == pytest.approx(statistics.pstdev(v), rel=1e-6, abs=1e-9)
        assert got[model].s is None if len(v) == 1 else got[model].s == pytest.approx(statistics.stdev(v), rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("ddof", [0, 1])
def test_rows_are_judged_as_by_the_full_table(spark, ddof):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA)
    state = state_of(spark, [rows[:150], rows[150:]])

    def table(found):
        return sorted((repr(r.model), repr(r.price), r.n, None if r.z_score is None else round(r.z_score, 4)) for r in found.collect())

    assert table(moments.zscore_by(df, state, "model", "price", ddof)) == table(with_zscore(df, "model", "price", ddof))
    kept = {tuple(r) for r in moments.outliers_by(df, state, "model", "price", ddof).collect()}
    assert kept == {tuple(r) for r in drop_outliers(df, "model", "price", ddof).collect()}
    assert ("a", 1e9 + 900, 6) not in kept


def test_empty_tables_have_no_state(spark):
    assert state_of(spark, [[], []]).count() == 0
    assert state_of(spark, [[], [("x", 2.0, 1)]]).first().mean == 2.0


def test_an_append_reads_no_old_rows(spark):
    old = materialise(spark.createDataFrame(sample(), SCHEMA), "old-rows")
    state = materialise(moments.group_moments(old, "model", "price"), "state")
    merged = moments.merge_moments(state, state_of(spark, [[("a", 1.0, 1)]]), key="model")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "old-rows" not in plan and "price" not in plan.split("parquet")[1].split("\n")[0]
