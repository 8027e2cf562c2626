"""Stored id sets against Python sets, and what a resumed run shuffles."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lotledger.operators import id_sets
from lotledger.session import materialise

EDGES = [0, 1, 32767, 32768, 32769, 65536, 65537, -1, -32767, -32768, -32769, 2**53, 2**63 - 1, -(2**62)]


def frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def found(df):
    return sorted(r.id for r in df.collect())


def test_every_id_comes_back(spark):
    ids = id_sets.id_set(frame(spark, EDGES * 2 + [None]))
    nothing = id_sets.id_set(frame(spark, []))
    assert found(id_sets.ids_between(ids, nothing)) == sorted(EDGES)
    assert found(id_sets.ids_between(ids, ids)) == found(id_sets.ids_between(nothing, ids)) == []
    assert tuple(id_sets.set_progress(nothing, nothing).first()) == (0, 0, 0)


NUMBERS = st.lists(st.one_of(st.sampled_from(EDGES), st.integers(-100, 100), st.integers(30_000, 70_000)), max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(NUMBERS, NUMBERS, NUMBERS)
def test_merged_sets_as_python_sets(spark, listed, first, second):
    a = id_sets.id_set(frame(spark, listed))
    done = id_sets.merge_sets(id_sets.id_set(frame(spark, first)), id_sets.id_set(frame(spark, second)))
    want = set(listed) - set(first) - set(second)
    assert found(id_sets.ids_between(a, done)) == sorted(want)
    assert tuple(id_sets.set_progress(a, done).first()) == (len(set(listed)), len({*first, *second}), len(want))


def test_rows_outside_keep_copies_and_nulls(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(-50_000, 90_000), i) for i in range(3000)] + [(None, -1), (7, -2), (7, -3)]
    inside = [r[0] for r in rows[:1500]]
    table = spark.createDataFrame(rows, "id long, __row long").withColumnRenamed("__row", "bits")
    got = id_sets.rows_outside(table, id_sets.id_set(frame(spark, inside)))
    assert got.columns == ["id", "bits"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, (r for r in rows if r[0] not in set(inside))))


def test_a_second_run_shuffles_bitmaps_and_no_stored_ids(spark):
    stored = materialise(id_sets.id_set(frame(spark, range(200_000))), "stored")
    assert stored.count() <= 8
    merged = id_sets.merge_sets(stored, id_sets.id_set(frame(spark, range(200_000, 200_100))))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Scan parquet", plan.split("Initial Plan")[0])) == 1
    assert merged.selectExpr("sum(bitmap_count(bits)) AS n").first().n == 200_100


@pytest.mark.parametrize("copies", [1, 1000])
def test_copies_of_an_id_are_one(spark, copies):
    assert id_sets.id_set(frame(spark, [5] * copies)).selectExpr("bitmap_count(bits) AS n").first().n == 1


def test_only_full_ranges_become_bitmaps(spark):
    ids = spark.range(-40, 40).select("id").unionAll(spark.createDataFrame([(10**12,), (2**40,), (None,)], "id long")).unionAll(
        spark.range(40_000, 40_100).select("id"))
    full, others = id_sets.split_full(ids, least=40, most=2)
    assert sorted(r.bucket for r in full.collect()) == [0, 2]
    # The range with the ids from 1 to 39 holds too few, and two others hold more.
    assert {r.id for r in others.collect()} == {*range(1, 40), 10**12, 2**40, None}
    left = id_sets.rows_outside(ids, full)
    assert sorted(left.collect(), key=str) == sorted(others.collect(), key=str)
