"""Id filters and the selection of first rows."""

import os

import pytest
from pyspark.sql import functions as F

from lotledger.operators import selection
from lotledger.session import discard, materialise
from lotledger.operators.id_filter import id_filter, may_be_in, merge_filters


def found(df):
    return sorted(r.id for r in df.select("id").collect())


def test_filter_keeps_all_members_and_few_others(spark):
    rows = spark.range(20_000).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT) AS id"))
    wanted = rows.where("id % 10 = 0")
    kept = may_be_in(rows, id_filter(wanted))
    assert found(kept) == list(range(0, 20_000, 10))
    few_bits = may_be_in(rows, id_filter(wanted, bits=1 << 15), bits=1 << 15)
    got = set(found(few_bits))
    assert got >= set(range(0, 20_000, 10)) and 2000 < len(got) < 5000
    assert may_be_in(rows, id_filter(wanted.limit(0))).count() == 0


def test_filter_has_a_fixed_size_and_stays_in_the_scan(spark):
    bitmaps = id_filter(spark.range(200_000), bits=1 << 17)
    assert bitmaps.agg(F.count("*"), F.sum(F.octet_length("__bits"))).first()[:] == (4, 1 << 14)
    plan = may_be_in(spark.range(10), bitmaps)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_filters_of_parts_merge(spark):
    odd, low = spark.range(1, 1000, 2), spark.range(0, 300)
    merged = merge_filters(id_filter(odd), id_filter(low))
    assert found(may_be_in(spark.range(2000), merged)) == sorted(set(range(1, 1000, 2)) | set(range(300)))


@pytest.mark.parametrize("task_rows", [selection.TASK_ROWS, 0])
@pytest.mark.parametrize("rows", [0, 1, 499, 500, 501, 2999, 3000, 9999])
def test_first_rows_with_ties_and_copies(spark, monkeypatch, rows, task_rows):
    monkeypatch.setattr(selection, "TASK_ROWS", task_rows)
    # 1000 keys three times each, a hot key and copies of one row; null comes first.
    table = spark.range(3000).select(
        F.when(F.col("id") % 1000 < 400, F.lit(7)).when(F.col("id") % 1000 == 999, None).otherwise(F.col("id") % 1000).alias("k"),
        F.when(F.col("id") % 1000 < 300, F.lit(0)).otherwise(F.col("id")).alias("v"))
    got = selection.first_rows(table.repartition(5), ["k"], rows).collect()
    want = sorted(((r.k is not None, r.k or 0), r.v) for r in table.collect())
    assert len(got) == min(rows, 3000)
    assert sorted((r.k is not None, r.k or 0) for r in got) == [k for k, _ in want][:rows]
    left = {}
    for r in table.collect():
        left[r.k, r.v] = left.get((r.k, r.v), 0) + 1
    for r in got:  # no row more often than it is there
        left[r.k, r.v] -= 1
        assert left[r.k, r.v] >= 0


def test_first_rows_of_several_columns_in_one_scan(spark):
    table = spark.range(2000).select((F.col("id") % 7).alias("a"), F.md5(F.col("id").cast("string")).alias("b"), "id")
    chosen = selection.first_rows(table, ["a", "b"], 700)
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, table.orderBy("a", "b").limit(700).collect()))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("TakeOrdered", "Exchange", "Limit")) and "FileScan" in plan


def test_first_rows_of_nothing(spark):
    assert selection.first_rows(spark.range(0), ["id"], 5).count() == 0


def test_a_discarded_stage_is_gone_and_others_stay(spark):
    one, two = materialise(spark.range(5), "one"), materialise(spark.range(6), "two")
    files = [p.removeprefix("file://") for p in one.inputFiles()]
    assert files and all(map(os.path.exists, files))
    discard(one)
    assert not any(map(os.path.exists, files)) and two.count() == 6
