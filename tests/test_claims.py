"""Claim texts, numbers and imputation on literal rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotledger.functions.claims import claims_text, extract_number, parse_claims
from lotledger.functions.text import none_to_null, split_pair, strip_commas
from lotledger.operators.impute import impute_mean
from lotledger.plans.jobs import clean_history
from lotledger.schemas import HISTORY_RAW, VEHICLES_HISTORY

CLAIMS = [
    ("없음", 0, 0),
    ("1회1,792,240원", 1, 1792240),
    ("1회/442,480원", 1, 442480),
    ("1회미확정", 1, None),
    ("2회/미확정", 2, None),
    ("미확정", None, None),
    ("N/A", None, None),
    (None, None, None),
    ("1,234회미확정", 234, None),
    ("1,234회5원", 1234, 5),
    ("3회", None, None),
    ("", None, None),
]


@pytest.mark.parametrize("text,count,total", CLAIMS)
def test_parse_claims(spark, text, count, total):
    row = spark.createDataFrame([(text,)], "c string").select(parse_claims(F.col("c")).alias("p")).first()["p"]
    assert (row["count"], row["total"]) == (count, total)


def test_extract_number(spark):
    texts = ["전손 0회", "2회", "abc", None, "침수(전손,분손) 13회 2", "99999999999"]
    rows = spark.createDataFrame([(t,) for t in texts], "c string").select(extract_number(F.col("c")).alias("n")).collect()
    assert [r.n for r in rows] == [0, 2, 0, 0, 13, 0]


def test_pair_text_and_none(spark):
    df = spark.createDataFrame([("1회미확정",), ("없음",), ("N/A",)], "c string").select(claims_text(F.col("c")).alias("p"))
    parts = df.select(*split_pair(F.col("p"), "a", "b"))
    assert [tuple(r) for r in parts.collect()] == [("1", "None"), ("0", "0"), ("None", "None")]
    cleaned = parts.select(*[none_to_null(F.col(c)).alias(c) for c in "ab"])
    assert [tuple(r) for r in cleaned.collect()] == [("1", None), ("0", "0"), (None, None)]


def test_strip_commas(spark):
    assert spark.createDataFrame([("1,234,5",)], "c string").select(strip_commas(F.col("c"))).first()[0] == "12345"


@pytest.mark.parametrize("known,fill", [([0, 5], 2), ([0, 7], 4), ([1, 2, 3], 2), ([0, 0, 1], 0), ([3, 4, 4], 4)])
def test_impute_rounds_half_to_even(spark, known, fill):
    rows = [(v, v) for v in known] + [(None, 1)]
    out = impute_mean(spark.createDataFrame(rows, "a long, b long"), ["a"]).collect()
    assert sorted(r.a for r in out) == sorted([*known, fill])


def test_impute_all_missing_stays_missing(spark):
    out = impute_mean(spark.createDataFrame([(None,), (None,)], "a long"), ["a"]).collect()
    assert [r.a for r in out] == [None, None]


def test_impute_is_exact_beyond_double_precision(spark):
    big = 2**53 + 1
    rows = [(big,)] * 3 + [(None,)]
    out = impute_mean(spark.createDataFrame(rows, "a long"), ["a"]).collect()
    assert sum(1 for r in out if r.a == big) == 3


def test_clean_history_schema_and_values(spark):
    row = (1, "12가3456", "모델", "LPG", "1999cc", "2020/01/02", "1회", "2회", "전손 0회", "침수 1회", "도난 0회", "미확정", "1회/500원")
    other = (2, "12가3457", "모델", "LPG", "1999cc", "2020/01/02", "0회", "0회", "전손 0회", "침수 0회", "도난 0회", "2회101원", "없음")
    out = clean_history(spark.createDataFrame([row, other], HISTORY_RAW))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in VEHICLES_HISTORY]
    first = out.where("id = 1").first()
    assert (first.license_changed, first.owner_changed, first.flood) == (1, 2, 1)
    assert (first.damaged_count, first.damaged_total) == (None, 101)
    assert (first.damaged_by_other_count, first.damaged_by_other_total) == (1, 500)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(st.integers(0, 99), st.integers(0, 10**12), st.sampled_from(["{c}회{a:,}원", "{c}회/{a:,}원", "{c}회미확정", "{c}회/미확정"])),
    min_size=20, max_size=60,
))
def test_written_claims_read_back(spark, claims):
    rows = [(i, form.format(c=c, a=a)) for i, (c, a, form) in enumerate(claims)]
    got = spark.createDataFrame(rows, "i int, t string").select("i", parse_claims(F.col("t")).alias("p")).collect()
    for row in got:
        count, amount, form = claims[row.i]
        assert (row.p["count"], row.p["total"]) == (count, None if "미확정" in form else amount)
