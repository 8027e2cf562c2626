"""Scalar features on literal rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lotledger.functions import features as ff
from lotledger.functions import text as tx


def one(spark, value, function, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(function(F.col("c"))).first()[0]


@pytest.mark.parametrize("text,flag", [("없음", 0), ("있음", 1), ("있음 / 렌트", 1), (None, 1), ("", 1)])
def test_flag_present(spark, text, flag):
    assert one(spark, text, ff.flag_present) == flag


@pytest.mark.parametrize("number,flag", [(0, 0), (1, 1), (5, 1), (None, 1)])
def test_flag_nonzero(spark, number, flag):
    assert one(spark, number, ff.flag_nonzero, "int") == flag


@pytest.mark.parametrize("text,flag", [("수동", 1), ("오토", 0), ("-", 0), (None, 0)])
def test_flag_equals(spark, text, flag):
    assert one(spark, text, lambda c: ff.flag_equals(c, "수동")) == flag


@pytest.mark.parametrize("text,km", [("87,115km", 87115), ("-", None), (None, None), ("12km 34", 12), ("99,999,999,999km", None)])
def test_parse_mileage(spark, text, km):
    assert one(spark, text, ff.parse_mileage) == km


@pytest.mark.parametrize("text,km", [("87,115km", 87115), ("-", None), ("12km 34", 1234)])
def test_digits_only(spark, text, km):
    assert one(spark, text, ff.digits_only) == km


@pytest.mark.parametrize("text,cc", [("2999cc", 2999), ("1,999cc", None), (None, None), ("cc", None)])
def test_parse_cc(spark, text, cc):
    assert one(spark, text, ff.parse_cc) == cc


@pytest.mark.parametrize("text,day", [("2013/01/02", dt.date(2013, 1, 2)), ("2013-01-02", None), ("2013/13/40", None), (None, None)])
def test_parse_date(spark, text, day):
    assert one(spark, text, ff.parse_date) == day


@pytest.mark.parametrize("as_of", ["2024-12-01", dt.date(2024, 12, 1)])
def test_car_age(spark, as_of):
    assert one(spark, "2013/01/02", lambda c: ff.car_age(c, as_of)) == pytest.approx(11.912388774811772, abs=1e-12)


def test_saturate(spark):
    assert one(spark, 50_000.0, ff.saturate, "double") == pytest.approx(1 - math.exp(-0.5))


def test_tokens(spark):
    assert one(spark, "a|b|c", lambda c: tx.first_token(c, "|")) == "a"
    assert one(spark, "plain", lambda c: tx.first_token(c, "|")) == "plain"
    assert one(spark, "차량, 12가3456 ", lambda c: tx.nth_token(c, ", ", 2, " ")) == "12가3456"
    assert one(spark, "등록 (2020/01/01)", lambda c: tx.nth_token(c, " ", -1, ")")) == "(2020/01/01"
    assert one(spark, "only", lambda c: tx.nth_token(c, ", ", 2)) is None


@pytest.mark.parametrize("text,out", [("", "N/A"), ("  ", "N/A"), (None, "N/A"), (" x ", "x")])
def test_default_text(spark, text, out):
    assert one(spark, text, tx.default_text) == out
