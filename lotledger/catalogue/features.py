"""Scalar features and the feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotledger.catalogue.base_sql import AS_OF, over_vehicles
from lotledger.catalogue.common import history, joined, rounded, vehicles
from lotledger.functions import features as ff
from lotledger.plans import jobs, vehicle_tables as vt
from lotledger.schemas import YES_NO_COLUMNS


def flag_present(spark, sf_dir):
    return vt.status(spark, sf_dir).select("id", *[ff.flag_present(F.col(c)).alias(c) for c in YES_NO_COLUMNS])


def flag_nonzero(spark, sf_dir):
    return history(spark, sf_dir).select("id", *[ff.flag_nonzero(F.col(c)).alias(c) for c in ("total_loss", "flood")])


def flag_equals(spark, sf_dir):
    return vt.status(spark, sf_dir).select("id", ff.flag_equals(F.col("transmission"), "수동").alias("manual_transmission"))


def merge_claims(spark, sf_dir):
    columns = ["id", "damaged_count", "damaged_total", "damaged_by_other_count", "damaged_by_other_total"]
    return jobs.merge_claims(history(spark, sf_dir).select(*columns), keep_other_count=True)


def merge_claims_all(spark, sf_dir):
    columns = ["id", "damaged_count", "damaged_total", "damaged_by_other_count", "damaged_by_other_total"]
    return jobs.merge_claims(history(spark, sf_dir).select(*columns), keep_other_count=False)


def _one(source, column, function, name=None):
    """One derived column beside the id."""
    def run(spark, sf_dir):
        derived = function(F.col(column)).alias(name or column)
        return rounded(source(spark, sf_dir).select("id", derived))
    return run


def log_features(spark, sf_dir):
    counts = history(spark, sf_dir).select("id", "owner_changed", "damaged_count", "damaged_total")
    return rounded(jobs.log_features(counts, ["owner_changed", "damaged_count", "damaged_total"]))


_UNUSED = ("id", "license", "license_changed", "theft", "warranty")  # no feature table has them


def _table(job):
    def run(spark, sf_dir):
        columns = [c for c in joined(spark, sf_dir).columns if c not in _UNUSED]
        return rounded(job(vehicles(spark, sf_dir, columns), AS_OF))
    return run


QUERIES = {
    "flag_present": flag_present,
    "flag_nonzero": flag_nonzero,
    "flag_equals": flag_equals,
    "merge_claims": merge_claims,
    "merge_claims_all": merge_claims_all,
    "parse_mileage": _one(vt.status, "mileage", ff.parse_mileage),
    "digits_only": _one(vt.status, "mileage", ff.digits_only),
    "parse_cc": _one(vt.history_raw, "cc", ff.parse_cc),
    "parse_date": _one(vt.history_raw, "registration_date", lambda c: ff.parse_date(c).cast("string")),
    "car_age": _one(vt.history_raw, "registration_date", lambda c: ff.car_age(c, AS_OF), "car_age"),
    "log_features": log_features,
    "saturate": _one(vt.status, "mileage", lambda c: ff.saturate(ff.parse_mileage(c))),
    "features_cluster": _table(jobs.features_cluster),
    "features_log": _table(jobs.features_log),
    "features_early": _table(jobs.features_early),
    "features_pop": _table(jobs.features_pop),
}

_FLAGS = ", ".join(f"CASE WHEN {c} = '없음' THEN 0 ELSE 1 END AS {c}" for c in YES_NO_COLUMNS)
_MILEAGE = "TRY_CAST(replace(regexp_extract(mileage, '([0-9][0-9,]*)', 1), ',', '') AS INTEGER)"
_DAY = "CAST(strptime(registration_date, '%Y/%m/%d') AS DATE)"
_LOGGED = """
  round(ln(1 + owner_changed), 6) AS owner_changed, round(ln(1 + damaged_count), 6) AS damaged_count,
  round(ln(1 + damaged_total), 6) AS damaged_total, round(ln(1 + car_age), 6) AS car_age,
  round(1 - exp(-ln(1 + mileage) / 100000), 6) AS mileage"""
_POP = ", ".join(
    f"round({c}, 6) AS {c}" for c in ("owner_changed", "damaged_count", "damaged_total", "mileage", "car_age"))

ORACLES = {
    "flag_present": over_vehicles(f"SELECT id, {_FLAGS} FROM status"),
    "flag_nonzero": over_vehicles("""
        SELECT id, CASE WHEN total_loss = 0 THEN 0 ELSE 1 END AS total_loss,
               CASE WHEN flood = 0 THEN 0 ELSE 1 END AS flood FROM history"""),
    "flag_equals": over_vehicles(
        "SELECT id, CASE WHEN transmission = '수동' THEN 1 ELSE 0 END AS manual_transmission FROM status"),
    "merge_claims": over_vehicles("""
        SELECT id, damaged_count + damaged_by_other_count AS damaged_count,
               damaged_total + damaged_by_other_total AS damaged_total, damaged_by_other_count FROM history"""),
    "merge_claims_all": over_vehicles("""
        SELECT id, damaged_count + damaged_by_other_count AS damaged_count,
               damaged_total + damaged_by_other_total AS damaged_total FROM history"""),
    "parse_mileage": over_vehicles(f"SELECT id, {_MILEAGE} AS mileage FROM status"),
    "digits_only": over_vehicles(
        "SELECT id, TRY_CAST(regexp_replace(mileage, '[^0-9]', '', 'g') AS INTEGER) AS mileage FROM status"),
    "parse_cc": over_vehicles("SELECT id, TRY_CAST(replace(cc, 'cc', '') AS INTEGER) AS cc FROM history_raw"),
    "parse_date": over_vehicles(f"SELECT id, CAST({_DAY} AS VARCHAR) AS registration_date FROM history_raw"),
    "car_age": over_vehicles(
        f"SELECT id, round(date_diff('day', {_DAY}, DATE '{AS_OF}') / 365.25, 6) AS car_age FROM history_raw"),
    "log_features": over_vehicles("""
        SELECT id, round(ln(1 + owner_changed), 6) AS owner_changed, round(ln(1 + damaged_count), 6) AS damaged_count,
               round(ln(1 + damaged_total), 6) AS damaged_total FROM history"""),
    "saturate": over_vehicles(f"SELECT id, round(1 - exp(-{_MILEAGE} / 100000), 6) AS mileage FROM status"),
    "features_cluster": over_vehicles("SELECT * REPLACE (round(car_age, 6) AS car_age) FROM features_cluster"),
    "features_log": over_vehicles(f"SELECT * REPLACE ({_LOGGED}) FROM features_cluster"),
    "features_early": over_vehicles(f"SELECT * EXCLUDE (id) REPLACE ({_LOGGED}) FROM feature_base"),
    "features_pop": over_vehicles(f"SELECT * REPLACE ({_POP}) FROM features_pop"),
}
