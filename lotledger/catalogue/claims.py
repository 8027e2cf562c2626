"""Claim texts to numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotledger.catalogue.base_sql import CLAIMS_SQL, NUMBERS_SQL, over_vehicles
from lotledger.catalogue.common import history
from lotledger.functions.claims import claims_text, extract_number, parse_claims
from lotledger.functions.text import none_to_null, split_pair, strip_commas
from lotledger.operators.impute import impute_mean
from lotledger.plans import vehicle_tables as vt
from lotledger.schemas import NUMBER_COLUMNS


def numbers(spark, sf_dir):
    return vt.history_raw(spark, sf_dir).select("id", *[extract_number(F.col(c)).alias(c) for c in NUMBER_COLUMNS])


def parsed_claims(spark, sf_dir):
    own, other = parse_claims(F.col("cm")), parse_claims(F.col("co"))
    return vt.history_raw(spark, sf_dir).select(
        "id",
        own["count"].alias("damaged_count"), own["total"].alias("damaged_total"),
        other["count"].alias("damaged_by_other_count"), other["total"].alias("damaged_by_other_total"),
    )


def split_claims(spark, sf_dir):
    texts = vt.history_raw(spark, sf_dir).select("id", claims_text(F.col("cm")).alias("pair"))
    return texts.select("id", *split_pair(F.col("pair"), "first_part", "second_part"))


def none_parts(spark, sf_dir):
    parts = split_claims(spark, sf_dir)
    return parts.withColumns({c: none_to_null(F.col(c)) for c in ("first_part", "second_part")})


def imputed(spark, sf_dir):
    return impute_mean(parsed_claims(spark, sf_dir), ["damaged_total", "damaged_by_other_total"])


def without_commas(spark, sf_dir):
    return vt.history_raw(spark, sf_dir).select("id", strip_commas(F.col("cm")).alias("cm"))


QUERIES = {
    "extract_number": numbers,
    "parse_claims": parsed_claims,
    "split_pair": split_claims,
    "none_to_null": none_parts,
    "impute_mean": imputed,
    "strip_commas": without_commas,
    "history_clean": history,
}

_PARTS = """
  SELECT id, {a} AS first_part, {b} AS second_part FROM claims"""

ORACLES = {
    "extract_number": over_vehicles(f"SELECT id, {NUMBERS_SQL} FROM history_raw"),
    "parse_claims": over_vehicles(f"SELECT id, {CLAIMS_SQL} FROM history_raw"),
    "split_pair": over_vehicles(_PARTS.format(
        a="COALESCE(CAST(damaged_count AS VARCHAR), 'None')", b="COALESCE(CAST(damaged_total AS VARCHAR), 'None')")),
    "none_to_null": over_vehicles(_PARTS.format(
        a="CAST(damaged_count AS VARCHAR)", b="CAST(damaged_total AS VARCHAR)")),
    "impute_mean": over_vehicles(
        "SELECT id, damaged_count, damaged_total, damaged_by_other_count, damaged_by_other_total FROM history"),
    "strip_commas": over_vehicles("SELECT id, replace(cm, ',', '') AS cm FROM history_raw"),
    "history_clean": over_vehicles("SELECT * FROM history"),
}
