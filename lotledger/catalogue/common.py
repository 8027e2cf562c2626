"""Helpers for registering queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotledger.operators.relational import filter_model
from lotledger.plans import jobs, vehicle_tables
from lotledger.session import materialise


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison; sums in another order differ in the last bits."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned lazily: what a query does not use is neither parsed nor aggregated."""
    return jobs.clean_history(vehicle_tables.history_raw(spark, sf_dir))


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.build_vehicles(
        vehicle_tables.price(spark, sf_dir), history(spark, sf_dir), vehicle_tables.status(spark, sf_dir)
    )


def vehicles(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, model: str | None = None) -> DataFrame:
    """The joined table, stored once as group statistics read it again; only what is asked for."""
    rows = joined(spark, sf_dir)
    rows = rows if model is None else filter_model(rows, model)
    return materialise(rows.select(*columns) if columns else rows, "vehicles")


PAGES_PER_FILE = 10_000


def accident_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accident reports as a stored page table, the form in which extraction meets them."""
    return materialise(vehicle_tables.accident_pages(spark, sf_dir), "accident-pages", PAGES_PER_FILE)


def inspection_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(vehicle_tables.inspection_pages(spark, sf_dir), "inspection-pages", PAGES_PER_FILE)


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(vehicle_tables.listing_pages(spark, sf_dir), "listing-pages", PAGES_PER_FILE)
