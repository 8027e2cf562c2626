"""Sources and sinks: written in the shared folder, read back whole."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lotledger import schemas
from lotledger.catalogue.base_sql import over_vehicles
from lotledger.catalogue.common import history
from lotledger.operators.relational import harmonise
from lotledger.plans import vehicle_tables as vt
from lotledger.session import new_location
from lotledger.sources import readers, writers


def csv_scan(spark, sf_dir):
    path = new_location(spark, "status-csv")
    writers.write_csv(vt.status(spark, sf_dir), path)
    return readers.read_table(spark, path, schemas.VEHICLES_STATUS)


def scan_ids(spark, sf_dir):
    return readers.read_ids(vt.price(spark, sf_dir))


def catalog_scan(spark, sf_dir):
    vt.price(spark, sf_dir).createOrReplaceTempView("vehicles_price")
    return readers.read_catalog(spark, "vehicles_price")


def _brand_tables(spark, sf_dir):
    """Insurance columns under the report headers, with the fuel as the brand."""
    current = schemas.INSURANCE_NAMES["current"]
    raw = vt.history_raw(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    brand = F.when(F.col("fuel") == "LPG", "LPG").when(F.col("fuel") == "디젤", "DIESEL").otherwise("GASOLINE")
    return raw.select(*current, brand.alias("brand")).withColumnsRenamed(
        dict(zip(current, schemas.INSURANCE_NAMES["report"], strict=True))
    )


def brand_files(spark, sf_dir):
    root = new_location(spark, "brand-csv")
    rows = _brand_tables(spark, sf_dir)
    # The brand is part of the file path here, as it is part of the file name elsewhere.
    rows.withColumn("file_brand", F.col("brand")).drop("brand").hint("rebalance", "file_brand").write.option(
        "header", True
    ).partitionBy("file_brand").csv(root)
    brands = sorted(r[0] for r in rows.select("brand").distinct().collect())
    paths = [f"{root}/file_brand={b}" for b in brands]
    schema = schemas.insurance_schema("report")
    return harmonise(readers.read_brand_files(spark, paths, schema, "file_brand=([^/]+)/"), "report")


def missing_source(spark, sf_dir):
    """A table that was never written, beside one that was."""
    path = new_location(spark, "ids")
    nothing = readers.read_or_empty(spark, path, schemas.ERROR_IDS, "parquet")
    writers.append_batch(vt.price(spark, sf_dir).select("id"), path)
    written = readers.read_or_empty(spark, path, schemas.ERROR_IDS, "parquet")
    return nothing.withColumn("source", F.lit("missing")).unionAll(written.withColumn("source", F.lit("written")))


def page_scan(spark, sf_dir):
    return readers.read_pages(spark, f"{sf_dir}/pages.parquet")


def sink_table_roundtrip(spark, sf_dir):
    name = f"vehicles_history_{uuid.uuid4().hex}"
    writers.save_table(history(spark, sf_dir), name, path=new_location(spark, "history-table"))
    return readers.read_catalog(spark, name)


def sink_csv_roundtrip(spark, sf_dir):
    path = new_location(spark, "history-csv")
    writers.write_csv(history(spark, sf_dir), path)
    return readers.read_table(spark, path, schemas.VEHICLES_HISTORY)


def append_batches(spark, sf_dir):
    path = new_location(spark, "appended")
    rows = vt.price(spark, sf_dir)
    writers.append_batch(rows.where(F.col("price") < schemas.MIN_PRICE), path)
    writers.append_batch(rows.where(F.col("price") >= schemas.MIN_PRICE), path)
    return spark.read.schema(schemas.VEHICLES_PRICE).parquet(path)


def dead_letter_split(spark, sf_dir):
    raw = vt.history_raw(spark, sf_dir).select("id", "cm", (F.col("cm") != schemas.UNDETERMINED_TEXT).alias("is_ok"))
    good, bad = writers.split_ok_error(raw)
    path = new_location(spark, "failed")
    writers.append_errors(bad, path)
    writers.append_errors(bad, path)
    failed = readers.read_or_empty(spark, path, schemas.ERROR_IDS, "parquet")
    return good.select("id", F.lit("ok").alias("outcome")).unionAll(failed.select("id", F.lit("error").alias("outcome")))


def write_by_brand(spark, sf_dir):
    path = new_location(spark, "by-brand")
    brand = F.col("o_orderpriority").alias("brand")
    rows = vt.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", brand)
    writers.write_by_brand(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


def rewrite_in_place(spark, sf_dir):
    path = new_location(spark, "rewritten")
    writers.append_batch(vt.price(spark, sf_dir), path)
    stored = spark.read.schema(schemas.VEHICLES_PRICE).parquet(path)
    writers.rewrite_table(spark, stored.where(F.col("price") >= schemas.MIN_PRICE), path)
    return spark.read.schema(schemas.VEHICLES_PRICE).parquet(path)


QUERIES = {
    "csv_scan": csv_scan,
    "scan_ids": scan_ids,
    "catalog_scan": catalog_scan,
    "brand_files": brand_files,
    "missing_source": missing_source,
    "page_scan": page_scan,
    "sink_table_roundtrip": sink_table_roundtrip,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "append_batches": append_batches,
    "dead_letter_split": dead_letter_split,
    "write_by_brand": write_by_brand,
    "rewrite_in_place": rewrite_in_place,
}

ORACLES = {
    "csv_scan": over_vehicles("SELECT * FROM status"),
    "scan_ids": "SELECT o_orderkey AS id FROM orders",
    "catalog_scan": over_vehicles("SELECT id, price FROM price"),
    "brand_files": over_vehicles("""
        SELECT CAST(id AS VARCHAR) AS id, license, license_changed, owner_changed, total_loss, flood, theft, cm, co,
               CASE fuel WHEN 'LPG' THEN 'LPG' WHEN '디젤' THEN 'DIESEL' ELSE 'GASOLINE' END AS brand
        FROM history_raw"""),
    "missing_source": "SELECT o_orderkey AS id, 'written' AS source FROM orders",
    "page_scan": "SELECT page_id, url, html FROM pages",
    "sink_table_roundtrip": over_vehicles("SELECT * FROM history"),
    "sink_csv_roundtrip": over_vehicles("SELECT * FROM history"),
    "append_batches": over_vehicles("SELECT id, price FROM price"),
    "dead_letter_split": over_vehicles("""
        SELECT id, CASE WHEN cm = '미확정' THEN 'error' ELSE 'ok' END AS outcome FROM history_raw"""),
    "write_by_brand": "SELECT o_orderkey, o_totalprice, o_orderpriority AS brand FROM orders",
    "rewrite_in_place": over_vehicles("SELECT id, price FROM price WHERE price >= 200"),
}
