"""Resumable collection and brand collection."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotledger.catalogue.base_sql import over_vehicles
from lotledger.catalogue.common import accident_pages, inspection_pages, listing_pages
from lotledger.catalogue.tables import brand_files
from lotledger.plans import jobs, vehicle_tables as vt
from lotledger.schemas import COLLECTED, ERROR_IDS, INSURANCE_NAMES
from lotledger.session import new_location
from lotledger.streaming.collect import collect_stream

TARGET_SHARE = 0.6
PRICE_ORDER = ("price",)  # ids have one price each here
#: Bytes of pages that are read by one task: they compress well and take long to work on.
ROW_GROUP = 4 << 20


def _stores(spark, sf_dir):
    """Ids stored earlier, and ids that failed earlier."""
    orders = vt.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").alias("id")
    return (
        orders.where(F.col("o_orderstatus") == "F").select(key),
        orders.where(F.col("o_orderpriority") == "1-URGENT").select(key),
    )


def _collected(spark, sf_dir, target=None):
    prices = vt.price(spark, sf_dir)
    stores = _stores(spark, sf_dir)
    pending = jobs.pending_ids(prices, *stores)
    reports = jobs.read_reports(inspection_pages(spark, sf_dir), accident_pages(spark, sf_dir), pending)
    return jobs.incremental_collect(pending, prices, stores[0], reports, PRICE_ORDER, target)


def incremental_collect(spark, sf_dir):
    return _collected(spark, sf_dir)[0]


def _outcomes(good, bad):
    return good.select("id", F.lit("ok").alias("outcome")).unionAll(bad.select("id", F.lit("error").alias("outcome")))


def incremental_outcomes(spark, sf_dir):
    return _outcomes(*_collected(spark, sf_dir))


def incremental_capped(spark, sf_dir):
    target = int(vt.price(spark, sf_dir).count() * TARGET_SHARE)
    return _outcomes(*_collected(spark, sf_dir, target))


def _streamed(spark, sf_dir):
    """Both reports of every listing arrive as files of a stream, run until it is used up."""
    root = new_location(spark, "stream")
    prices = vt.price(spark, sf_dir)
    pages = vt.report_pairs(spark, sf_dir, 16)
    pages.write.option("parquet.block.size", ROW_GROUP).parquet(f"{root}/pages")
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 8).parquet(f"{root}/pages")
    collect_stream(stream, prices, *_stores(spark, sf_dir), root, PRICE_ORDER).awaitTermination()
    return root


def incremental_stream(spark, sf_dir):
    stored = spark.read.schema(COLLECTED).parquet(f"{_streamed(spark, sf_dir)}/collected")
    return stored.select(*COLLECTED.fieldNames())


def incremental_stream_errors(spark, sf_dir):
    return spark.read.schema(ERROR_IDS).parquet(f"{_streamed(spark, sf_dir)}/failed").select("id")


def brand_collect(spark, sf_dir):
    orders = vt.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("page_id"), F.col("o_orderpriority").alias("brand"))
    listings = listing_pages(spark, sf_dir).join(orders, "page_id")
    return jobs.collect_by_brand(listings, accident_pages(spark, sf_dir), new_location(spark, "brands"))


def brand_merge(spark, sf_dir):
    """Brand tables under the merge headers, joined into one table under the current ones."""
    rows = brand_files(spark, sf_dir)
    to_merge = dict(zip(INSURANCE_NAMES["current"], INSURANCE_NAMES["merge"], strict=True))
    brands = [rows.where(F.col("brand") == b).withColumnsRenamed(to_merge) for b in ("LPG", "DIESEL", "GASOLINE")]
    return jobs.brand_merge(brands, "merge")


QUERIES = {
    "incremental_collect": incremental_collect,
    "incremental_outcomes": incremental_outcomes,
    "incremental_capped": incremental_capped,
    "incremental_stream": incremental_stream,
    "incremental_stream_errors": incremental_stream_errors,
    "brand_collect": brand_collect,
    "brand_merge": brand_merge,
}

_TODO = """
, todo AS (
  SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT'),
outcomes AS (
  SELECT id, id IN (SELECT id FROM status) AND id IN (SELECT id FROM history_raw) AS ok FROM todo)
"""
_COLLECTED = over_vehicles(f"""{_TODO}
  SELECT id, CAST(price AS VARCHAR) AS price, (id % 1000) || '나' || id AS car_number,
         '2020/' || lpad(CAST(id % 12 + 1 AS VARCHAR), 2, '0') || '/01' AS registration_date,
         s.transmission, CASE WHEN id % 2 = 0 THEN '가솔린' ELSE '디젤' END AS fuel_type, s.mileage,
         '양호' AS mileage_condition, '양호' AS chassis_number, s.tuning_history AS tuning, s.special_history,
         s.usage_change, '적합' AS emission_gas, CASE WHEN id % 17 = 0 THEN '대상' ELSE '해당없음' END AS recall,
         h.model AS car_name, substr(h.registration_date, 1, 4) AS year
  FROM outcomes JOIN price USING (id) JOIN status s USING (id) JOIN history_raw h USING (id) WHERE ok""")

ORACLES = {
    "incremental_collect": _COLLECTED,
    "incremental_stream": _COLLECTED,
    "incremental_outcomes": over_vehicles(
        f"{_TODO} SELECT id, CASE WHEN ok THEN 'ok' ELSE 'error' END AS outcome FROM outcomes"),
    "incremental_stream_errors": over_vehicles(f"{_TODO} SELECT id FROM outcomes WHERE NOT ok"),
    "incremental_capped": over_vehicles(f"""{_TODO},
        room AS (SELECT (SELECT CAST(floor(count(*) * 0.6) AS BIGINT) FROM orders)
                        - (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n),
        counted AS (SELECT id, ok, count(CASE WHEN ok THEN 1 END) OVER (ORDER BY id) AS stored FROM outcomes)
        SELECT id, CASE WHEN ok THEN 'ok' ELSE 'error' END AS outcome FROM counted, room
        WHERE (ok AND stored <= n) OR (NOT ok AND stored < n)"""),
    "brand_collect": over_vehicles("""
        , listed AS (
          SELECT DISTINCT o_orderpriority AS brand, unnest(CASE WHEN o_orderkey % 19 = 0
                 THEN [o_orderkey - o_orderkey % 5, o_orderkey + 1]
                 ELSE [o_orderkey, o_orderkey - o_orderkey % 5, o_orderkey + 1] END) AS id FROM orders)
        SELECT id, license, license_changed, owner_changed, total_loss,
               CASE WHEN id % 37 = 0 THEN '' ELSE flood END AS flood, theft, cm, co, brand
        FROM listed JOIN history_raw USING (id) WHERE id % 41 <> 0 AND id % 29 <> 4 AND id % 53 <> 7"""),
    "brand_merge": over_vehicles("""
        SELECT CAST(id AS VARCHAR) AS id, license, license_changed, owner_changed, total_loss, flood, theft, cm, co,
               CASE fuel WHEN 'LPG' THEN 'LPG' WHEN '디젤' THEN 'DIESEL' ELSE 'GASOLINE' END AS brand
        FROM history_raw"""),
}
