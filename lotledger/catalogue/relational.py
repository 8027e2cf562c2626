"""Renames, joins, set algebra and caps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lotledger.catalogue.base_sql import over_vehicles
from lotledger.catalogue.common import joined
from lotledger.operators import id_sets
from lotledger.operators import relational as rel
from lotledger.plans import vehicle_tables as vt
from lotledger.schemas import INSURANCE_NAMES, PRICE_MISSING_TEXT
from lotledger.session import materialise, new_location
from lotledger.sources import readers, writers

TARGET_SHARE = 0.8


def rename_all(spark, sf_dir):
    raw = vt.history_raw(spark, sf_dir).select(*INSURANCE_NAMES["current"])
    merge_style = rel.rename_all(raw, INSURANCE_NAMES["merge"])
    return rel.harmonise(merge_style, "merge", "current").withColumnRenamed("id", "listing_id")


def inner_join3(spark, sf_dir):
    return rel.join_vehicles(
        vt.price(spark, sf_dir), vt.history_raw(spark, sf_dir), vt.status(spark, sf_dir)
    ).select("id", "price", "license", "model", "cm", "mileage")


BUCKETS = 16


def inner_join3_bucketed(spark, sf_dir):
    """The three tables stored by id, so that their join needs no exchange."""

    def stored(df, label):
        name = f"vehicles_{label}_{uuid.uuid4().hex}"
        writers.save_bucketed(df, name, "id", BUCKETS, new_location(spark, f"bucketed-{label}"))
        return readers.read_catalog(spark, name)

    return rel.join_vehicles(
        stored(vt.price(spark, sf_dir).select("id", "price"), "price"),
        stored(vt.history_raw(spark, sf_dir).select("id", "license", "model", "cm"), "history"),
        stored(vt.status(spark, sf_dir).select("id", "mileage"), "status"),
    ).select("id", "price", "license", "model", "cm", "mileage")


def join_renamed_key(spark, sf_dir):
    """Line items to orders: the order key repeats on the left."""
    lines = vt.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = vt.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return rel.join_on(lines, orders, "l_orderkey", "o_orderkey")


def _document_ids(spark, sf_dir):
    return vt.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))


def _labelled(spark, sf_dir):
    return vt.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "toxic")


def _stored_sets(spark, sf_dir):
    """The listed ids, and the stored ones of two runs of which the second adds only its own."""
    labelled = _labelled(spark, sf_dir)
    first = labelled.where("toxic = 1")
    listed = materialise(id_sets.id_set(_document_ids(spark, sf_dir)), "listed-ids")
    done = materialise(id_sets.id_set(first), "stored-ids")
    new = id_sets.id_set(labelled.where("toxic IS DISTINCT FROM 1"))
    return listed, materialise(id_sets.merge_sets(done, new), "stored-ids")


def set_difference_stored(spark, sf_dir):
    return id_sets.ids_between(*_stored_sets(spark, sf_dir))


def progress_stored(spark, sf_dir):
    return id_sets.set_progress(*_stored_sets(spark, sf_dir))


def anti_join_stored(spark, sf_dir):
    """As ``anti_join2``, with the stored and the failed set as bitmaps."""
    lines, orders, key = _lines_and_orders(spark, sf_dir)
    done = id_sets.id_set(orders.where(F.col("o_orderstatus") == "F").select(key))
    failed = id_sets.id_set(orders.where(F.col("o_orderpriority") == "1-URGENT").select(key))
    return id_sets.rows_outside(lines, materialise(id_sets.merge_sets(done, failed), "excluded-ids"))


def _lines_and_orders(spark, sf_dir):
    lines = vt.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber")
    return lines, vt.table(spark, sf_dir, "orders"), F.col("o_orderkey").alias("id")


def set_difference(spark, sf_dir):
    return rel.remaining_ids(_document_ids(spark, sf_dir), _labelled(spark, sf_dir))


def anti_join2(spark, sf_dir):
    """Line items of orders neither in the stored nor in the failed set; duplicates stay."""
    lines, orders, key = _lines_and_orders(spark, sf_dir)
    done = orders.where(F.col("o_orderstatus") == "F").select(key)
    failed = orders.where(F.col("o_orderpriority") == "1-URGENT").select(key)
    return rel.exclude_ids(lines, done, failed)


def lookup_default(spark, sf_dir):
    """Price text of every line item's listing; only priced listings are in the lookup."""
    lines = vt.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber")
    priced = vt.price(spark, sf_dir).where(F.col("price") >= 200)
    return rel.lookup_default(lines, priced, "id", "price", PRICE_MISSING_TEXT, ["price"])


def union_by_name(spark, sf_dir):
    orders = vt.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    lines = vt.table(spark, sf_dir, "lineitem").select("l_quantity", F.col("l_orderkey").alias("id"))
    return rel.concat_tables([orders, lines])


def cap_rows(spark, sf_dir):
    lines = vt.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rel.cap_rows(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


def cap_to_target(spark, sf_dir):
    """Listings still missing from a store that should hold four fifths of all."""
    ids = vt.price(spark, sf_dir)
    history = vt.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    done = history.select(F.col("o_orderkey").alias("id"))
    new = rel.exclude_ids(ids, done)
    return rel.cap_to_target(new, done, int(ids.count() * TARGET_SHARE), ["id"])


def filter_min(spark, sf_dir):
    return rel.filter_min(vt.price(spark, sf_dir), "price", 200)


def filter_eq(spark, sf_dir):
    return rel.filter_model(vt.history_raw(spark, sf_dir), "3-MEDIUM").select("id", "model", "cc")


def drop_cols(spark, sf_dir):
    return rel.drop_cols(vt.status(spark, sf_dir), ["warranty", "mileage", "no_such_column"])


def project_alias(spark, sf_dir):
    return rel.project_label(vt.price(spark, sf_dir), ["id"])


def columns_except(spark, sf_dir):
    rows = vt.status(spark, sf_dir)
    return rows.select(*rel.columns_except(rows, ["warranty", "transmission"]))


def preview(spark, sf_dir):
    return rel.preview(vt.history_raw(spark, sf_dir), 5, ["id"])


def progress_counts(spark, sf_dir):
    return rel.progress_counts(_document_ids(spark, sf_dir), _labelled(spark, sf_dir))


QUERIES = {
    "rename_all": rename_all,
    "inner_join3": inner_join3,
    "inner_join3_bucketed": inner_join3_bucketed,
    "build_vehicles": joined,
    "join_renamed_key": join_renamed_key,
    "set_difference": set_difference,
    "set_difference_stored": set_difference_stored,
    "progress_stored": progress_stored,
    "anti_join_stored": anti_join_stored,
    "anti_join2": anti_join2,
    "lookup_default": lookup_default,
    "union_by_name": union_by_name,
    "cap_rows": cap_rows,
    "cap_to_target": cap_to_target,
    "filter_min": filter_min,
    "filter_eq": filter_eq,
    "drop_cols": drop_cols,
    "project_alias": project_alias,
    "columns_except": columns_except,
    "preview": preview,
    "progress_counts": progress_counts,
}

ORACLES = {
    "rename_all": over_vehicles("""
        SELECT id AS listing_id, license, license_changed, owner_changed, total_loss, flood, theft, cm, co
        FROM history_raw"""),
    "inner_join3": over_vehicles("""
        SELECT id, price, license, model, cm, mileage
        FROM price JOIN history_raw USING (id) JOIN status USING (id)"""),
    "build_vehicles": over_vehicles("SELECT * FROM vehicles"),
    "preview": over_vehicles("SELECT * FROM history_raw ORDER BY id LIMIT 5"),
    "join_renamed_key": """
        SELECT l_orderkey, l_linenumber, l_quantity, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "set_difference": "SELECT doc_id AS id FROM documents EXCEPT SELECT doc_id FROM labels",
    "anti_join2": """
        SELECT l_orderkey AS id, l_linenumber FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
          AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "lookup_default": over_vehicles("""
        SELECT l_orderkey AS id, l_linenumber, COALESCE(CAST(price AS VARCHAR), '가격 없음') AS price
        FROM lineitem LEFT JOIN (SELECT * FROM price WHERE price >= 200) p ON l_orderkey = p.id"""),
    "union_by_name": """
        SELECT o_orderkey AS id, o_totalprice, CAST(NULL AS DOUBLE) AS l_quantity FROM orders
        UNION ALL SELECT l_orderkey, NULL, l_quantity FROM lineitem""",
    "cap_rows": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 25601""",
    "cap_to_target": over_vehicles("""
        , done AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'),
        ranked AS (SELECT id, price, row_number() OVER (ORDER BY id) AS rn FROM price
                   WHERE id NOT IN (SELECT id FROM done))
        SELECT id, price FROM ranked
        WHERE rn <= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM price) - (SELECT count(DISTINCT id) FROM done)"""),
    "filter_min": over_vehicles("SELECT id, price FROM price WHERE price >= 200"),
    "filter_eq": over_vehicles("SELECT id, model, cc FROM history_raw WHERE model = '3-MEDIUM'"),
    "drop_cols": over_vehicles("SELECT * EXCLUDE (warranty, mileage) FROM status"),
    "project_alias": over_vehicles("SELECT id, price AS label FROM price"),
    "columns_except": over_vehicles("SELECT * EXCLUDE (warranty, transmission) FROM status"),
    "progress_counts": """
        SELECT count(DISTINCT d.doc_id) AS total, (SELECT count(DISTINCT doc_id) FROM labels) AS done,
               count(DISTINCT CASE WHEN l.doc_id IS NULL THEN d.doc_id END) AS remaining
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
}
ORACLES |= {
    "inner_join3_bucketed": ORACLES["inner_join3"],
    "set_difference_stored": ORACLES["set_difference"],
    "progress_stored": ORACLES["progress_counts"],
    "anti_join_stored": ORACLES["anti_join2"],
}
