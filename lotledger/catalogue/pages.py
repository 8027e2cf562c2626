"""Page extraction over the raw pages and over report pages made from the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotledger.catalogue.base_sql import over_vehicles
from lotledger.catalogue.common import accident_pages, inspection_pages, listing_pages
from lotledger.functions.text import default_text, first_token, join_text, nth_token
from lotledger.operators import extract
from lotledger.operators.relational import dedupe_last
from lotledger.plans import vehicle_tables as vt

LINK = '<a href="([^"]*)"'
PAGE_FIELDS = {
    "title": [extract.Step("<title>([^<]*)</title>", 1)],
    "second_link": [extract.Step("(?s)<nav>(.*?)</nav>", 1), extract.Step(LINK, 2)],
    "footer": [extract.Step("<footer>([^<]*)</footer>", 1)],
}
HISTORY_FIELDS = ["license", "license_changed", "owner_changed", "total_loss", "flood", "theft", "cm", "co"]


def _pages(spark, sf_dir):
    return vt.table(spark, sf_dir, "pages")


def page_nodes(spark, sf_dir):
    return extract.explode_nodes(_pages(spark, sf_dir), LINK, ["page_id"], group=1)


def join_links(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", join_text(F.col("html"), LINK).alias("links"))


def page_fields(spark, sf_dir):
    return extract.extract_fields(_pages(spark, sf_dir), PAGE_FIELDS, ["page_id"])


def url_tokens(spark, sf_dir):
    url = F.col("url")
    return _pages(spark, sf_dir).select(
        "page_id",
        nth_token(url, "/", 3).alias("host"), nth_token(url, "/", -1).alias("last_part"),
        first_token(url, ":").alias("scheme"),
    )


def _listing_nodes(spark, sf_dir):
    return extract.listing_nodes(listing_pages(spark, sf_dir), ["page_id"])


def reserved_filter(spark, sf_dir):
    return extract.drop_reserved(_listing_nodes(spark, sf_dir)).select("page_id", "position", "attribute")


def _listed_prices(spark, sf_dir):
    return extract.parse_listing(extract.drop_reserved(_listing_nodes(spark, sf_dir)))


def listing_attr(spark, sf_dir):
    return _listed_prices(spark, sf_dir).select("page_id", "position", "id", "price")


def latest_prices(spark, sf_dir):
    listed = _listed_prices(spark, sf_dir).select("id", "price", "page_id", "position")
    return dedupe_last(listed, "id", ["page_id", "position"])


def first_tokens(spark, sf_dir):
    token = first_token(F.col("attribute"), "|").alias("token")
    return _listing_nodes(spark, sf_dir).select("page_id", "position", token)


def distinct_ids(spark, sf_dir):
    return extract.listing_ids(_listing_nodes(spark, sf_dir))


def drop_empty_pages(spark, sf_dir):
    return extract.drop_empty_pages(listing_pages(spark, sf_dir)).select("page_id")


def accident_fields(spark, sf_dir):
    return extract.extract_fields(accident_pages(spark, sf_dir), extract.ACCIDENT_FIELDS, ["id"])


def inspection_fields(spark, sf_dir):
    return extract.extract_fields(inspection_pages(spark, sf_dir), extract.INSPECTION_FIELDS, ["id"])


def labelled_fields(spark, sf_dir):
    cells = {
        "maker": "제작사", "name": "자동차명", "year": "연식", "fuel": "사용연료", "cc": "배기량",
        "body": "차체형상", "use_class": "용도 및 차종", "registration_date": "최초 보험 가입일자",
        "rental": "영업용(대여) 사용이력",
    }
    items = {"usage_change": "용도 변경이력", "first_change": "번호 / 소유자 변경이력", "first_special": "특수 사고이력"}
    return extract.extract_labelled(accident_pages(spark, sf_dir), cells, items, ["id"])


def _history_fields(spark, sf_dir):
    fields = {name: extract.ACCIDENT_FIELDS[name] for name in HISTORY_FIELDS}
    return extract.extract_fields(accident_pages(spark, sf_dir), fields, ["id"])


def default_texts(spark, sf_dir):
    return _history_fields(spark, sf_dir).select("id", *[default_text(F.col(c)).alias(c) for c in HISTORY_FIELDS])


def require_all(spark, sf_dir):
    return extract.require_all(_history_fields(spark, sf_dir), HISTORY_FIELDS)


def require_all_filled(spark, sf_dir):
    return extract.require_all(_history_fields(spark, sf_dir), HISTORY_FIELDS, blank_is_missing=True)


def default_after_failure(spark, sf_dir):
    return extract.default_after_failure(_history_fields(spark, sf_dir), HISTORY_FIELDS)


QUERIES = {
    "page_nodes": page_nodes,
    "join_text": join_links,
    "page_fields": page_fields,
    "nth_token": url_tokens,
    "reserved_filter": reserved_filter,
    "listing_attr": listing_attr,
    "dedupe_last": latest_prices,
    "first_token": first_tokens,
    "distinct_ids": distinct_ids,
    "drop_empty_pages": drop_empty_pages,
    "extract_fields": accident_fields,
    "extract_inspection": inspection_fields,
    "extract_labelled": labelled_fields,
    "default_text": default_texts,
    "require_all": require_all,
    "require_all_filled": require_all_filled,
    "default_after_failure": default_after_failure,
}

# The report queries are checked against the columns the pages were made from, not by
# matching the page text a second time.
_NODES = """
, nodes AS (
  SELECT id AS page_id, 0 AS position, FALSE AS held,
         CASE WHEN id % 19 = 0 THEN '' WHEN id % 23 = 0 THEN CAST(id AS VARCHAR)
              ELSE id || '|' || price || '|1' END AS attribute,
         CAST(id AS VARCHAR) AS node_id, CAST(price AS VARCHAR) AS node_price FROM price
  UNION ALL
  SELECT id, 1, FALSE, (id - id % 5) || '|' || (price + id % 5) || '|2', CAST(id - id % 5 AS VARCHAR),
         CAST(price + id % 5 AS VARCHAR) FROM price
  UNION ALL
  SELECT id, 2, TRUE, (id + 1) || '|' || price || '|3', CAST(id + 1 AS VARCHAR), CAST(price AS VARCHAR) FROM price)
"""
_REPORT = """
, report AS (
  SELECT h.* REPLACE (CASE WHEN id % 41 = 0 THEN NULL ELSE license END AS license,
                      CASE WHEN id % 53 = 7 THEN NULL ELSE total_loss END AS total_loss,
                      CASE WHEN id % 53 = 7 THEN NULL WHEN id % 37 = 0 THEN '' ELSE flood END AS flood,
                      CASE WHEN id % 53 = 7 THEN NULL ELSE theft END AS theft,
                      CASE WHEN id % 29 = 4 THEN NULL ELSE cm END AS cm,
                      CASE WHEN id % 29 = 4 THEN NULL ELSE co END AS co)
  FROM history_raw h)
"""
_FIELDS = ", ".join(HISTORY_FIELDS)
_DEFAULTED = ", ".join(f"COALESCE(nullif({c}, ''), 'N/A') AS {c}" for c in HISTORY_FIELDS)
_STOPPED = ", ".join(
    f"CASE WHEN {' OR '.join(f'{before} IS NULL' for before in HISTORY_FIELDS[:i + 1])} THEN 'N/A' ELSE COALESCE(nullif({c}, ''), 'N/A') END AS {c}"
    for i, c in enumerate(HISTORY_FIELDS))

ORACLES = {
    "page_nodes": """
        SELECT page_id, CAST(unnest(range(len(links))) AS INTEGER) AS position, unnest(links) AS node
        FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages)""",
    "join_text": """
        SELECT page_id, array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ',') AS links FROM pages""",
    "page_fields": """
        SELECT page_id, trim(regexp_extract_all(html, '<title>([^<]*)</title>', 1)[1], ' ') AS title,
               trim(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="([^"]*)"', 1)[2], ' ') AS second_link,
               trim(regexp_extract_all(html, '<footer>([^<]*)</footer>', 1)[1], ' ') AS footer FROM pages""",
    "nth_token": """
        SELECT page_id, string_split(url, '/')[3] AS host, string_split(url, '/')[-1] AS last_part,
               string_split(url, ':')[1] AS scheme FROM pages""",
    "reserved_filter": over_vehicles(f"{_NODES} SELECT page_id, position, attribute FROM nodes WHERE NOT held"),
    "listing_attr": over_vehicles(f"""{_NODES}
        SELECT page_id, position, node_id AS id, node_price AS price FROM nodes
        WHERE NOT held AND contains(attribute, '|')"""),
    "dedupe_last": over_vehicles(f"""{_NODES}
        SELECT id, price, page_id, position FROM (
          SELECT node_id AS id, node_price AS price, page_id, position,
                 row_number() OVER (PARTITION BY node_id ORDER BY page_id DESC, position DESC) AS rn
          FROM nodes WHERE NOT held AND contains(attribute, '|')) WHERE rn = 1"""),
    "first_token": over_vehicles(f"""{_NODES}
        SELECT page_id, position, string_split(attribute, '|')[1] AS token FROM nodes"""),
    "distinct_ids": over_vehicles(f"{_NODES} SELECT DISTINCT node_id AS id FROM nodes WHERE attribute <> ''"),
    "drop_empty_pages": "SELECT o_orderkey AS page_id FROM orders WHERE o_orderkey % 31 <> 0",
    "extract_fields": over_vehicles(f"""{_REPORT}
        SELECT id, license, model, fuel, cc, registration_date, license_changed, owner_changed, total_loss, flood,
               theft, cm, co FROM report"""),
    "extract_inspection": over_vehicles("SELECT * FROM status"),
    "extract_labelled": over_vehicles("""
        SELECT id, '제작' || (id % 6) AS maker, model AS name, substr(registration_date, 1, 4) AS year, fuel, cc,
               '세단' AS body, '자가용' AS use_class, registration_date, CAST(NULL AS VARCHAR) AS rental,
               CASE WHEN id % 12 = 3 THEN '있음' ELSE '없음' END AS usage_change,
               license_changed AS first_change, CASE WHEN id % 53 = 7 THEN NULL ELSE total_loss END AS first_special
        FROM history_raw"""),
    "default_text": over_vehicles(f"{_REPORT} SELECT id, {_DEFAULTED} FROM report"),
    "require_all": over_vehicles(
        f"{_REPORT} SELECT id, {_FIELDS} FROM report WHERE license IS NOT NULL AND total_loss IS NOT NULL AND cm IS NOT NULL"),
    "require_all_filled": over_vehicles(
        f"{_REPORT} SELECT id, {_FIELDS} FROM report WHERE license IS NOT NULL AND total_loss IS NOT NULL AND cm IS NOT NULL AND flood <> ''"),
    "default_after_failure": over_vehicles(f"{_REPORT} SELECT id, {_STOPPED} FROM report"),
}
