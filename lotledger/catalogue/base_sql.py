"""The vehicle tables as SQL common table expressions, shared by the check queries."""

AS_OF = "2024-12-01"

_CLAIM = r"""
  CASE WHEN {c} = '없음' THEN 0
       WHEN contains({c}, '미확정') THEN TRY_CAST(regexp_extract({c}, '([0-9]+)회', 1) AS INTEGER)
       ELSE TRY_CAST(regexp_extract(replace({c}, ',', ''), '([0-9]+)회[^0-9]*([0-9]+)', 1) AS INTEGER) END AS {n},
  CASE WHEN {c} = '없음' THEN CAST(0 AS BIGINT)
       WHEN contains({c}, '미확정') THEN NULL
       ELSE TRY_CAST(regexp_extract(replace({c}, ',', ''), '([0-9]+)회[^0-9]*([0-9]+)', 2) AS BIGINT) END AS {t}"""

CLAIMS_SQL = ",".join([
    _CLAIM.format(c="cm", n="damaged_count", t="damaged_total"),
    _CLAIM.format(c="co", n="damaged_by_other_count", t="damaged_by_other_total"),
])

NUMBERS_SQL = ",\n".join(
    f"  COALESCE(TRY_CAST(regexp_extract({c}, '([0-9]+)', 1) AS INTEGER), 0) AS {c}"
    for c in ("license_changed", "owner_changed", "total_loss", "flood", "theft")
)

_TABLES = f"""
lines AS (
  SELECT l_orderkey AS id, count(*) AS n, count(DISTINCT l_suppkey) AS ns, min(l_linenumber) AS minl,
         max(l_linenumber) AS maxl, CAST(10000 * sum(l_quantity) AS BIGINT) AS amt
  FROM lineitem GROUP BY l_orderkey),
price AS (
  SELECT o_orderkey AS id, CAST(floor(power(o_totalprice / 100000, 6)) AS INTEGER) AS price FROM orders),
history_raw AS (
  SELECT o_orderkey AS id, o_custkey || '가' || o_orderkey AS license, o_orderpriority AS model,
         CASE o_orderstatus WHEN 'F' THEN '가솔린' WHEN 'O' THEN '디젤' ELSE 'LPG' END AS fuel,
         (1000 + 100 * n) || 'cc' AS cc, strftime(o_orderdate, '%Y/%m/%d') AS registration_date,
         (o_orderkey % 3) || '회' AS license_changed, ns || '회' AS owner_changed,
         '전손 ' || (CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END) || '회' AS total_loss,
         '침수(전손,분손) ' || (CASE WHEN o_orderkey % 70 = 0 THEN 1 ELSE 0 END) || '회' AS flood,
         '도난 0회' AS theft,
         CASE WHEN n = 1 THEN '없음'
              WHEN minl > 1 AND o_orderkey % 40 = 7 THEN '미확정'
              WHEN minl > 1 THEN n || '회미확정'
              ELSE n || '회' || format('{{:,}}', amt) || '원' END AS cm,
         CASE WHEN n < 3 THEN '없음'
              WHEN maxl = 7 AND o_orderkey % 3 = 0 THEN n || '회/미확정'
              ELSE ns || '회/' || format('{{:,}}', amt // 10) || '원' END AS co
  FROM orders JOIN lines ON o_orderkey = lines.id),
claims AS (
  SELECT id, license, model, fuel, cc, registration_date,
{NUMBERS_SQL},
{CLAIMS_SQL}
  FROM history_raw),
fills AS (
  SELECT CAST(round_even(avg(damaged_total), 0) AS BIGINT) AS own_fill,
         CAST(round_even(avg(damaged_by_other_total), 0) AS BIGINT) AS other_fill FROM claims),
history AS (
  SELECT claims.* REPLACE (COALESCE(damaged_total, own_fill) AS damaged_total,
                           COALESCE(damaged_by_other_total, other_fill) AS damaged_by_other_total)
  FROM claims, fills),
status AS (
  SELECT o_orderkey AS id, CASE o_orderkey % 9 WHEN 0 THEN '수동' WHEN 1 THEN '-' ELSE '오토' END AS transmission,
         '보험사보증' AS warranty,
         CASE WHEN o_orderkey % 97 = 0 THEN '-'
              ELSE format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)) || 'km' END AS mileage,
         CASE WHEN o_orderkey % 10 = 3 THEN '있음' ELSE '없음' END AS tuning_history,
         CASE WHEN o_orderkey % 11 = 3 THEN '있음' ELSE '없음' END AS special_history,
         CASE WHEN o_orderkey % 12 = 3 THEN '있음 / 렌트' ELSE '없음' END AS usage_change,
         CASE WHEN o_orderkey % 13 = 3 THEN '있음' ELSE '없음' END AS accident,
         CASE WHEN o_orderkey % 5 = 3 THEN '있음' WHEN o_orderkey % 101 = 0 THEN NULL ELSE '없음' END AS little_accident
  FROM orders WHERE dayofweek(o_orderdate) <> 6),
vehicles AS (SELECT * FROM price JOIN history USING (id) JOIN status USING (id)),
spread AS (
  SELECT *, avg(price) OVER m AS mean_price, stddev_samp(price) OVER m AS sd, stddev_pop(price) OVER m AS sd_pop
  FROM vehicles WINDOW m AS (PARTITION BY model)),
kept_sample AS (
  SELECT * EXCLUDE (mean_price, sd, sd_pop) FROM spread WHERE abs((price - mean_price) / nullif(sd, 0)) < 3),
kept_pop AS (
  SELECT * EXCLUDE (mean_price, sd, sd_pop) FROM spread WHERE abs((price - mean_price) / nullif(sd_pop, 0)) < 3),
kept_twice AS (
  SELECT * EXCLUDE (m, s) FROM (
    SELECT *, avg(price) OVER (PARTITION BY model) AS m, stddev_pop(price) OVER (PARTITION BY model) AS s FROM kept_pop)
  WHERE abs((price - m) / nullif(s, 0)) < 3),
feature_base AS (
  SELECT id, price, model, fuel, TRY_CAST(replace(cc, 'cc', '') AS INTEGER) AS cc, owner_changed, total_loss, flood,
         damaged_count + damaged_by_other_count AS damaged_count, damaged_by_other_count,
         damaged_total + damaged_by_other_total AS damaged_total,
         TRY_CAST(replace(regexp_extract(mileage, '([0-9][0-9,]*)', 1), ',', '') AS INTEGER) AS mileage,
         CASE WHEN tuning_history = '없음' THEN 0 ELSE 1 END AS tuning_history,
         CASE WHEN special_history = '없음' THEN 0 ELSE 1 END AS special_history,
         CASE WHEN usage_change = '없음' THEN 0 ELSE 1 END AS usage_change,
         CASE WHEN accident = '없음' THEN 0 ELSE 1 END AS accident,
         CASE WHEN little_accident = '없음' THEN 0 ELSE 1 END AS little_accident,
         CASE WHEN transmission = '수동' THEN 1 ELSE 0 END AS manual_transmission,
         date_diff('day', CAST(strptime(registration_date, '%Y/%m/%d') AS DATE), DATE '{AS_OF}') / 365.25 AS car_age
  FROM kept_sample),
features_cluster AS (SELECT * EXCLUDE (id, flood) FROM feature_base WHERE price >= 200),
features_pop AS (
  SELECT price, model, fuel, cc, ln(1 + owner_changed) AS owner_changed,
         CASE WHEN total_loss = 0 THEN 0 ELSE 1 END AS total_loss, CASE WHEN flood = 0 THEN 0 ELSE 1 END AS flood,
         ln(1 + damaged_count + damaged_by_other_count) AS damaged_count,
         ln(1 + damaged_total + damaged_by_other_total) AS damaged_total,
         ln(1 + TRY_CAST(regexp_replace(mileage, '[^0-9]', '', 'g') AS INTEGER)) AS mileage,
         CASE WHEN tuning_history = '없음' THEN 0 ELSE 1 END AS tuning_history,
         CASE WHEN special_history = '없음' THEN 0 ELSE 1 END AS special_history,
         CASE WHEN usage_change = '없음' THEN 0 ELSE 1 END AS usage_change,
         CASE WHEN accident = '없음' THEN 0 ELSE 1 END AS accident,
         CASE WHEN little_accident = '없음' THEN 0 ELSE 1 END AS little_accident,
         CASE WHEN transmission = '수동' THEN 1 ELSE 0 END AS manual_transmission,
         ln(1 + date_diff('day', CAST(strptime(registration_date, '%Y/%m/%d') AS DATE), DATE '{AS_OF}') / 365.25) AS car_age
  FROM kept_pop)"""


def over_vehicles(body: str) -> str:
    """``body`` with the vehicle tables in scope."""
    return f"WITH {_TABLES}\n{body}"
