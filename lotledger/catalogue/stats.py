"""Group statistics, z-scores and outlier filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotledger.catalogue.base_sql import over_vehicles
from lotledger.catalogue.common import rounded, vehicles
from lotledger.operators import group_stats as gs
from lotledger.operators import moments
from lotledger.plans import jobs, vehicle_tables as vt
from lotledger.session import materialise


def _events(spark, sf_dir):
    return vt.table(spark, sf_dir, "events").select("event_id", "event_type", "value")


def _lines(spark, sf_dir):
    return vt.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")


def window_mean(spark, sf_dir):
    return rounded(gs.with_group_mean(_events(spark, sf_dir), "event_type", "value", "mean_value"))


def window_stddev(spark, sf_dir):
    return rounded(gs.with_group_stddev(_lines(spark, sf_dir), "l_orderkey", "l_extendedprice", name="sd"), 4)


def zscore(spark, sf_dir):
    return rounded(gs.with_zscore(_events(spark, sf_dir), "event_type", "value"))


def outliers_sample(spark, sf_dir):
    return gs.drop_outliers(_events(spark, sf_dir), "event_type", "value", ddof=1)


def outliers_pop(spark, sf_dir):
    return gs.drop_outliers(_lines(spark, sf_dir), "l_orderkey", "l_extendedprice", ddof=0)


def outliers_two_pass(spark, sf_dir):
    return gs.drop_outliers(_events(spark, sf_dir), "event_type", "value", ddof=0, passes=2)


def mean_by_group(spark, sf_dir):
    raw = vt.price(spark, sf_dir).join(vt.history_raw(spark, sf_dir).select("id", "model"), "id")
    return rounded(gs.mean_by(raw, "model", "price"))


def mean_price_by_model(spark, sf_dir):
    return rounded(jobs.mean_price_by_model(vehicles(spark, sf_dir, ["model", "price"])))


APPENDED_FROM = "2024-01-16"


def _appended_state(spark, sf_dir):
    """The state of the earlier events, stored, and merged with that of the later ones."""
    events = vt.table(spark, sf_dir, "events").select("ts", "event_type", "value")
    later = F.coalesce(F.col("ts") >= F.lit(APPENDED_FROM).cast("timestamp"), F.lit(True))
    before = materialise(moments.group_moments(events.where(~later), "event_type", "value"), "moments")
    new = moments.group_moments(events.where(later), "event_type", "value")
    return moments.merge_moments(before, new, key="event_type")


def moments_appended(spark, sf_dir):
    state = _appended_state(spark, sf_dir)
    return rounded(state.select("event_type", "n", "mean", moments.spread(1).alias("sd_sample"), moments.spread(0).alias("sd_pop")))


def zscore_appended(spark, sf_dir):
    state = materialise(_appended_state(spark, sf_dir), "moments")
    return rounded(moments.zscore_by(_events(spark, sf_dir), state, "event_type", "value"))


def outliers_appended(spark, sf_dir):
    state = materialise(_appended_state(spark, sf_dir), "moments")
    return moments.outliers_by(_events(spark, sf_dir), state, "event_type", "value")


QUERIES = {
    "moments_appended": moments_appended,
    "zscore_appended": zscore_appended,
    "outliers_appended": outliers_appended,
    "window_mean": window_mean,
    "window_stddev": window_stddev,
    "zscore": zscore,
    "outliers_sample": outliers_sample,
    "outliers_pop": outliers_pop,
    "outliers_two_pass": outliers_two_pass,
    "mean_by_group": mean_by_group,
    "mean_price_by_model": mean_price_by_model,
}

ORACLES = {
    "window_mean": """
        SELECT event_id, event_type, value, round(avg(value) OVER (PARTITION BY event_type), 6) AS mean_value FROM events""",
    "window_stddev": """
        SELECT l_orderkey, l_linenumber, l_extendedprice,
               round(stddev_samp(l_extendedprice) OVER (PARTITION BY l_orderkey), 4) AS sd FROM lineitem""",
    "zscore": """
        SELECT event_id, event_type, value,
               round((value - avg(value) OVER g) / nullif(stddev_samp(value) OVER g, 0), 6) AS z_score
        FROM events WINDOW g AS (PARTITION BY event_type)""",
    "outliers_sample": """
        SELECT event_id, event_type, value FROM (
          SELECT *, (value - avg(value) OVER g) / nullif(stddev_samp(value) OVER g, 0) AS z
          FROM events WINDOW g AS (PARTITION BY event_type)) WHERE z > -3 AND z < 3""",
    "outliers_pop": """
        SELECT l_orderkey, l_linenumber, l_extendedprice FROM (
          SELECT *, (l_extendedprice - avg(l_extendedprice) OVER g) / nullif(stddev_pop(l_extendedprice) OVER g, 0) AS z
          FROM lineitem WINDOW g AS (PARTITION BY l_orderkey)) WHERE z > -3 AND z < 3""",
    "outliers_two_pass": """
        WITH first_pass AS (
          SELECT event_id, event_type, value FROM (
            SELECT *, (value - avg(value) OVER g) / nullif(stddev_pop(value) OVER g, 0) AS z
            FROM events WINDOW g AS (PARTITION BY event_type)) WHERE z > -3 AND z < 3)
        SELECT event_id, event_type, value FROM (
          SELECT *, (value - avg(value) OVER g) / nullif(stddev_pop(value) OVER g, 0) AS z
          FROM first_pass WINDOW g AS (PARTITION BY event_type)) WHERE z > -3 AND z < 3""",
    "mean_by_group": over_vehicles(
        "SELECT model, round(avg(price), 6) AS price FROM price JOIN history_raw USING (id) GROUP BY model"),
    "mean_price_by_model": over_vehicles("SELECT model, round(avg(price), 6) AS price FROM kept_twice GROUP BY model"),
}
ORACLES |= {
    "moments_appended": """
        SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd_sample,
               round(stddev_pop(value), 6) AS sd_pop FROM events GROUP BY event_type HAVING count(value) > 0""",
    "zscore_appended": ORACLES["zscore"],
    "outliers_appended": ORACLES["outliers_sample"],
}
