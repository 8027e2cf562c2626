"""Model operators and training jobs."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lotledger.catalogue.base_sql import AS_OF, over_vehicles
from lotledger.catalogue.common import history, rounded, vehicles
from lotledger.operators import categories, model as models, sparse_pca
from lotledger.plans import jobs, vehicle_tables as vt
from lotledger.session import materialise

ONE_MODEL = "3-MEDIUM"
_MODELS = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def assembled(spark, sf_dir):
    names, label = ["owner_changed", "total_loss", "damaged_count", "damaged_total"], "damaged_by_other_total"
    numbers = history(spark, sf_dir).select("id", *names, label)
    vectors = models.assemble(numbers, exclude=[label], keep=["id"], label=label, on_null="skip")
    parts = vector_to_array("features")
    return vectors.select("id", "label", *[parts[i].alias(c) for i, c in enumerate(names)])


def hash_split(spark, sf_dir):
    return models.hash_split(vt.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


def random_split(spark, sf_dir):
    """Both parts together: no row is lost and none is in both."""
    train, test = models.random_split(vt.price(spark, sf_dir))
    return train.unionAll(test)


def _line_vectors(spark, sf_dir):
    """Line price explained by quantity, stored once for fitting and scoring."""
    lines = vt.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    keys, label = ["l_orderkey", "l_linenumber"], "l_extendedprice"
    vectors = models.assemble(lines, exclude=[label], keep=keys, label=label)
    return materialise(vectors, "line-vectors")


def linear_fit(spark, sf_dir):
    fitted = models.fit_linear(_line_vectors(spark, sf_dir))
    row = [(round(float(fitted.coefficients[0]), 4), round(fitted.intercept, 3))]
    return spark.createDataFrame(row, "slope double, intercept double")


def _line_predictions(spark, sf_dir):
    vectors = _line_vectors(spark, sf_dir)
    return models.predict(models.fit_linear(vectors), vectors)


def linear_predict(spark, sf_dir):
    return rounded(_line_predictions(spark, sf_dir).drop("features"), 3)


def rmse_mse(spark, sf_dir):
    metrics = models.evaluate(_line_predictions(spark, sf_dir))
    return metrics.select(F.round("rmse", 4).alias("rmse"), F.round("mse", 0).alias("mse"))


def forest_predict(spark, sf_dir):
    """A label that one small-range feature decides, so that every leaf is pure."""
    lines = vt.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    labelled = lines.withColumn("label", (F.col("l_linenumber") * F.col("l_linenumber")).cast("double")).withColumn("x", F.col("l_linenumber"))
    vectors = models.assemble(labelled, exclude=["label"], keep=["l_orderkey", "l_linenumber"], label="label")
    vectors = materialise(vectors, "forest-vectors")
    return rounded(models.predict(models.fit_forest(vectors), vectors).drop("features"))


def one_hot(spark, sf_dir):
    """The sparse vectors, spread over columns for the comparison; places count from the last value."""
    raw = vt.history_raw(spark, sf_dir).select("id", "fuel", "model")
    coded = categories.one_hot(raw, ["fuel", "model"])
    fuel, car = vector_to_array("fuel"), vector_to_array("model")
    return coded.select(
        "id",
        *[fuel[i].cast("int").alias(f"fuel_{name}") for i, name in enumerate(["디젤", "가솔린"])],
        *[car[i].cast("int").alias(f"model_{name}") for i, name in enumerate(reversed(_MODELS))],
    )


def standardise(spark, sf_dir):
    orders = vt.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return rounded(categories.standardise(orders, ["o_totalprice"]))


def _scaled_line_vectors(spark, sf_dir):
    lines = vt.table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_tax")
    scaled = categories.standardise(lines, ["l_quantity", "l_extendedprice"])
    vectors = models.assemble(scaled, exclude=["l_tax"], label="l_tax")
    return materialise(vectors, "scaled-vectors")


def pca_ratios(spark, sf_dir):
    vectors = _scaled_line_vectors(spark, sf_dir)
    return rounded(models.pca_ratios(models.fit_pca(vectors, 2), vectors))


def pca_scores(spark, sf_dir):
    vectors = _scaled_line_vectors(spark, sf_dir)
    return rounded(models.pca_scores(models.fit_pca(vectors, 2), vectors), 5)


def _features(job, spark, sf_dir):
    """One model's features: groups do not mix, so its rows are chosen before anything is stored."""
    return job(vehicles(spark, sf_dir, model=ONE_MODEL), AS_OF)


def _both(predictions, metrics):
    """Each prediction beside the metrics of all."""
    found = metrics.first()
    return rounded(predictions.withColumns({name: F.lit(found[name]) for name in metrics.columns}))


def train_forest(spark, sf_dir):
    return _both(*jobs.train_forest(_features(jobs.features_cluster, spark, sf_dir), ONE_MODEL, on_null="skip"))


def train_linear(spark, sf_dir):
    return _both(*jobs.train_linear(_features(jobs.features_log, spark, sf_dir), ONE_MODEL, on_null="skip"))


def pca_diagnosis(spark, sf_dir):
    return jobs.pca_diagnosis(_features(jobs.features_pop, spark, sf_dir), ONE_MODEL, on_null="skip")[0]


def pca_diagnosis_scores(spark, sf_dir):
    return jobs.pca_diagnosis(_features(jobs.features_pop, spark, sf_dir), ONE_MODEL, on_null="skip")[1]


def _labelled(spark, sf_dir, price):
    """One model's vehicles with a price that a few of their columns decide."""
    columns = ["id", "model", "owner_changed", "license_changed", "damaged_by_other_count"]
    rows = vehicles(spark, sf_dir, columns, ONE_MODEL).withColumn("price", price.cast("double"))
    return rows.withColumnsRenamed({"owner_changed": "owners", "license_changed": "plates", "damaged_by_other_count": "claims"})


def train_forest_pure(spark, sf_dir):
    """The job on a price that one small count decides: every leaf is pure, so no held-out row is missed.

    Counts of four and more have one price, as a tree may be grown without rows of a rare count.
    """
    owners = F.least(F.col("owner_changed"), F.lit(4))
    rows = _labelled(spark, sf_dir, owners * owners).drop("plates", "claims")
    return _both(*jobs.train_forest(rows, ONE_MODEL, split_key="id"))


def train_linear_exact(spark, sf_dir):
    """The job on a price that is linear in three counts."""
    price = 10 + 3 * F.col("owner_changed") + F.col("license_changed") - 2 * F.col("damaged_by_other_count")
    return _both(*jobs.train_linear(_labelled(spark, sf_dir, price), ONE_MODEL, split_key="id", on_null="skip"))


def pca_diagnosis_totals(spark, sf_dir):
    """What holds of any diagnosis: shares sum to one, scores are centred and spread as their share says."""
    ratios, scores = jobs.pca_diagnosis(_features(jobs.features_pop, spark, sf_dir), ONE_MODEL, on_null="skip")
    shares = ratios.agg(
        F.count("*").alias("components"), F.sum("ratio").alias("ratios"),
        *[F.max(F.when(F.col("component") == i, F.col("ratio"))).alias(f"r{i}") for i in (1, 2)])
    spreads = scores.agg(
        F.count("*").alias("n"), F.abs(F.round(F.avg("pc1"), 6)).alias("mean1"), F.abs(F.round(F.avg("pc2"), 6)).alias("mean2"),
        F.var_pop("pc1").alias("v1"), F.var_pop("pc2").alias("v2"), F.sum(F.col("label").cast("long")).alias("label"))
    both = shares.join(F.broadcast(spreads))  # one row each
    return rounded(both.select(
        "components", "ratios", "n", "mean1", "mean2", "label",
        (F.col("v1") / F.col("r1")).alias("varying1"), (F.col("v2") / F.col("r2")).alias("varying2")), 4)


def _sparse_lines(spark, sf_dir):
    """Lines that share order and number are one row, whose entries add up."""
    lines = vt.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return sparse_pca.fit_sparse_pca(sparse_pca.sparse_entries(lines, ["l_orderkey", "l_linenumber"]), 2)


def pca_sparse_ratios(spark, sf_dir):
    return rounded(_sparse_lines(spark, sf_dir).ratios)


def pca_sparse_scores(spark, sf_dir):
    return rounded(_sparse_lines(spark, sf_dir).scores().select("row.*", "pc1", "pc2"), 5)


QUERIES = {
    "assemble": assembled,
    "hash_split": hash_split,
    "random_split": random_split,
    "linear_fit": linear_fit,
    "linear_predict": linear_predict,
    "rmse_mse": rmse_mse,
    "forest_predict": forest_predict,
    "one_hot": one_hot,
    "standardise": standardise,
    "pca_ratios": pca_ratios,
    "pca_scores": pca_scores,
    "train_forest": train_forest,
    "train_linear": train_linear,
    "pca_diagnosis": pca_diagnosis,
    "pca_diagnosis_scores": pca_diagnosis_scores,
    "train_forest_pure": train_forest_pure,
    "train_linear_exact": train_linear_exact,
    "pca_diagnosis_totals": pca_diagnosis_totals,
    "pca_sparse_ratios": pca_sparse_ratios,
    "pca_sparse_scores": pca_sparse_scores,
}

_LINE = """
WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept
             FROM lineitem),
scored AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS label, intercept + slope * l_quantity AS prediction
           FROM lineitem, fit)
"""
_SUMS = """
WITH sums AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS quantity, sum(l_extendedprice) AS price
              FROM lineitem GROUP BY l_orderkey, l_linenumber)
"""
_HELD_OUT = f"model = '{ONE_MODEL}' AND CAST('0x' || substr(md5(id || ':42'), 1, 8) AS BIGINT) % 10000 >= 8000"
ORACLES = {
    "assemble": over_vehicles("""
        SELECT id, damaged_by_other_total AS label, CAST(owner_changed AS DOUBLE) AS owner_changed,
               CAST(total_loss AS DOUBLE) AS total_loss, CAST(damaged_count AS DOUBLE) AS damaged_count,
               CAST(damaged_total AS DOUBLE) AS damaged_total
        FROM history WHERE damaged_count IS NOT NULL"""),
    "hash_split": """
        SELECT o_orderkey, CAST('0x' || substr(md5(o_orderkey || ':42'), 1, 8) AS BIGINT) % 10000 < 8000 AS is_train
        FROM orders""",
    "random_split": over_vehicles("SELECT id, price FROM price"),
    "forest_predict": """
        SELECT l_orderkey, l_linenumber, CAST(l_linenumber * l_linenumber AS DOUBLE) AS label,
               CAST(l_linenumber * l_linenumber AS DOUBLE) AS prediction FROM lineitem""",
    "linear_fit": f"{_LINE} SELECT round(slope, 4) AS slope, round(intercept, 3) AS intercept FROM fit",
    "linear_predict": f"""{_LINE}
        SELECT l_orderkey, l_linenumber, round(label, 3) AS label, round(prediction, 3) AS prediction FROM scored""",
    "rmse_mse": f"""{_LINE}
        SELECT round(sqrt(avg(power(label - prediction, 2))), 4) AS rmse,
               round(avg(power(label - prediction, 2)), 0) AS mse FROM scored""",
    "one_hot": over_vehicles(
        "SELECT id, CASE WHEN fuel = '가솔린' THEN 1 ELSE 0 END AS \"fuel_가솔린\","
        " CASE WHEN fuel = '디젤' THEN 1 ELSE 0 END AS \"fuel_디젤\", "
        + ", ".join(f"CASE WHEN model = '{m}' THEN 1 ELSE 0 END AS \"model_{m}\"" for m in _MODELS)
        + " FROM history_raw"),
    "standardise": """
        SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6)
               AS o_totalprice FROM orders""",
    "pca_ratios": """
        SELECT 1 AS component, round((1 + abs(corr(l_quantity, l_extendedprice))) / 2, 6) AS ratio FROM lineitem
        UNION ALL SELECT 2, round((1 - abs(corr(l_quantity, l_extendedprice))) / 2, 6) FROM lineitem""",
    "pca_scores": """
        SELECT round(((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER ()
                      + sign(corr(l_quantity, l_extendedprice) OVER ())
                        * (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER ()) / sqrt(2), 5)
               AS pc1,
               round(((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER ()
                      - sign(corr(l_quantity, l_extendedprice) OVER ())
                        * (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER ()) / sqrt(2), 5)
               AS pc2, round(l_tax, 5) AS label FROM lineitem""",
    "train_forest_pure": over_vehicles(f"""
        SELECT CAST(power(least(owner_changed, 4), 2) AS DOUBLE) AS label, label AS prediction,
               CAST(0 AS DOUBLE) AS rmse, CAST(0 AS DOUBLE) AS mse FROM vehicles WHERE {_HELD_OUT}"""),
    "train_linear_exact": over_vehicles(f"""
        SELECT CAST(10 + 3 * owner_changed + license_changed - 2 * damaged_by_other_count AS DOUBLE) AS label,
               label AS prediction, CAST(0 AS DOUBLE) AS rmse, CAST(0 AS DOUBLE) AS mse
        FROM vehicles WHERE damaged_by_other_count IS NOT NULL AND {_HELD_OUT}"""),
    "pca_diagnosis_totals": over_vehicles(f"""
        SELECT CAST(sum(CASE WHEN c IN ('fuel', 'cc') THEN k - 1 ELSE 1 END) AS BIGINT) AS components,
               CAST(1 AS DOUBLE) AS ratios, max(n) AS n, CAST(0 AS DOUBLE) AS mean1, CAST(0 AS DOUBLE) AS mean2,
               max(total) AS label,
               CAST(sum(CASE WHEN c IN ('fuel', 'cc') THEN k - 1 WHEN k > 1 THEN 1 ELSE 0 END) AS DOUBLE) AS varying1,
               varying1 AS varying2
        FROM (SELECT c, count(DISTINCT v) AS k, count(*) AS n FROM (
                UNPIVOT (SELECT CAST(COLUMNS(* EXCLUDE (model, price)) AS VARCHAR) FROM features_pop
                         WHERE model = '{ONE_MODEL}' AND COLUMNS(*) IS NOT NULL)
                ON COLUMNS(*) INTO NAME c VALUE v) GROUP BY c),
             (SELECT CAST(sum(price) AS BIGINT) AS total FROM features_pop
              WHERE model = '{ONE_MODEL}' AND COLUMNS(*) IS NOT NULL)"""),
    "pca_sparse_ratios": f"""{_SUMS}
        SELECT 1 AS component, round((1 + abs(corr(quantity, price))) / 2, 6) AS ratio FROM sums
        UNION ALL SELECT 2, round((1 - abs(corr(quantity, price))) / 2, 6) FROM sums""",
    "pca_sparse_scores": f"""{_SUMS}
        SELECT l_orderkey, l_linenumber,
               round((price + sign(c) * quantity) / sqrt(2), 5) AS pc1, round((price - sign(c) * quantity) / sqrt(2), 5) AS pc2
        FROM (SELECT l_orderkey, l_linenumber, corr(quantity, price) OVER () AS c,
                     (quantity - avg(quantity) OVER ()) / stddev_pop(quantity) OVER () AS quantity,
                     (price - avg(price) OVER ()) / stddev_pop(price) OVER () AS price
              FROM sums)""",
}
