"""Whole jobs: cleaning, the joined table, feature tables, models and collection."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.functions.claims import extract_number, parse_claims
from lotledger.functions.features import (
    car_age, digits_only, flag_equals, flag_nonzero, flag_present, parse_cc, parse_mileage, saturate,
)
from lotledger.functions.text import nth_token
from lotledger.operators import categories, extract, model as models, sparse_pca
from lotledger.operators.group_stats import drop_outliers, mean_by
from lotledger.operators.impute import impute_mean
from lotledger.operators.id_filter import id_filter, may_be_in
from lotledger.operators.relational import (
    concat_tables, drop_cols, exclude_ids, filter_min, filter_model, harmonise, join_vehicles, lookup_default,
)
from lotledger.operators.selection import first_rows
from lotledger.schemas import (
    COLLECTED, INSURANCE_NAMES, LOG_COLUMNS, MANUAL_TEXT, MIN_PRICE, NUMBER_COLUMNS, PRICE_MISSING_TEXT, YES_NO_COLUMNS,
)
from lotledger.session import materialise
from lotledger.sources import writers

CLAIM_COLUMNS = {"cm": ("damaged_count", "damaged_total"), "co": ("damaged_by_other_count", "damaged_by_other_total")}


def clean_history(raw: DataFrame) -> DataFrame:
    """Raw report texts to numbers; unknown claim amounts become the rounded mean amount."""
    parsed = raw.withColumns({
        **{c: extract_number(F.col(c)) for c in NUMBER_COLUMNS},
        **{source: parse_claims(F.col(source)) for source in CLAIM_COLUMNS},
    })
    flat = parsed.select(
        *[c for c in raw.columns if c not in CLAIM_COLUMNS],
        *[
            F.col(f"{source}.{part}").alias(name)
            for source, names in CLAIM_COLUMNS.items()
            for part, name in zip(("count", "total"), names, strict=True)
        ],
    )
    return impute_mean(flat, [total for _, total in CLAIM_COLUMNS.values()])


def build_vehicles(price: DataFrame, history: DataFrame, status: DataFrame) -> DataFrame:
    return join_vehicles(price, history, status)


def merge_claims(df: DataFrame, keep_other_count: bool) -> DataFrame:
    """Other-car claims added into the own-car columns.

    The cluster jobs leave ``damaged_by_other_count`` in the table as a feature.
    """
    merged = df.withColumns({
        "damaged_count": F.col("damaged_count") + F.col("damaged_by_other_count"),
        "damaged_total": F.col("damaged_total") + F.col("damaged_by_other_total"),
    })
    return drop_cols(merged, ["damaged_by_other_total"] + ([] if keep_other_count else ["damaged_by_other_count"]))


def log_features(df: DataFrame, columns: list[str] = LOG_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.log1p(c) for c in columns})


def _numeric(df: DataFrame, as_of: dt.date | str, pandas_rules: bool) -> DataFrame:
    """Flags, parsed numbers and age shared by the feature tables."""
    columns = {
        **{c: flag_present(F.col(c)) for c in YES_NO_COLUMNS},
        "manual_transmission": flag_equals(F.col("transmission"), MANUAL_TEXT),
        "car_age": car_age(F.col("registration_date"), as_of),
    }
    if pandas_rules:
        columns |= {c: flag_nonzero(F.col(c)) for c in ("total_loss", "flood")}
        columns |= {"mileage": digits_only(F.col("mileage"))}
    else:
        columns |= {"mileage": parse_mileage(F.col("mileage")), "cc": parse_cc(F.col("cc"))}
    return drop_cols(df.withColumns(columns), ["transmission", "registration_date"])


def features_cluster(vehicles: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Feature table without logs, outliers by sample deviation, with a price floor."""
    kept = drop_outliers(vehicles, "model", "price", ddof=1)
    kept = drop_cols(kept, ["license_changed", "flood", "license", "theft", "id", "warranty"])
    numeric = merge_claims(_numeric(kept, as_of, pandas_rules=False), keep_other_count=True)
    return filter_min(numeric, "price", MIN_PRICE)


def features_log(vehicles: DataFrame, as_of: dt.date | str) -> DataFrame:
    """The cluster features with logs, then mileage saturated on top of its log."""
    logged = log_features(features_cluster(vehicles, as_of))
    return logged.withColumn("mileage", saturate(F.col("mileage")))


def features_early(vehicles: DataFrame, as_of: dt.date | str) -> DataFrame:
    """First form of the log features: no price floor, and ``flood`` is kept."""
    kept = drop_outliers(vehicles, "model", "price", ddof=1)
    kept = drop_cols(kept, ["license_changed", "license", "theft", "id", "warranty"])
    logged = log_features(merge_claims(_numeric(kept, as_of, pandas_rules=False), keep_other_count=True))
    return logged.withColumn("mileage", saturate(F.col("mileage")))


def features_pop(vehicles: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Feature table with population deviation, loss flags and logs; ``cc`` stays text."""
    kept = drop_outliers(vehicles, "model", "price", ddof=0)
    kept = drop_cols(kept, ["id", "license", "license_changed", "theft", "warranty"])
    return log_features(merge_claims(_numeric(kept, as_of, pandas_rules=True), keep_other_count=False))


def _train(
    features: DataFrame, model_name: str, fit, split_key: str | None, on_null: str
) -> tuple[DataFrame, DataFrame]:
    """Predictions on the held-out fifth and their metrics, for one car model.

    A hash of ``split_key``, or of the whole row, decides the side, so the file layout and the
    number of cores do not.
    """
    one = filter_model(features, model_name)
    if split_key is None:
        split_key = "__row"
        one = one.withColumn(split_key, F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in one.columns]))
    rows = models.assemble(one, keep=[split_key], on_null=on_null)
    # Split, fit and evaluation all read these rows: write the assembled vectors once.
    marked = models.hash_split(materialise(rows, "assembled"), split_key)
    train, test = marked.where("is_train"), marked.where(~F.col("is_train"))
    predictions = models.predict(fit(train), test).select("prediction", "label")
    return predictions, models.evaluate(predictions)


def train_forest(
    features: DataFrame, model_name: str, trees: int = 100, depth: int = 10, seed: int = 42,
    split_key: str | None = None, on_null: str = "error",
) -> tuple[DataFrame, DataFrame]:
    """Random forest: predictions on held-out rows, and their ``rmse`` and ``mse``."""
    return _train(features, model_name, lambda rows: models.fit_forest(rows, trees, depth, seed), split_key, on_null)


def train_linear(
    features: DataFrame, model_name: str, split_key: str | None = None, on_null: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """Linear regression: predictions on held-out rows, and their ``rmse`` and ``mse``."""
    return _train(features, model_name, models.fit_linear, split_key, on_null)


def pca_diagnosis(features: DataFrame, model_name: str, on_null: str = "error") -> tuple[DataFrame, DataFrame]:
    """Explained-variance ratios, and the first two component scores beside the price."""
    one = drop_cols(filter_model(features, model_name), ["model"])
    one = materialise(one.dropna() if on_null == "skip" else one, "pca-input")
    texts = [name for name, kind in one.dtypes if kind == "string"]
    coded = categories.one_hot_columns(one, {c: categories.levels(one, c) for c in texts})
    inputs = [c for c in coded.columns if c != "price"]
    vectors = models.assemble(categories.standardise(coded, inputs), exclude=["price"])
    vectors = materialise(vectors, "pca-vectors")
    fitted = models.fit_pca(vectors, len(inputs))
    return models.pca_ratios(fitted, vectors), models.pca_scores(fitted, vectors)


def pca_diagnosis_sparse(
    features: DataFrame, model_name: str, keys: list[str], components: int = 2, on_null: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """The diagnosis for any number of category values: no wide table, no square matrix on the driver.

    Ratios of the first components, and the keys and scores of every row beside the price. ``keys``
    name a row and are no features.
    """
    one = drop_cols(filter_model(features, model_name), ["model"])
    one = materialise(one.dropna() if on_null == "skip" else one, "pca-input")
    inputs = one.drop("price")
    fitted = sparse_pca.fit_sparse_pca(sparse_pca.sparse_entries(inputs, keys), components, n_rows=one.count())
    names = [f"pc{i + 1}" for i in range(fitted.components)]
    zero = fitted.zero_scores()
    scores = fitted.scores().select(*[F.col("row")[k].alias(f"__{k}") for k in keys], *names)
    matched = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) for k in keys])
    joined = one.join(scores, matched, "left")
    return fitted.ratios, joined.select(
        *[F.col(f"`{k}`") for k in keys], *[F.coalesce(c, F.lit(zero[c])).alias(c) for c in names], F.col("price").alias("label"))


def mean_price_by_model(vehicles: DataFrame) -> DataFrame:
    """Mean price per model after two outlier passes."""
    return mean_by(drop_outliers(vehicles, "model", "price", ddof=0, passes=2), "model", "price")


_COLLECTED_FIELDS = [name for name in COLLECTED.fieldNames() if name not in ("id", "price")]


def _one_per_id(rows: DataFrame) -> DataFrame:
    """The most complete row of every id; a page stored many times collapses before the shuffle."""
    fields = [c for c in rows.columns if c != "id"]
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in fields])
    best = F.max(F.struct(filled.alias("__filled"), *fields)).alias("best")
    return rows.groupBy("id").agg(best).select("id", *[F.col("best")[c].alias(c) for c in fields])


def collected_fields(rows: DataFrame) -> DataFrame:
    """Tokens cut out of the extracted texts, and ``is_ok`` when no field is missing."""
    cut = rows.withColumns({
        "car_number": nth_token(F.col("car_title"), ", ", 2, " "),
        "registration_date": nth_token(F.col("registered"), " ", -1, ")"),
        "transmission": nth_token(F.col("gearbox"), " ", -1, ")"),
    })
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in _COLLECTED_FIELDS])
    return cut.select("id", *_COLLECTED_FIELDS, complete.alias("is_ok"))


def read_reports(inspections: DataFrame, accidents: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """The collected fields of both report tables, one row per inspected id, with ``is_ok``.

    With ``wanted``, pages of other ids are left out where they are scanned, by a filter of
    fixed size. What it lets pass wrongly goes after extraction, in an exact join of the short
    fields. Pages themselves are never shuffled.
    """
    if wanted is not None:
        passing = id_filter(wanted)
        inspections, accidents = may_be_in(inspections, passing), may_be_in(accidents, passing)
    inspected = _one_per_id(extract.extract_fields(inspections, extract.COLLECT_FIELDS, ["id"]))
    named = _one_per_id(extract.extract_fields(accidents, extract.ACCIDENT_SUMMARY_FIELDS, ["id"]))
    if wanted is not None:
        inspected = inspected.join(wanted.select("id"), "id", "left_semi")
    return collected_fields(inspected.join(named, "id", "left"))


def report_pair_fields(pages: DataFrame) -> DataFrame:
    """``id`` and raw fields from rows that carry both pages of an id as ``inspection`` and ``accident``."""
    inspected = extract.extract_fields(pages, extract.COLLECT_FIELDS, ["id", "accident"], html="inspection")
    fields = [c for c in inspected.columns if c != "accident"]
    return extract.extract_fields(inspected, extract.ACCIDENT_SUMMARY_FIELDS, fields, html="accident")


def read_report_pairs(pages: DataFrame) -> DataFrame:
    """The same as :func:`read_reports` from rows that carry both pages of an id."""
    return collected_fields(_one_per_id(report_pair_fields(pages)))


def pending_ids(ids: DataFrame, done: DataFrame, failed: DataFrame) -> DataFrame:
    """Distinct ids that are neither stored nor failed, stored once for all that ask for them."""
    return materialise(exclude_ids(ids.select("id").distinct(), done, failed), "pending-ids")


def store_prices(good: DataFrame, prices: DataFrame, price_order: tuple[str, ...]) -> DataFrame:
    """Collected rows with their price; of repeated prices the last in ``price_order`` counts."""
    # Few new rows leave few prices to look through; the filter is of fixed size, as a plan may broadcast ids.
    wanted = may_be_in(prices, id_filter(good))
    return lookup_default(good, wanted, "id", "price", PRICE_MISSING_TEXT, list(price_order)).select(*COLLECTED.fieldNames())


def up_to_target(good: DataFrame, bad: DataFrame, room: int) -> tuple[DataFrame, DataFrame]:
    """The first ``room`` good rows by id, and the failed ids before the last of them."""
    good = materialise(first_rows(good, ["id"], room), "collected-capped")
    last = F.coalesce(F.max("id"), F.lit(-(2**63)))
    stop = good.agg(F.when(F.count("id") >= room, last)).first()[0]
    return good, bad if stop is None else bad.where(F.col("id") < stop)


def incremental_collect(
    pending: DataFrame, prices: DataFrame, done: DataFrame, reports: DataFrame,
    price_order: tuple[str, ...], target: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """New complete rows, and the ids that failed, of one resumed collection.

    ``pending`` are the ids still to do, as :func:`pending_ids` gives them, ``reports`` has one
    row per id, as :func:`read_reports` gives it. With a ``target`` ids are taken in order until
    the stored rows, those of ``done`` included, reach it; ids after that point are neither
    stored nor failed. Of repeated prices the last in ``price_order`` counts.
    """
    read = pending.join(reports, "id", "left").withColumn("is_ok", F.coalesce("is_ok", F.lit(False)))
    good, bad = writers.split_ok_error(materialise(read, "collected"))
    if target is not None:
        good, bad = up_to_target(good, bad, max(0, target - done.select("id").distinct().count()))
    return store_prices(good, prices, price_order), bad


def collect_by_brand(listings: DataFrame, accidents: DataFrame, path: str) -> DataFrame:
    """Accident fields of every id listed under a brand, one folder per brand.

    ``listings`` are listing pages with a ``brand`` column. Reports with a missing field are
    left out. An id has one row per brand it is listed under. Reports of ids that are not
    listed are left out before extraction, without shuffling pages.
    """
    ids = extract.listing_ids(extract.listing_nodes(listings, ["brand"]), ["brand"])
    ids = materialise(ids.withColumn("id", F.col("id").try_cast("long")), "listed-ids")
    fields = {name: extract.ACCIDENT_FIELDS[name] for name in INSURANCE_NAMES["current"] if name != "id"}
    listed = may_be_in(accidents, id_filter(ids))
    reports = _one_per_id(extract.require_all(extract.extract_fields(listed, fields, ["id"]), list(fields)))
    rows = ids.join(reports, "id")
    writers.write_by_brand(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def brand_merge(brand_tables: list[DataFrame], scheme: str) -> DataFrame:
    """Per-brand insurance tables under one header style, all rows kept."""
    return concat_tables([harmonise(t, scheme) for t in brand_tables])
