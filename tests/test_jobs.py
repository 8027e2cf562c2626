"""Feature tables, resumed collection and its streaming form."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from lotledger.catalogue import ORACLES, QUERIES, collect, common
from lotledger.plans import jobs, vehicle_tables as vt
from lotledger.schemas import COLLECTED, ERROR_IDS
from lotledger.streaming.collect import _first_seen, collect_stream

FEATURES = [
    "total_loss", "damaged_count", "damaged_total", "damaged_by_other_count", "mileage", "tuning_history",
    "special_history", "usage_change", "accident", "little_accident", "manual_transmission", "car_age",
]


@pytest.fixture(scope="module")
def vehicles(spark, sf_dir):
    return common.vehicles(spark, sf_dir)


def test_joined_table_has_all_columns(vehicles):
    assert len(vehicles.columns) == 24 and vehicles.columns[:2] == ["id", "price"]


def test_feature_columns(vehicles):
    features = jobs.features_cluster(vehicles, "2024-12-01")
    numeric = [c for c in features.columns if c not in ("model", "fuel", "cc", "price", "owner_changed")]
    assert numeric == FEATURES
    assert features.where("price < 200").count() == 0
    assert "flood" in jobs.features_early(vehicles, "2024-12-01").columns
    population = jobs.features_pop(vehicles, "2024-12-01")
    assert "damaged_by_other_count" not in population.columns and dict(population.dtypes)["cc"] == "string"


def report_pages(spark, broken=()):
    """Two pages per id; ids in ``broken`` lack the accident page."""
    def inspection(i):
        items = "".join(f"<li><span>l</span><span>v{n}</span></li>" for n in range(8))
        return (f"<strong>차, {i}가1 </strong><strong>일 (최초 2020/01/0{i})</strong>"
                f"<ul><li><span>l</span><span>변속 (자동)</span></li>{items}</ul><ul>{items}</ul>")
    accident = "<ul><li><span>a</span><span>모델</span><span>2020</span></li></ul>"
    rows = [(i, inspection(i), None if i in broken else accident) for i in range(1, 7)]
    return spark.createDataFrame(rows, "id long, inspection string, accident string")


@pytest.fixture
def prices(spark):
    return spark.createDataFrame([(i, i * 10) for i in (1, 2, 3, 5, 6)], "id long, price int")


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], ERROR_IDS)


def found(df):
    return sorted(r.id for r in df.collect())


def test_collect_batch(spark, prices):
    pages = report_pages(spark, broken={3})
    wanted = pages.select("id").unionAll(ids(spark, 9))
    pending = jobs.pending_ids(wanted, ids(spark, 1), ids(spark, 2))
    good, bad = jobs.incremental_collect(pending, prices, ids(spark, 1), jobs.read_report_pairs(pages), ("price",))
    assert good.columns == COLLECTED.fieldNames() and found(good) == [4, 5, 6] and found(bad) == [3, 9]
    row = {r.id: r for r in good.collect()}
    assert row[4].price == "가격 없음" and row[5].price == "50"
    assert (row[5].car_number, row[5].registration_date, row[5].transmission) == ("5가1", "2020/01/05", "(자동")
    assert (row[5].car_name, row[5].year) == ("모델", "2020")


@pytest.mark.parametrize("target,good_ids,bad_ids", [(2, [2], []), (3, [2, 4], [3]), (1, [], []), (99, [2, 4, 5, 6], [3])])
def test_collect_stops_at_the_target(spark, prices, target, good_ids, bad_ids):
    pages = report_pages(spark, broken={3})
    pending = jobs.pending_ids(pages, ids(spark, 1), ids(spark))
    good, bad = jobs.incremental_collect(pending, prices, ids(spark, 1), jobs.read_report_pairs(pages), ("price",), target)
    assert found(good) == good_ids and found(bad) == bad_ids


def test_separate_report_tables_give_the_same_rows(spark):
    pages = report_pages(spark, broken={3})
    pair = jobs.read_report_pairs(pages)
    apart = jobs.read_reports(
        pages.select("id", F.col("inspection").alias("html")),
        pages.where("accident IS NOT NULL").select("id", F.col("accident").alias("html")),
    )
    assert sorted(map(tuple, pair.collect())) == sorted(map(tuple, apart.collect()))


def test_the_last_price_in_order_counts(spark):
    pages = report_pages(spark)
    prices = spark.createDataFrame([(1, 900, 0, 0), (1, 100, 0, 1), (2, 5, 1, 0), (2, 7, 0, 9)], "id long, price int, page int, pos int")
    good, _ = jobs.incremental_collect(pages.select("id"), prices, ids(spark), jobs.read_report_pairs(pages), ("page", "pos"))
    assert {r.id: r.price for r in good.collect() if r.id < 3} == {1: "100", 2: "5"}


def shuffled_columns(df):
    """Names of all columns that pass an exchange between tasks; broadcasts are not meant."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.initialPlan())
        if name == "Exchange":
            found.extend(node.output().apply(i).name() for i in range(node.output().size()))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return set(found)


@pytest.fixture
def no_small_tables(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pages_of_other_ids_are_left_out_without_a_shuffle(spark, no_small_tables):
    pages = report_pages(spark)
    one = pages.select("id", F.col("inspection").alias("html"))
    two = pages.select("id", F.col("accident").alias("html"))
    some = jobs.read_reports(one, two, ids(spark, 2, 4))
    assert found(some) == [2, 4]
    assert "html" not in shuffled_columns(some) and "id" in shuffled_columns(some)
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Generate") < plan.rindex("bitmap_construct_agg") and plan.count("bitmap_construct_agg") == 2


def test_pages_of_unlisted_ids_are_left_out_without_a_shuffle(spark, no_small_tables, tmp_path, monkeypatch):
    accidents = spark.createDataFrame([(1, "<dd>x</dd>"), (2, "<dd>y</dd>")], "id long, html string")
    listings = spark.createDataFrame([("KIA", '<div data-impression="1|5|"></div>')], "brand string, html string")
    written = []
    monkeypatch.setattr(jobs.writers, "write_by_brand", lambda rows, path: (written.append(rows), rows.write.partitionBy("brand").parquet(path)))
    jobs.collect_by_brand(listings, accidents, f"{tmp_path}/b")
    assert "html" not in shuffled_columns(written[0]) and {"id", "brand"} <= shuffled_columns(written[0])


def test_a_report_stored_many_times_is_one_row(spark, prices):
    pages = report_pages(spark)
    many = pages.unionAll(pages.where("id = 5")).unionAll(pages.where("id = 5").withColumn("accident", F.lit(None)))
    assert sorted(map(tuple, jobs.read_report_pairs(many).collect())) == sorted(map(tuple, jobs.read_report_pairs(pages).collect()))
    good, _ = jobs.incremental_collect(jobs.pending_ids(many, ids(spark), ids(spark)), prices, ids(spark), jobs.read_report_pairs(many), ("price",))
    assert found(good) == [1, 2, 3, 4, 5, 6]


def test_stream_resumes_without_repeats(spark, prices, tmp_path):
    pages = report_pages(spark, broken={3})
    landing, root = f"{tmp_path}/landing", f"{tmp_path}/out"

    def run():
        stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        collect_stream(stream, prices, ids(spark, 1), ids(spark), root, ("price",)).awaitTermination()
        read = lambda name, schema: found(spark.read.schema(schema).parquet(f"{root}/{name}"))
        return read("collected", COLLECTED), read("failed", ERROR_IDS)

    pages.where("id <= 4").repartition(2, "id").write.mode("append").parquet(landing)
    assert run() == ([2, 4], [3])
    assert run() == ([2, 4], [3])
    # Ids already stored or failed come again beside new ones.
    pages.where("id >= 3").coalesce(1).write.mode("append").parquet(landing)
    assert run() == ([2, 4, 5, 6], [3])


def test_a_batch_reads_nothing_that_earlier_ones_wrote(spark, prices, tmp_path):
    pages = report_pages(spark, broken={3})
    landing, root = f"{tmp_path}/landing", f"{tmp_path}/out"

    def run(done):
        stream = spark.readStream.schema(pages.schema).parquet(landing)
        collect_stream(stream, prices, done, ids(spark), root, ("price",)).awaitTermination()
        return found(spark.read.schema(COLLECTED).parquet(f"{root}/collected")), found(spark.read.schema(ERROR_IDS).parquet(f"{root}/failed"))

    pages.where("id <= 4").write.parquet(landing)
    assert run(ids(spark, 1)) == ([2, 4], [3])
    (tmp_path / "out/collected").rename(tmp_path / "moved-collected")
    (tmp_path / "out/failed").rename(tmp_path / "moved-failed")
    # All pages once more, and ids known at the start are taken from the state, not from the argument.
    pages.withColumn("inspection", F.when(F.col("id") != 6, F.col("inspection"))).write.mode("append").parquet(landing)
    assert run(ids(spark)) == ([5], [6])


def test_pages_of_known_ids_are_left_out_where_they_are_scanned(spark, prices, tmp_path):
    pages = report_pages(spark, broken={3})
    landing, root = f"{tmp_path}/landing", f"{tmp_path}/out"
    done = ids(spark, 1, 10**12, None).unionAll(spark.range(7, 700).select("id"))
    far = pages.where("id = 2").withColumn("id", F.lit(10**12)).unionAll(pages.where("id = 2").withColumn("id", F.lit(None).cast("long")))

    def run(known):
        stream = spark.readStream.schema(pages.schema).parquet(landing)
        collect_stream(stream, prices, known, ids(spark, 4), root, ("price",)).awaitTermination()
        return found(spark.read.schema(COLLECTED).parquet(f"{root}/collected")), found(spark.read.schema(ERROR_IDS).parquet(f"{root}/failed")), stream

    pages.unionAll(far).write.parquet(landing)
    collected, failed, stream = run(done)
    assert (collected, failed) == ([2, 5, 6], [3])
    # The state is given only ids that lie far apart; bitmaps of the others are applied before any page is worked on.
    assert {r.id for r in spark.read.schema(ERROR_IDS).parquet(f"{root}/known").collect()} == {10**12, None}
    plan = _first_seen(stream, root)._jdf.queryExecution().analyzed().toString()
    assert plan.count("LeftAnti") == 1 and plan.index("Generate") < plan.rindex("Generate") < plan.index("LeftAnti")
    pages.unionAll(far).write.mode("append").parquet(landing)
    assert run(ids(spark))[:2] == ([2, 5, 6], [3])


def test_the_most_complete_page_of_a_batch_counts(spark, prices, tmp_path):
    pages = report_pages(spark)
    worse = pages.withColumn("accident", F.lit(None).cast("string"))
    worse.unionAll(pages).unionAll(worse).coalesce(1).write.parquet(f"{tmp_path}/landing")
    stream = spark.readStream.schema(pages.schema).parquet(f"{tmp_path}/landing")
    collect_stream(stream, prices, ids(spark, 2), ids(spark, 4), f"{tmp_path}/out", ("price",)).awaitTermination()
    assert found(spark.read.schema(COLLECTED).parquet(f"{tmp_path}/out/collected")) == [1, 3, 5, 6]


def test_brand_collection(spark, tmp_path):
    listing = '<div data-impression="{0}|5|"></div><div data-impression="{0}|6|"></div>'
    listings = spark.createDataFrame([("KIA", listing.format(1)), ("KIA", listing.format(2)), ("BMW", listing.format(1))], "brand string, html string")
    spans = "<span><span>1회</span><span>2회</span><span>0회</span></span>"
    items = "".join(f"<li>{spans}</li>" for _ in range(6))
    accidents = spark.createDataFrame([(1, f"<dd>12가1</dd><ul>{items}</ul>"), (2, "<dd>12가2</dd>")], "id long, html string")
    got = jobs.collect_by_brand(listings, accidents, f"{tmp_path}/b")
    assert sorted((r.brand, r.id, r.license) for r in got.collect()) == [("BMW", 1, "12가1"), ("KIA", 1, "12가1")]


def test_catalogue_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    without_sql = set(QUERIES) - set(ORACLES)
    assert without_sql == {"train_forest", "train_linear", "pca_diagnosis", "pca_diagnosis_scores"}


def test_vehicle_tables_cover_the_branches(spark, sf_dir):
    raw = vt.history_raw(spark, sf_dir)
    kinds = raw.select(
        F.count_if(F.col("cm") == "없음"), F.count_if(F.col("cm") == "미확정"), F.count_if(F.col("cm").contains("회미확정"))
    ).first()
    assert all(kinds)


def test_stream_stops_at_the_target(spark, prices, tmp_path):
    pages = report_pages(spark, broken={3})
    landing, root = f"{tmp_path}/landing", f"{tmp_path}/out"
    for first, last in ((1, 3), (4, 6)):
        pages.where(f"id BETWEEN {first} AND {last}").coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(pages.schema).parquet(landing)
        collect_stream(stream, prices, ids(spark, 1), ids(spark), root, ("price",), target=3).awaitTermination()
    assert found(spark.read.schema(COLLECTED).parquet(f"{root}/collected")) == [2, 4]
    assert found(spark.read.schema(ERROR_IDS).parquet(f"{root}/failed")) == [3]


def broadcast_columns(df):
    """Names of all columns that a plan takes to the driver to broadcast them."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.initialPlan())
        if name.startswith("Broadcast") and not name.endswith("Join"):
            found.extend(node.output().apply(i).name() for i in range(node.output().size()))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return set(found)


class Ended:
    awaitTermination = staticmethod(lambda: None)


def test_streamed_pages_are_not_broadcast(spark, sf_dir, tmp_path, monkeypatch):
    written, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(collect, "new_location", lambda *_: f"{tmp_path}/stream")
    monkeypatch.setattr(collect, "collect_stream", lambda *_: Ended)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: written.append(self._df) or write(self, path))
    collect._streamed(spark, sf_dir)
    assert not {"inspection", "html"} & (broadcast_columns(written[0]) | shuffled_columns(written[0]))


def test_report_pairs_are_the_joined_pages(spark, sf_dir):
    pairs = vt.report_pairs(spark, sf_dir, 4)
    joined = (
        vt.price(spark, sf_dir).select("id")
        .join(vt.inspection_pages(spark, sf_dir).withColumnRenamed("html", "inspection"), "id", "left")
        .join(vt.accident_pages(spark, sf_dir).withColumnRenamed("html", "accident"), "id", "left")
    )
    assert pairs.count() == joined.count() and pairs.exceptAll(joined).isEmpty()
    assert pairs.where("inspection IS NULL").count() and pairs.where("inspection IS NOT NULL AND accident IS NOT NULL").count()


def test_stored_ids_are_not_broadcast_to_look_up_prices(spark, prices, tmp_path):
    good = jobs.read_report_pairs(report_pages(spark)).drop("is_ok")
    rows = jobs.store_prices(good, prices.unionAll(ids(spark, 9).select("id", F.lit(1))), ("price",))
    assert sorted((r.id, r.price) for r in rows.collect()) == [(1, "10"), (2, "20"), (3, "30"), (4, "가격 없음"), (5, "50"), (6, "60")]
    assert "bitmap_construct_agg" in rows._jdf.queryExecution().optimizedPlan().toString()
