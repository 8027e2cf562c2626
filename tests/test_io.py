"""Readers and writers."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotledger import schemas
from lotledger.operators.relational import join_vehicles
from lotledger.session import materialise, new_location, shared_dir
from lotledger.sources import readers, writers


@pytest.fixture
def prices(spark):
    return spark.createDataFrame([(1, 100), (2, 300)], schemas.VEHICLES_PRICE)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_keeps_types_and_text(spark, tmp_path):
    row = (1, "수동", "보험사보증", "87,115km", "없음", "없음", "있음 / 렌트", "없음", None)
    df = spark.createDataFrame([row], schemas.VEHICLES_STATUS)
    writers.write_csv(df, f"{tmp_path}/s")
    back = readers.read_table(spark, f"{tmp_path}/s", schemas.VEHICLES_STATUS)
    assert back.schema == schemas.VEHICLES_STATUS and rows(back) == [row]


def test_missing_source_is_empty(spark, tmp_path, prices):
    for source in ("csv", "parquet"):
        empty = readers.read_or_empty(spark, f"{tmp_path}/none", schemas.VEHICLES_PRICE, source)
        assert empty.schema == schemas.VEHICLES_PRICE and empty.count() == 0
    writers.append_batch(prices, f"{tmp_path}/p")
    assert readers.read_or_empty(spark, f"{tmp_path}/p", schemas.VEHICLES_PRICE, "parquet").count() == 2


def test_save_table_overwrites(spark, tmp_path, prices):
    for _ in range(2):
        writers.save_table(prices, "saved_prices", path=f"{tmp_path}/t")
    assert rows(readers.read_catalog(spark, "saved_prices")) == [(1, 100), (2, 300)]
    spark.sql("DROP TABLE saved_prices")


def test_append_and_errors_once(spark, tmp_path, prices):
    for _ in range(2):
        writers.append_batch(prices, f"{tmp_path}/a")
        writers.append_errors(prices, f"{tmp_path}/e")
    assert readers.read_or_empty(spark, f"{tmp_path}/a", schemas.VEHICLES_PRICE, "parquet").count() == 4
    assert rows(readers.read_or_empty(spark, f"{tmp_path}/e", schemas.ERROR_IDS, "parquet")) == [(1,), (2,)]


def test_split_ok_error(spark):
    df = spark.createDataFrame([(1, True), (2, False), (2, False), (3, None)], "id long, is_ok boolean")
    good, bad = writers.split_ok_error(df)
    assert rows(good) == [(1,)] and rows(bad) == [(2,), (3,)]


def test_by_brand(spark, tmp_path):
    df = spark.createDataFrame([(1, "KIA"), (2, "KIA"), (3, "GENESIS")], "id long, brand string")
    writers.write_by_brand(df, f"{tmp_path}/b")
    assert {p.name for p in tmp_path.joinpath("b").iterdir() if p.is_dir()} == {"brand=KIA", "brand=GENESIS"}
    assert rows(spark.read.schema(df.schema).parquet(f"{tmp_path}/b")) == rows(df)


def test_rewrite_in_place(spark, tmp_path, prices):
    path = f"{tmp_path}/r"
    writers.append_batch(prices, path)
    stored = spark.read.schema(schemas.VEHICLES_PRICE).parquet(path)
    writers.rewrite_table(spark, stored.where("price > 200"), path)
    assert rows(spark.read.parquet(path)) == [(2, 300)]


def test_id_scan_reads_one_column(spark, tmp_path, prices):
    writers.append_batch(prices, f"{tmp_path}/i")
    ids = readers.read_ids(spark.read.parquet(f"{tmp_path}/i"))
    assert "ReadSchema: struct<id:bigint>" in ids._jdf.queryExecution().executedPlan().toString()


def test_scratch_follows_the_setting(spark, prices):
    assert new_location(spark, "x").startswith(shared_dir(spark))
    kept = materialise(prices, "t")
    assert rows(kept) == rows(prices) and kept.schema == prices.schema
    assert all(shared_dir(spark).removeprefix("file:") in f for f in kept.inputFiles())


def test_csv_columns_by_name_and_doubled_quotes(spark, tmp_path):
    (tmp_path / "swapped.csv").write_text('price,id\n999,38001407\n,2\nx,3\n', encoding="utf-8")
    schema = schemas.VEHICLES_PRICE
    assert [tuple(r) for r in readers.read_table(spark, str(tmp_path / "swapped.csv"), schema).collect()] == [
        (38001407, 999), (2, None), (3, None)]
    (tmp_path / "other.csv").write_text("id,price\n5,6\n", encoding="utf-8")
    both = readers.read_table(spark, [str(tmp_path / "swapped.csv"), str(tmp_path / "other.csv")], schema)
    assert (5, 6) in [tuple(r) for r in both.collect()]
    (tmp_path / "wrong.csv").write_text("id,cost\n5,6\n", encoding="utf-8")
    with pytest.raises(AnalysisException):
        readers.read_table(spark, str(tmp_path / "wrong.csv"), schema)
    texts = spark.createDataFrame([(1, 'a "b", c', None), (2, "x", 'q"')], "id long, license string, x string")
    writers.write_csv(texts, f"{tmp_path}/quoted")
    back = readers.read_table(spark, f"{tmp_path}/quoted", texts.schema)
    assert {r.id: (r.license, r.x) for r in back.collect()} == {r.id: (r.license, r.x) for r in texts.collect()}


def test_a_failed_swap_leaves_the_old_table(spark, tmp_path, prices, monkeypatch):
    path = f"{tmp_path}/kept"
    writers.append_batch(prices, path)
    stored = spark.read.parquet(path)
    with pytest.raises(Exception, match="divide|DIVIDE"):
        writers.rewrite_table(spark, stored.select(F.expr("id div (id - id)").alias("id"), "price"), path)
    assert rows(spark.read.parquet(path)) == rows(prices)


def test_another_header_in_a_folder_is_an_error(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.IntegerType())])
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a.csv").write_text("id,price\n1,10\n")
    (tmp_path / "t/b.csv").write_text("id,price\n2,20\n")
    assert sorted(map(tuple, readers.read_table(spark, str(tmp_path / "t"), schema).collect())) == [(1, 10), (2, 20)]
    (tmp_path / "t/b.csv").write_text("price,id\n7777,99\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_table(spark, str(tmp_path / "t"), schema).collect()
    # Given as paths of their own, each is read by its header.
    both = readers.read_table(spark, [str(tmp_path / "t/a.csv"), str(tmp_path / "t/b.csv")], schema)
    assert sorted(map(tuple, both.collect())) == [(1, 10), (99, 7777)]


def test_an_empty_folder_is_an_empty_table(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    (tmp_path / "none").mkdir()
    for source in ("csv", "parquet"):
        assert readers.read_or_empty(spark, str(tmp_path / "none"), schema, source).collect() == []


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    names = []
    for label, column in (("p", "price"), ("h", "model"), ("s", "mileage")):
        df = spark.createDataFrame([(i, i * 10) for i in range(500)] + [(None, 1)], f"id long, {column} long")
        names.append(f"bucketed_{label}")
        writers.save_bucketed(df, names[-1], "id", 4, f"{tmp_path}/{label}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_vehicles(*(readers.read_catalog(spark, n) for n in names))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 500 and joined.where("price <> model OR mileage <> price").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for n in names:
            spark.sql(f"DROP TABLE {n}")
