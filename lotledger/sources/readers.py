"""Typed readers."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotledger.schemas import PAGES


def _scan(spark: SparkSession, paths: list[str], schema: T.StructType, *extra: Column) -> DataFrame:
    """Columns by the names in each path's header; a missing name is an error, a bad value is null.

    Files of one path are held to the header that was found first.
    """
    def one(path: str) -> DataFrame:
        reader = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"')
        texts = reader.schema(reader.csv(path).schema).option("enforceSchema", False).csv(path)
        return texts.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields], *extra)

    return reduce(DataFrame.unionByName, map(one, paths))


def read_table(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """UTF-8 CSV with a header, read with a given schema instead of a guess.

    Columns are matched by name, so their order in a file does not matter. Files of one path have
    one header; reading one with another header or column order is an error. Quotes within quoted
    values are doubled.
    """
    return _scan(spark, [path] if isinstance(path, str) else path, schema)


def read_ids(df: DataFrame, key: str = "id") -> DataFrame:
    """Only the key column; the scan reads nothing else."""
    return df.select(key)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_brand_files(
    spark: SparkSession, paths: list[str], schema: T.StructType, brand_pattern: str = r"([^_/]+)\.csv$"
) -> DataFrame:
    """Per-brand CSV files, with the brand taken from the file's path."""
    brand = F.upper(F.regexp_extract(F.col("_metadata.file_path"), brand_pattern, 1))
    return _scan(spark, paths, schema, brand.alias("brand"))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, source: str = "csv") -> DataFrame:
    """The table at ``path``, or an empty one when nothing has been written there yet.

    A folder without files, as an interrupted writer leaves it, is empty too.
    """
    try:
        if source == "csv":
            return read_table(spark, path, schema)
        return spark.read.schema(schema).format(source).load(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw pages kept as Parquet rows of ``page_id, url, html``."""
    return spark.read.schema(PAGES).parquet(path)
