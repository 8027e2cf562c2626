"""Table writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotledger.sources.readers import read_or_empty


def save_table(df: DataFrame, name: str, path: str | None = None, source: str = "parquet") -> None:
    """Overwrite a catalog table; with ``path`` its files are kept there."""
    writer = df.write.format(source).mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Overwrite a catalog table in buckets of ``key``, each one file and sorted.

    Tables with the same number of buckets join on the key without an exchange. The one shuffle is
    by the key, so a key should not hold more rows than a task can write.
    """
    writer = df.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV folder, each part with a header."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(path)


def append_batch(df: DataFrame, path: str) -> None:
    """Append rows to a Parquet table."""
    df.write.mode("append").parquet(path)


def split_ok_error(df: DataFrame, ok: str = "is_ok", key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Good rows, and the distinct ids of the rest."""
    good = df.where(F.col(ok)).drop(ok)
    bad = df.where(~F.coalesce(F.col(ok), F.lit(False))).select(key).distinct()
    return good, bad


def append_errors(errors: DataFrame, path: str, key: str = "id") -> None:
    """Append the failed ids that are not recorded yet."""
    fresh = errors.select(key).distinct()
    known = read_or_empty(errors.sparkSession, path, fresh.schema, "parquet").distinct()
    append_batch(fresh.join(known, key, "left_anti"), path)


def write_by_brand(df: DataFrame, path: str, brand: str = "brand") -> None:
    """One folder per brand.

    The rebalance hint gathers each brand into few files; adaptive execution cuts a brand
    too large for one task into several.
    """
    df.hint("rebalance", brand).write.mode("overwrite").partitionBy(brand).parquet(path)


def rewrite_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace the Parquet table ``df`` was read from.

    The new rows are written once, beside the table, and the folders are then swapped by renames.
    Until the swap the old table is what readers see; if it fails half-way, the old folder is put
    back. The old rows go when the new ones are in place.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, fresh, old = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}{tail}") for tail in ("", f".new-{uuid.uuid4().hex}", f".old-{uuid.uuid4().hex}"))
    df.write.parquet(fresh.toString())
    files = target.getFileSystem(conf)
    if not files.rename(target, old):
        raise OSError(f"cannot move {path} aside; the new rows are in {fresh}")
    if not files.rename(fresh, target):
        files.rename(old, target)
        raise OSError(f"cannot put new rows in place of {path}; they are in {fresh}")
    files.delete(old, True)
