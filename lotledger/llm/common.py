"""What the operators of this subpackage share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Settings of every operator that runs Python in its tasks.

    Arrow batches are cut by bytes as well as by rows, so that very long texts do not add up.
    Tasks find this package where the driver did; on a cluster ship it with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Rows that no model may learn from: crc32 of the id as text is divisible by ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == 0


def bounded_sample(labels: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of the key; all rows if there are fewer.

    One count over the label table sets the share; which rows are taken does not depend on
    the layout of the table.
    """
    total = labels.count()
    if total <= bound:
        return labels
    share = int((1 << 30) * bound / total)
    return labels.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < share)
