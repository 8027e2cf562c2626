"""The first rows of a table in some order, selected by counts of ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotledger.session import materialise, new_location

#: Up to so many rows it pays that each task drops what cannot be among them.
TASK_ROWS = 1 << 17


def _first_of_each_task(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """The first ``rows`` rows of every task's input; no shuffle."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    return df.sortWithinPartitions(*order).withColumn("__place", place).where(F.col("__place") < rows).drop("__place")


def first_rows(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """The first ``rows`` rows in ``order``, as a set; of rows tied at the end a hash of the row decides.

    Candidates are stored, dealt out over as many ranges of the order as the session has shuffle
    partitions, and stored sorted, one file a range. A count for each range tells in which one
    the cap ends: earlier ranges are read whole, of that one the rows before the cut, later
    ones not at all. No task sees more than a range; copies of a row are spread over ranges.
    """
    spark = df.sparkSession
    if rows <= 0:
        return df.limit(0)
    tied = df.withColumn("__tie", F.xxhash64(*df.columns))
    order = [*order, "__tie"]
    # Stored first, so that the numbers that tell copies apart stay the same if a task runs again.
    candidates = materialise(_first_of_each_task(tied, order, rows) if rows <= TASK_ROWS else tied, "cap-candidates")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        candidates.withColumn("__copy", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *order, "__copy")
        .withColumn("__range", F.spark_partition_id())
        .sortWithinPartitions("__range", *order, "__copy")
    )
    path = new_location(spark, "cap-ranges")
    dealt.write.option("maxRecordsPerFile", 0).partitionBy("__range").parquet(path)
    schema = T.StructType([f for f in dealt.schema.fields if f.name != "__range"] + [T.StructField("__range", T.IntegerType())])
    stored = spark.read.schema(schema).parquet(path)
    left, last = rows, -1
    for row in sorted(stored.groupBy("__range").count().collect()):  # one row a range
        last = row["__range"]
        if row["count"] >= left:
            break
        left -= row["count"]
    cut = (F.col("__range") < last) | ((F.col("__range") == last) & (F.col("_metadata.row_index") < left))
    return stored.where(cut).select(*df.columns)
