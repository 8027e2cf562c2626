"""Resumable collection over a stream of report pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lotledger.operators.id_sets import rows_outside, split_full
from lotledger.plans import jobs
from lotledger.schemas import ERROR_IDS
from lotledger.session import discard, materialise
from lotledger.sources.writers import split_ok_error

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Counting its rows for a metric costs the store one more look-up for every row it is given.
ROW_METRIC = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
_BEFORE = "timestamp_seconds(0)"
_COUNTED = T.StructType([T.StructField("stored", T.LongType())])
_RANGES = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType())])


def _store_known(done: DataFrame, failed: DataFrame, root: str) -> None:
    """Ids stored or failed before the first run, kept once batches are planned.

    Those in well filled ranges are bitmaps, by which their pages are left out where they are
    scanned; the others are the first source of the state.
    """
    spark = done.sparkSession
    planned = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/progress/offsets")
    if not planned.getFileSystem(spark._jsc.hadoopConfiguration()).exists(planned):
        known = materialise(done.select("id").unionAll(failed.select("id")).distinct(), "known-ids")
        ranges, others = split_full(known)
        ranges.write.mode("overwrite").parquet(f"{root}/ranges")
        others.write.mode("overwrite").parquet(f"{root}/known")
        discard(known)


def _first_seen(pages: DataFrame, root: str) -> DataFrame:
    """Per id the time of the first batch that had it, its best row in that batch, and the last time.

    Fields are extracted where pages are read, so that only short rows reach the state, and only
    from ids that are not known. Known ids that are no bitmaps, all of them in the first batch,
    count as seen before any page. A row that lacks a field fails whatever its others are: they
    are not looked for where a page is missing, and do not go into the state.
    """
    spark = pages.sparkSession
    both = F.col("inspection").isNotNull() & F.col("accident").isNotNull()
    unknown = rows_outside(pages, F.broadcast(spark.read.schema(_RANGES).parquet(f"{root}/ranges")))
    fields = jobs.report_pair_fields(unknown.withColumns({c: F.when(both, F.col(c)) for c in ("inspection", "accident")}))
    names = [c for c in fields.columns if c != "id"]
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
    arrived = fields.select(
        "id", F.current_timestamp().alias("arrived"), (~complete).cast("int").alias("missing"), *[F.when(complete, F.col(c)).alias(c) for c in names])
    known = spark.readStream.schema(ERROR_IDS).parquet(f"{root}/known").select(
        "id", F.expr(_BEFORE).alias("arrived"), F.lit(0).alias("missing"), *[F.lit(None).cast("string").alias(c) for c in names])
    return known.unionAll(arrived).groupBy("id").agg(
        F.min(F.struct("arrived", "missing", *names)).alias("first"), F.max("arrived").alias("last"))


def collect_stream(
    pages: DataFrame, prices: DataFrame, done: DataFrame, failed: DataFrame, root: str, price_order: tuple[str, ...],
    target: int | None = None,
) -> StreamingQuery:
    """Collect streamed report pages once per id, good rows and failed ids apart.

    ``pages`` rows are ``id, inspection, accident``, a page being null when it was not
    disclosed. Which ids have been seen is keyed state in a RocksDB store beside the progress
    of the stream; ids stored or failed before the first run are its first source, later runs
    take both from the state. A batch reads its own pages, no output of earlier batches; with
    a ``target`` also the one number that the batch before it left.

    ``foreachBatch`` may run a batch again after a failure: the state of a batch and its time
    are kept with its number, each batch owns one folder of each output and overwrites it, so
    a repeated batch gives the same rows and no id is stored twice. The session's shuffle width
    at the first run is that of the state for good.
    """
    spark = pages.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set(ROW_METRIC, "false")
    _store_known(done, failed, root)
    names = jobs.report_pair_fields(pages).columns[1:]

    def stored_before(number: int) -> int:
        if number == 0:
            return done.select("id").distinct().count()
        return spark.read.schema(_COUNTED).parquet(f"{root}/counted/batch={number - 1}").first()[0]

    def one_batch(batch: DataFrame, number: int) -> None:
        # The state also gives out ids that were known or seen before.
        fresh = batch.where(f"first.arrived > {_BEFORE} AND first.arrived = last")
        read = jobs.collected_fields(fresh.select("id", *[F.col("first")[c].alias(c) for c in names]))
        good, bad = split_ok_error(materialise(read, "stream-batch"))
        if target is not None:
            stored = stored_before(number)
            good, bad = jobs.up_to_target(good, bad, max(0, target - stored))
            total = good.agg((F.count("*") + stored).alias("stored"))
            total.write.mode("overwrite").parquet(f"{root}/counted/batch={number}")
        rows = jobs.store_prices(good, prices, price_order)
        rows.write.mode("overwrite").parquet(f"{root}/collected/batch={number}")
        bad.write.mode("overwrite").parquet(f"{root}/failed/batch={number}")

    return (
        _first_seen(pages, root).writeStream.outputMode("update").foreachBatch(one_batch)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )
