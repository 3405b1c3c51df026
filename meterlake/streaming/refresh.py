"""Vendor-day summary kept up to date from a stream of trips.

The state of a day is what its figures are made of: exact sums in whole units and counts, per vendor. States merge, so a
micro-batch adds its own sums to what is there, and no trip is kept or read again. On disk there are

* ``deltas/slot=…``: the sums of each recent batch, tagged with its id, in a ring of ``2 * KEEP`` folders. A repeated batch replaces itself.
* ``days/metric_date=…``: the merged state of a day and ``upto``, the last batch merged into it. Every ``KEEP`` batches the days
  that were touched are merged and rewritten. Deltas up to ``upto`` no longer count for that day, so a merge that is cut off
  half-way, or run twice, counts nothing twice.

A day has one merged folder and the deltas of at most ``2 * KEEP`` batches, however long the stream runs. Late trips need no watermark: they
add to their day. Trips without a pickup time belong to no day; they are merged under a NULL day and can be counted with :func:`undated`.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlake.plans.summaries import VENDOR_STATE, vendor_figures, vendor_state
from meterlake.sinks.lake import write_partitioned

KEEP = 16
STATE = ", ".join(["metric_date date", "vendor_id int", *[f"{c} decimal(38,0)" for c in VENDOR_STATE]])


def trip_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet trip files as they land."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .parquet(path)
    )


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the store, empty before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def deltas(spark: SparkSession, store: str) -> DataFrame:
    return _stored(spark, f"{store}/deltas", f"{STATE}, batch bigint, slot int").drop("slot")


def days(spark: SparkSession, store: str) -> DataFrame:
    return _stored(spark, f"{store}/days", f"{STATE}, upto bigint")


def store_batch(batch: DataFrame, batch_id: int, store: str, keep: int = KEEP) -> None:
    """The sums of one micro-batch in its slot of the ring."""
    sums = vendor_state(batch).withColumns({"batch": F.lit(batch_id).cast("bigint"), "slot": F.lit(batch_id % (2 * keep))})
    sums.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(f"{store}/deltas")


def _open(spark: SparkSession, store: str, upto: int) -> DataFrame:
    """The deltas up to a batch that are not yet merged into their day."""
    merged = days(spark, store).select(F.col("metric_date").alias("_day"), "upto").groupBy("_day").agg(F.max("upto").alias("upto"))
    recent = deltas(spark, store).filter(F.col("batch") <= upto)
    both = recent.join(merged, F.col("metric_date").eqNullSafe(F.col("_day")), "left")
    return both.filter(F.col("upto").isNull() | (F.col("batch") > F.col("upto"))).drop("_day", "upto")


def merged_state(spark: SparkSession, store: str, upto: int, touched_by: int | None = None) -> DataFrame:
    """The state of each day and vendor after batch ``upto``: of all days, or of those that batches after ``touched_by`` touched."""
    new = _open(spark, store, upto)
    base = days(spark, store).drop("upto")
    if touched_by is not None:
        # days of a few batches: few rows, whatever the history
        wanted = deltas(spark, store).filter((F.col("batch") > touched_by) & (F.col("batch") <= upto)).select(F.col("metric_date").alias("_day")).distinct()
        new, base = (df.join(F.broadcast(wanted), F.col("metric_date").eqNullSafe(F.col("_day")), "left_semi") for df in (new, base))
    every = new.drop("batch").unionByName(base)
    sums = [F.sum(c).cast("decimal(38,0)").alias(c) for c in VENDOR_STATE]
    return every.groupBy("metric_date", "vendor_id").agg(*sums)


def merge_days(spark: SparkSession, store: str, upto: int, keep: int = KEEP) -> None:
    """Merge the open deltas into their days; days without any stay as they are."""
    state = merged_state(spark, store, upto, touched_by=upto - 2 * keep)
    write_partitioned(state.withColumn("upto", F.lit(upto).cast("bigint")), f"{store}/days", ("metric_date",))


def refresh_days(spark: SparkSession, batch_id: int, store: str, vendors: DataFrame, summary: str) -> None:
    """Replace the summary partitions of every day the batch touched."""
    state = merged_state(spark, store, batch_id, touched_by=batch_id - 1).filter(F.col("metric_date").isNotNull())
    write_partitioned(vendor_figures(state, vendors, refresh_type="INCREMENTAL"), summary, ("metric_date",))


def undated(spark: SparkSession, store: str) -> int:
    """Trips so far without a pickup time."""
    last = deltas(spark, store).agg(F.max("batch")).first()[0]
    found = merged_state(spark, store, last if last is not None else -1).filter(F.col("metric_date").isNull()).agg(F.sum("n")).first()[0]
    return int(found or 0)


def start_vendor_refresh(
    stream: DataFrame,
    store: str,
    summary: str,
    vendors: DataFrame,
    checkpoint: str,
    available_now: bool = False,
    interval: str = "15 minutes",
    keep: int = KEEP,
) -> StreamingQuery:
    """Run the refresh per micro-batch, every ``interval`` or once over what is there."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store_batch(batch, batch_id, store, keep)
        refresh_days(spark, batch_id, store, vendors, summary)
        if batch_id % keep == keep - 1:
            merge_days(spark, store, batch_id, keep)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
