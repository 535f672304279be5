"""Incremental ingest and per-batch scoring (ST1-ST3).

- ST1: a file-source stream with a checkpoint replaces the upload manifest:
  each file is processed exactly once; a rerun finds nothing new.
- ST2: hourly readings -> per-customer daily tier sums with a watermark, so
  state is bounded and late data is accepted up to the delay.  Calendar
  months are summed from days in batch (``monthly_from_daily``), since event
  time windows have no month unit.
- ST3: ``foreachBatch`` applies any batch function (scoring, drift) to each
  micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltchurn.constants import KEY, TIERS
from voltchurn.functions.exprs import clip_lower0, tariff_tier


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """ST1 source: files under ``path`` (a directory or glob) as a stream, explicit schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def ingest_once(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                partition_by=None) -> int:
    """ST1: append every new input row to ``sink_path`` once; returns the number of batches run.

    ``trigger(availableNow=True)`` processes what is there and stops; the
    checkpoint remembers which files were seen.
    """
    w = stream.writeStream.format(fmt).option("path", sink_path).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return len(q.recentProgress)


def daily_tier_sums(readings: DataFrame, delay: str = "1 day", ts_col: str = "timestamp",
                    elec_col: str = "consumption_elec_kwh", gas_col: str = "consumption_gas_m3") -> DataFrame:
    """ST2: per customer and day: electricity kWh per tariff tier and gas m3, watermarked.

    Event time must be TIMESTAMP (not TIMESTAMP_NTZ) for a watermark; the
    session time zone is UTC, so the wall-clock value is kept.
    """
    ts = F.col(ts_col).cast("timestamp")
    r = readings.select(F.col(KEY).cast("string").alias(KEY), ts.alias("event_time"),
                        clip_lower0(F.col(elec_col).cast("double")).alias("elec"),
                        clip_lower0(F.col(gas_col).cast("double")).alias("gas"))
    r = r.filter(F.col(KEY).isNotNull() & (F.col(KEY) != "") & F.col("event_time").isNotNull())
    r = r.withColumn("tier", tariff_tier(F.col("event_time").cast("timestamp_ntz")))
    aggs = [F.coalesce(F.sum("elec"), F.lit(0.0)).alias("elec_kwh"),
            F.coalesce(F.sum("gas"), F.lit(0.0)).alias("gas_m3")]
    aggs += [F.coalesce(F.sum(F.when(F.col("tier") == t, F.col("elec")).otherwise(0.0)), F.lit(0.0))
             .alias(f"elec_kwh_{t}") for t in TIERS]
    g = r.withWatermark("event_time", delay).groupBy(KEY, F.window("event_time", "1 day").alias("w")).agg(*aggs)
    return g.select(KEY, F.col("w.start").cast("date").alias("day"), "elec_kwh", "gas_m3",
                    *[f"elec_kwh_{t}" for t in TIERS])


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    """Batch roll-up of closed daily windows to calendar months."""
    sums = [c for c in daily.columns if c not in (KEY, "day")]
    return daily.groupBy(KEY, F.date_format("day", "yyyy-MM").alias("month")).agg(
        *[F.sum(c).alias(c) for c in sums])


def run_to_files(stream: DataFrame, keys: Sequence[str], sink_path: str, checkpoint: str) -> DataFrame:
    """Run a streaming aggregate over all available input; its last value of every key.

    Update mode: each micro-batch writes the groups it changed, open or closed,
    to a folder of its own (a repeated batch overwrites it); the newest batch
    of a key holds its value.  Nothing passes through the driver.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    q = (stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    values = [c for c in stream.columns if c not in keys]
    schema = T.StructType(stream.schema.fields + [T.StructField("batch", T.LongType())])
    written = stream.sparkSession.read.schema(schema).parquet(sink_path)
    newest = written.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"last.{c}").alias(c) for c in stream.columns])


def for_each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """ST3: call ``fn(batch_df, batch_id)`` on every micro-batch of newly arrived rows."""
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


COUNTS = "feature string, value double, n long, batch long"


class DriftState:
    """ST3: value counts of a stream so far, and the drift they show, one folder per batch.

    A batch adds its counts to those of the newest batch before it, so a batch
    that is repeated after a failure finds the same state and overwrites its own
    folders: nothing is counted twice.  The reference's counts are kept beside.
    """

    def __init__(self, spark: SparkSession, base: str, reference: DataFrame | None = None, exact: bool = True):
        from voltchurn.plans import drift

        self.base, self.exact, self._drift = base, exact, drift
        if reference is not None:
            drift.value_counts_long(reference).write.mode("overwrite").parquet(f"{base}/reference")

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The counts that the newest batch before ``batch_id`` left."""
        from voltchurn.sources.io import path_exists

        if not path_exists(spark, f"{self.base}/counts"):
            return spark.createDataFrame([], COUNTS)
        states = spark.read.schema(COUNTS).parquet(f"{self.base}/counts").where(F.col("batch") < batch_id)
        newest = states.agg(F.max("batch")).first()[0]
        return states.where(F.col("batch") == F.lit(newest))

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Adds one micro-batch of (feature, value) rows and writes the drift of all rows so far."""
        spark = batch.sparkSession
        added = self._drift.value_counts_long(batch)
        total = self.before(spark, batch_id).select("feature", "value", "n").unionByName(added) \
            .groupBy("feature", "value").agg(F.sum("n").alias("n"))
        total.write.mode("overwrite").parquet(f"{self.base}/counts/batch={batch_id}")
        current = spark.read.schema("feature string, value double, n long").parquet(f"{self.base}/counts/batch={batch_id}")
        report = self._drift.drift_of_counts(spark.read.parquet(f"{self.base}/reference"), current, exact=self.exact)
        report.write.mode("overwrite").parquet(f"{self.base}/reports/batch={batch_id}")

    def reports(self, spark: SparkSession) -> DataFrame:
        """The drift report of every batch, with ``batch``."""
        return spark.read.parquet(f"{self.base}/reports")


def drift_stream(stream: DataFrame, reference: DataFrame, base: str, exact: bool = True) -> DataFrame:
    """ST3: drift of a stream of (feature, value) rows against a reference, batch by batch; the last report.

    Equal to the batch job over all rows that have arrived.
    """
    state = DriftState(stream.sparkSession, base, reference, exact)
    for_each_batch(stream, state.update, f"{base}/checkpoint")
    reports = state.reports(stream.sparkSession)
    return reports.where(F.col("batch") == reports.agg(F.max("batch")).scalar()).drop("batch")
