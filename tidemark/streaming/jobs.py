"""Structured Streaming twins of the batch monitors.

Sources are Parquet folders (new files = new rows), state and progress live
in a checkpoint folder under the shared checkpoint root, so a restarted or
re-run job continues where it stopped and a lost executor only re-runs its
tasks.  ``trigger(availableNow=True)`` processes everything present and
stops, which is how a scheduled job (the 6-hourly watcher) drives a stream.

Event times from Parquet files written without a zone load as
TIMESTAMP_NTZ; watermarks need TIMESTAMP, so they are cast (session zone
UTC) on the way in and back to TIMESTAMP_NTZ on the way out.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.metrics import metric_sums, metrics_from_sums
from ..operators.metrics import METRIC_COLS
from ..session import scratch_path


@dataclass
class StreamPaths:
    source: str
    sink: str
    checkpoint: str

    @classmethod
    def fresh(cls, spark: SparkSession, name: str) -> "StreamPaths":
        root = scratch_path(spark, f"stream-{name}")
        return cls(os.path.join(root, "source"), os.path.join(root, "sink"),
                   os.path.join(root, "checkpoint"))


def land_files(df: DataFrame, folder: str) -> None:
    """Append a batch of rows as new files (what an upstream writer does)."""
    df.write.mode("append").parquet(folder)


def read_stream(spark: SparkSession, folder: str, schema: T.StructType,
                time_col: str | None = None) -> DataFrame:
    stream = spark.readStream.schema(schema).parquet(folder)
    if time_col is not None:
        stream = stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return stream


def run_available_now(df: DataFrame, sink: str, checkpoint: str, mode: str = "append"):
    """Process everything present, then stop; returns the finished query."""
    q = (df.writeStream.format("parquet").outputMode(mode)
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def daily_metric_stream(scored: DataFrame, delay: str = "1 day", duration: str = "1 day",
                        keys: tuple[str, ...] = ("model_version",)) -> DataFrame:
    """Tumbling-window metric sums per version; a window is emitted once the
    watermark passes its end (append mode), then never changes."""
    return (scored.withWatermark("scored_at", delay)
            .groupBy(F.window("scored_at", duration).alias("w"), *keys)
            .agg(*metric_sums()))


def finish_window_metrics(sink_rows: DataFrame, keys: tuple[str, ...] = ("model_version",)) -> DataFrame:
    return sink_rows.withColumns(metrics_from_sums()).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, *METRIC_COLS)


def dedupe_stream(scored: DataFrame, keys: list[str], delay: str = "1 day") -> DataFrame:
    """Drop re-appended copies of a row (same keys) seen within the watermark."""
    return scored.withWatermark("scored_at", delay).dropDuplicatesWithinWatermark(keys)


def payload_counts_stream(payload: DataFrame, period: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    parsed = payload.withColumn("k", F.from_json("request", "k INT")["k"])
    return (parsed.withWatermark("arrival_time", delay)
            .groupBy(F.window("arrival_time", period).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_requests"), F.sum("k").cast("long").alias("sum_k")))


def incremental_metric_states(spark: SparkSession, scored: DataFrame, state_path: str,
                              checkpoint: str, keys: list[str]) -> None:
    """Each trigger aggregates only the rows that arrived since the last one
    and appends its sum state, tagged with the batch id, to ``state_path``.

    A batch id already present is skipped, so a batch replayed after a
    failure is not counted twice.  The state table is partitioned by batch id,
    so that check reads one (usually absent) partition, not the history.
    """

    def already_written(batch_id: int) -> bool:
        try:
            done = spark.read.parquet(state_path).filter(F.col("batch_id") == batch_id)
            return done.limit(1).count() > 0
        except AnalysisException:  # no state written yet
            return False

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if already_written(batch_id):
            return
        states = batch.groupBy(*keys).agg(*metric_sums()).withColumn("batch_id", F.lit(batch_id))
        states.write.mode("append").partitionBy("batch_id").parquet(state_path)

    q = (scored.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def state_writer(path: str, make_states):
    """A ``foreachBatch`` function that stores ``make_states(rows)`` of a batch under its batch id.

    The batch's folder is overwritten, so a batch that is replayed after a
    failure, also one that had been written in full, is counted once.  A batch
    without rows leaves no folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        states = make_states(batch)
        if not batch.isEmpty():
            states.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def run_batches(stream: DataFrame, write, checkpoint: str) -> None:
    """Hand everything present to ``write`` in batches, then stop."""
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def gate_window_stream(metric_points: DataFrame, runs: DataFrame, period: str = "6 hours",
                       delay: str = "6 hours") -> DataFrame:
    """Watcher cadence as data: per experiment and ``period`` window, the
    newest batch_rmse / batch_r2 point (stream-static join to the run table
    for the experiment).  Closed windows are emitted once (append mode)."""
    names = ("batch_rmse", "batch_r2")
    pts = (metric_points.filter(F.col("metric_name").isin(*names))
           .join(runs.select("run_id", "experiment_id"), "run_id", "inner")
           .withWatermark("metric_time", delay))
    order = F.struct(F.col("metric_time"), F.col("run_id"))
    return pts.groupBy(F.window("metric_time", period).alias("w"), "experiment_id").agg(
        *[F.max_by(F.when(F.col("metric_name") == n, F.col("metric_value")),
                   F.when(F.col("metric_name") == n, order)).alias(n) for n in names])
