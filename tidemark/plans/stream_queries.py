"""Registered streaming queries: each lands the input as files, runs the
stream with ``availableNow`` to completion and returns what its sink holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gate as gt
from ..operators import metrics as met
from ..sources import fixtures as fx
from ..streaming import jobs
from .oracle_views import with_views
from .registry import query


def _land_predictions(spark: SparkSession, base: str, paths: jobs.StreamPaths, copies: int = 1):
    p = fx.predictions(spark, base)
    for _ in range(copies):
        jobs.land_files(p, paths.source)
    return p.schema


_DAILY_SQL = """
SELECT date_trunc('day', scored_at) AS window_start,
       date_trunc('day', scored_at) + INTERVAL 1 DAY AS window_end, model_version,
       count(*) AS n_scored, CAST(0 AS BIGINT) AS n_null,
       round(sqrt(avg((actual_quantity - predicted_quantity) ^ 2)), 6) AS rmse,
       round(avg(abs(actual_quantity - predicted_quantity)), 6) AS mae,
       round(1 - sum((actual_quantity - predicted_quantity) ^ 2) / nullif(regr_syy(actual_quantity, actual_quantity), 0), 6) AS r2
FROM predictions GROUP BY 1, 2, model_version
HAVING date_trunc('day', scored_at) + INTERVAL 1 DAY <= (SELECT max(scored_at) FROM predictions) - INTERVAL 1 DAY"""


@query("stream_daily_metrics", with_views(_DAILY_SQL, "predictions"))
def q_stream_daily_metrics(spark: SparkSession, base: str) -> DataFrame:
    """T2s: 1-day windows x version from a file stream with a 1-day watermark;
    only windows the watermark has closed are emitted (append mode)."""
    paths = jobs.StreamPaths.fresh(spark, "daily")
    schema = _land_predictions(spark, base, paths)
    stream = jobs.read_stream(spark, paths.source, schema, "scored_at")
    jobs.run_available_now(jobs.daily_metric_stream(stream), paths.sink, paths.checkpoint)
    return jobs.finish_window_metrics(spark.read.parquet(paths.sink))


@query("stream_dedupe", with_views("""
SELECT model_version, count(DISTINCT transaction_id) AS n_rows, count(DISTINCT transaction_id) AS n_keys
FROM predictions GROUP BY model_version""", "predictions"))
def q_stream_dedupe(spark: SparkSession, base: str) -> DataFrame:
    """T5s: the same rows landed twice come out once."""
    paths = jobs.StreamPaths.fresh(spark, "dedupe")
    schema = _land_predictions(spark, base, paths, copies=2)
    stream = jobs.read_stream(spark, paths.source, schema, "scored_at")
    out = jobs.dedupe_stream(stream, ["transaction_id", "model_version"])
    jobs.run_available_now(out, paths.sink, paths.checkpoint)
    return spark.read.parquet(paths.sink).groupBy("model_version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("transaction_id").alias("n_keys"))


@query("stream_payload_counts", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS n_requests, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k
FROM events GROUP BY 1, 2
HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_payload_counts(spark: SparkSession, base: str) -> DataFrame:
    """T3s S9: request log rows processed as they land, parsed, counted per hour."""
    paths = jobs.StreamPaths.fresh(spark, "payload")
    p = fx.payload(spark, base)
    jobs.land_files(p, paths.source)
    stream = jobs.read_stream(spark, paths.source, p.schema, "arrival_time")
    jobs.run_available_now(jobs.payload_counts_stream(stream), paths.sink, paths.checkpoint)
    return spark.read.parquet(paths.sink).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n_requests", "sum_k")


@query("stream_incremental", with_views("""
SELECT model_version, count(*) AS n_scored, CAST(0 AS BIGINT) AS n_null,
       round(sqrt(avg((actual_quantity - predicted_quantity) ^ 2)), 6) AS rmse,
       round(avg(abs(actual_quantity - predicted_quantity)), 6) AS mae,
       round(1 - sum((actual_quantity - predicted_quantity) ^ 2) / nullif(regr_syy(actual_quantity, actual_quantity), 0), 6) AS r2
FROM predictions GROUP BY model_version""", "predictions"))
def q_stream_incremental(spark: SparkSession, base: str) -> DataFrame:
    """T1s K4: two scheduled runs over a growing folder; the second run reads
    only the new files; merged per-batch states equal the batch metrics."""
    paths = jobs.StreamPaths.fresh(spark, "incremental")
    p = fx.predictions(spark, base)
    early = F.col("scored_at") < F.lit("1998-01-01").cast("timestamp_ntz")
    jobs.land_files(p.filter(early), paths.source)
    stream = jobs.read_stream(spark, paths.source, p.schema)
    jobs.incremental_metric_states(spark, stream, paths.sink, paths.checkpoint, ["model_version"])
    jobs.land_files(p.filter(~early), paths.source)
    stream = jobs.read_stream(spark, paths.source, p.schema)
    jobs.incremental_metric_states(spark, stream, paths.sink, paths.checkpoint, ["model_version"])
    return met.merge_metric_states(spark.read.parquet(paths.sink), ["model_version"])


@query("stream_change_rows", with_views("""
SELECT model_version, count(*) AS n_scored, CAST(0 AS BIGINT) AS n_null,
       round(sqrt(avg((actual_quantity - predicted_quantity) ^ 2)), 6) AS rmse,
       round(avg(abs(actual_quantity - predicted_quantity)), 6) AS mae,
       round(1 - sum((actual_quantity - predicted_quantity) ^ 2) / nullif(regr_syy(actual_quantity, actual_quantity), 0), 6) AS r2
FROM predictions WHERE scored_at <= TIMESTAMP '1997-01-01 00:00:00' GROUP BY model_version""", "predictions"))
def q_stream_change_rows(spark: SparkSession, base: str) -> DataFrame:
    """K4 T1s: inserts and, after a reset, deletes arrive as signed rows; the net states equal the metrics of the rows left."""
    paths = jobs.StreamPaths.fresh(spark, "changes")
    p = fx.predictions(spark, base)
    reset = F.col("scored_at") > F.lit("1997-01-01").cast("timestamp_ntz")
    write = jobs.state_writer(paths.sink, lambda rows: met.metric_states(rows, ["model_version", "change"]))
    for rows, sign in ((p, 1), (p.filter(reset), -1)):
        signed = rows.withColumn("change", F.lit(sign))
        jobs.land_files(signed, paths.source)
        jobs.run_batches(jobs.read_stream(spark, paths.source, signed.schema), write, paths.checkpoint)
    return met.net_metric_states(spark.read.parquet(paths.sink), ["model_version"])


_LATE_CUT = "2024-01-15 00:00:00"


@query("late_rows", f"""
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, ts FROM events),
     wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS watermark FROM events WHERE ts >= TIMESTAMP '{_LATE_CUT}')
SELECT count(*) FILTER (WHERE ts >= TIMESTAMP '{_LATE_CUT}' AND window_end <= watermark) AS n_streamed,
       count(*) FILTER (WHERE ts < TIMESTAMP '{_LATE_CUT}' AND window_end <= watermark) AS n_late,
       count(*) FILTER (WHERE window_end > watermark) AS n_open
FROM w, wm""")
def q_late_rows(spark: SparkSession, base: str) -> DataFrame:
    """T6s: the second half of the log lands first; the older half arrives
    in a later run, after the watermark has passed it, and is dropped.  The
    batch reconcile splits all rows into streamed / late / still-open."""
    paths = jobs.StreamPaths.fresh(spark, "late")
    p = fx.payload(spark, base)
    cut = F.lit(_LATE_CUT).cast("timestamp_ntz")

    def run() -> str | None:
        stream = jobs.read_stream(spark, paths.source, p.schema, "arrival_time")
        counted = (stream.withWatermark("arrival_time", "1 hour")
                   .groupBy(F.window("arrival_time", "1 hour").alias("w"))
                   .agg(F.count(F.lit(1)).alias("n")))
        q = jobs.run_available_now(counted, paths.sink, paths.checkpoint)
        prog = q.lastProgress or {}
        return (prog.get("eventTime") or {}).get("watermark")

    jobs.land_files(p.filter(F.col("arrival_time") >= cut), paths.source)
    run()
    jobs.land_files(p.filter(F.col("arrival_time") < cut), paths.source)
    watermark = run()
    if watermark:
        wm = F.to_timestamp(F.lit(watermark)).cast("timestamp_ntz")
    else:  # no progress report: the watermark by definition (max on-time time - delay)
        wm = F.lit(p.filter(F.col("arrival_time") >= cut).agg(F.max("arrival_time")).first()[0]) \
            - F.expr("INTERVAL 1 HOUR")
    per_window = p.groupBy(F.window(F.col("arrival_time").cast("timestamp"), "1 hour").alias("w")) \
        .agg(F.count(F.lit(1)).alias("n_all"))
    streamed = spark.read.parquet(paths.sink)
    rec = per_window.join(streamed, "w", "left").select(
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n_all",
        F.coalesce(F.col("n"), F.lit(0)).alias("n"))
    closed = F.col("window_end") <= wm
    return rec.agg(
        F.sum(F.when(closed, F.col("n")).otherwise(0)).cast("long").alias("n_streamed"),
        F.sum(F.when(closed, F.col("n_all") - F.col("n")).otherwise(0)).cast("long").alias("n_late"),
        F.sum(F.when(~closed, F.col("n_all")).otherwise(0)).cast("long").alias("n_open"))


@query("stream_gate_6h", with_views(f"""
SELECT * FROM (
  SELECT experiment_id, window_start, window_end,
         CASE WHEN isnan(batch_rmse) THEN NULL ELSE batch_rmse END AS latest_rmse,
         CASE WHEN isnan(batch_r2) THEN NULL ELSE batch_r2 END AS latest_r2,
         coalesce(batch_rmse > 5.0, false) AS rmse_breach, coalesce(batch_r2 < 0.5, false) AS r2_breach,
         coalesce(batch_rmse > 5.0, false) OR coalesce(batch_r2 < 0.5, false) AS retrain_needed,
         CASE WHEN coalesce(batch_rmse > 5.0, false) THEN 'BREACH' ELSE 'OK' END AS rmse_status,
         CASE WHEN coalesce(batch_r2 < 0.5, false) THEN 'BREACH' ELSE 'OK' END AS r2_status
  FROM (SELECT r.experiment_id, time_bucket(INTERVAL 6 HOUR, m.metric_time) AS window_start,
               time_bucket(INTERVAL 6 HOUR, m.metric_time) + INTERVAL 6 HOUR AS window_end,
               arg_max(m.metric_value, (m.metric_time, m.run_id)) FILTER (WHERE m.metric_name = 'batch_rmse') AS batch_rmse,
               arg_max(m.metric_value, (m.metric_time, m.run_id)) FILTER (WHERE m.metric_name = 'batch_r2') AS batch_r2
        FROM metrics m JOIN runs r ON m.run_id = r.run_id
        WHERE m.metric_name IN ('batch_rmse', 'batch_r2') GROUP BY 1, 2, 3) w) g
WHERE window_end <= (SELECT max(metric_time) FROM metrics WHERE metric_name IN ('batch_rmse', 'batch_r2'))
                    - INTERVAL 6 HOUR""", "metrics", "runs"))
def q_stream_gate_6h(spark: SparkSession, base: str) -> DataFrame:
    """T4s: one gate row per experiment and closed 6-hour window, from a
    metric-point stream joined to the static run table."""
    paths = jobs.StreamPaths.fresh(spark, "gate6h")
    pts = fx.metrics(spark, base, with_step=False)
    jobs.land_files(pts, paths.source)
    stream = jobs.read_stream(spark, paths.source, pts.schema, "metric_time")
    jobs.run_available_now(jobs.gate_window_stream(stream, fx.runs(spark, base)),
                           paths.sink, paths.checkpoint)
    closed = spark.read.parquet(paths.sink).select(
        "experiment_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "batch_rmse", "batch_r2")
    return gt.evaluate(closed, keep=["experiment_id", "window_start", "window_end"])
