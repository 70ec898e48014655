"""Registered drift, payload, sink and run-log-append queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CATEGORICAL_COLS, DRIFT_TAG, NUMERIC_COLS
from ..operators import drift as dr
from ..operators import metrics as met
from ..operators import perturb as pert
from ..operators import runlog as rl
from ..operators import sinks as sk
from ..operators import split as spl
from ..session import materialize, scratch_path
from ..sources import fixtures as fx
from ..sources.tables import read_table
from .batch_queries import _PERTURB_SQL, _split_view, features
from .oracle_views import with_views
from .registry import query


def _long_sql(src_base: str, src_cur: str, cols: list[str], cast: str) -> str:
    parts = []
    for src, flag in ((src_base, "false"), (src_cur, "true")):
        for c in cols:
            parts.append(f"SELECT '{c}' AS column_name, CAST({c} AS {cast}) AS value, {flag} AS is_cur FROM {src}")
    return "\nUNION ALL ".join(parts)


_NUM_LONG = ("long", _long_sql("features", "perturbed", NUMERIC_COLS, "DOUBLE"))
_CAT_LONG = ("long", _long_sql("(SELECT * FROM split_rows WHERE split = 'train')",
                               "(SELECT * FROM split_rows WHERE split = 'test')",
                               CATEGORICAL_COLS, "VARCHAR"))

_TOT = ("tot", "SELECT column_name, sum(n_base) AS tot_base, sum(n_cur) AS tot_cur FROM counts GROUP BY 1")
_PSI_TAIL = """
SELECT c.column_name,
       round(sum((greatest(n_cur / tot_cur, 1e-6) - greatest(n_base / tot_base, 1e-6))
                 * ln(greatest(n_cur / tot_cur, 1e-6) / greatest(n_base / tot_base, 1e-6))), 6) AS psi,
       count(*) AS {n_col}
FROM counts c JOIN tot t ON c.column_name = t.column_name GROUP BY c.column_name"""


def _long_pair(spark: SparkSession, base: str) -> DataFrame:
    """Baseline and stress window in long form from one pass over the features."""
    f = pert.with_stress_digest(features(spark, base))
    return dr.stack_row_pairs(f, NUMERIC_COLS, pert.perturbed_columns())


def _stored_windows(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """The numeric features and both windows in long form, from one table with both windows' numbers side by side."""
    shifted = pert.perturbed_columns()
    f = pert.with_stress_digest(features(spark, base)).select(*NUMERIC_COLS, *[v.alias(f"_cur_{c}") for c, v in shifted.items()])
    both = materialize(f, "windows")
    return both.select(*NUMERIC_COLS), dr.stack_row_pairs(both, NUMERIC_COLS, {c: F.col(f"_cur_{c}") for c in shifted})


@query("drift_psi", with_views(_PSI_TAIL.format(n_col="n_bins"), "features", extra=[
    ("perturbed", _PERTURB_SQL), _NUM_LONG,
    ("edges", "SELECT column_name, min(value) AS lo, max(value) AS hi FROM long "
              "WHERE NOT is_cur AND value IS NOT NULL GROUP BY 1"),
    ("counts", """SELECT l.column_name,
       CASE WHEN hi - lo > 0 THEN CAST(least(greatest(floor((value - lo) / (hi - lo) * 10), 0), 9) AS INTEGER)
            ELSE 0 END AS bin,
       count(CASE WHEN NOT is_cur THEN 1 END) AS n_base, count(CASE WHEN is_cur THEN 1 END) AS n_cur
FROM long l JOIN edges e ON l.column_name = e.column_name WHERE value IS NOT NULL GROUP BY 1, 2"""), _TOT]))
def q_drift_psi(spark: SparkSession, base: str) -> DataFrame:
    """PSI per numeric feature, baseline vs stress copy, 10 fixed bins."""
    numbers, long = _stored_windows(spark, base)
    return dr.psi_numeric_long(long, edges=dr.baseline_edges(numbers, NUMERIC_COLS))


@query("drift_ks", with_views("""
SELECT column_name, round(max(abs(cb / tb - cc / tc)), 6) AS ks FROM (
  SELECT column_name,
         sum(n_base) OVER w AS cb, sum(n_cur) OVER w AS cc,
         sum(n_base) OVER (PARTITION BY column_name) AS tb, sum(n_cur) OVER (PARTITION BY column_name) AS tc
  FROM pv WINDOW w AS (PARTITION BY column_name ORDER BY value ROWS UNBOUNDED PRECEDING)) GROUP BY 1""",
    "features", extra=[("perturbed", _PERTURB_SQL), _NUM_LONG,
                       ("pv", "SELECT column_name, value, count(CASE WHEN NOT is_cur THEN 1 END) AS n_base, "
                              "count(CASE WHEN is_cur THEN 1 END) AS n_cur FROM long "
                              "WHERE value IS NOT NULL GROUP BY 1, 2")]))
def q_drift_ks(spark: SparkSession, base: str) -> DataFrame:
    """Exact two-sample KS statistic per numeric feature."""
    return dr.ks_numeric_long(_long_pair(spark, base), len(NUMERIC_COLS))


@query("drift_moments", with_views("""
SELECT column_name,
       round(avg(value) FILTER (WHERE NOT is_cur), 6) AS mean_base,
       round(avg(value) FILTER (WHERE is_cur), 6) AS mean_cur,
       round(stddev_samp(value) FILTER (WHERE NOT is_cur), 6) AS std_base,
       round(stddev_samp(value) FILTER (WHERE is_cur), 6) AS std_cur,
       round(count(*) FILTER (WHERE NOT is_cur AND value IS NULL) / count(*) FILTER (WHERE NOT is_cur), 6) AS null_rate_base,
       round(count(*) FILTER (WHERE is_cur AND value IS NULL) / count(*) FILTER (WHERE is_cur), 6) AS null_rate_cur,
       round(avg(value) FILTER (WHERE is_cur) - avg(value) FILTER (WHERE NOT is_cur), 6) AS mean_delta,
       round(stddev_samp(value) FILTER (WHERE is_cur) - stddev_samp(value) FILTER (WHERE NOT is_cur), 6) AS std_delta
FROM long GROUP BY column_name""", "features", extra=[("perturbed", _PERTURB_SQL), _NUM_LONG]))
def q_drift_moments(spark: SparkSession, base: str) -> DataFrame:
    """Mean / std / NULL share per window and their change."""
    return dr.moments_long(_long_pair(spark, base))


@query("drift_categorical", with_views(_PSI_TAIL.format(n_col="n_categories"), "features", extra=[
    _split_view(), _CAT_LONG,
    ("counts", "SELECT column_name, coalesce(value, '<NULL>') AS value, "
               "count(CASE WHEN NOT is_cur THEN 1 END) AS n_base, count(CASE WHEN is_cur THEN 1 END) AS n_cur "
               "FROM long GROUP BY 1, 2"), _TOT]))
def q_drift_categorical(spark: SparkSession, base: str) -> DataFrame:
    """PSI over category shares, training vs holdout side."""
    train, test = spl.train_test(features(spark, base))
    return dr.psi_categorical(train, test, CATEGORICAL_COLS)


# ---------------------------------------------------------------------------
# payload log
# ---------------------------------------------------------------------------
@query("payload_parsed", """
SELECT event_type, count(*) AS n_requests,
       CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k,
       count(*) FILTER (WHERE json_extract(props, '$.k') IS NULL) AS n_missing_k
FROM events GROUP BY event_type""")
def q_payload_parsed(spark: SparkSession, base: str) -> DataFrame:
    """Parse the JSON request and count per kind."""
    ev = read_table(spark, base, "events", ["event_type", "props"])
    parsed = ev.withColumn("req", F.from_json("props", "k INT"))
    return parsed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum("req.k").cast("long").alias("sum_k"),
        F.count(F.when(F.col("req.k").isNull(), 1)).alias("n_missing_k"))


@query("payload_json", """
SELECT event_id AS request_id,
       CAST(to_json({'request_id': event_id, 'k': CAST(json_extract(props, '$.k') AS INTEGER)}) AS VARCHAR) AS record
FROM events""")
def q_payload_json(spark: SparkSession, base: str) -> DataFrame:
    """K9: rows -> JSON records (the serving request body)."""
    ev = read_table(spark, base, "events", ["event_id", "props"])
    rows = ev.select(F.col("event_id").alias("request_id"),
                     F.from_json("props", "k INT")["k"].alias("k"))
    return sk.json_records(rows, keep=["request_id"])


# ---------------------------------------------------------------------------
# prediction table sinks: overwrite, append, idempotent re-append, reset
# ---------------------------------------------------------------------------
AS_OF = "2001-06-01 00:00:00"


def _prediction_rows(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    p = fx.predictions(spark, base).withColumn("run_kind", F.lit("baseline"))
    drift = p.withColumns({"scored_at": F.col("scored_at") + F.expr("INTERVAL 1 DAY"),
                           "run_kind": F.lit("drift")})
    return _with_month(p), _with_month(drift)


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumns({"scored_month": F.date_format("scored_at", "yyyy-MM"), "scored_day": F.to_date("scored_at")})


def _write_baseline_and_drift(spark: SparkSession, baseline: DataFrame, drift: DataFrame) -> str:
    path = scratch_path(spark, "predictions")
    sk.write_table(baseline.sortWithinPartitions("scored_month"), path, "overwrite", ["scored_month"])
    sk.append_idempotent(spark, drift, path, ["transaction_id", "model_version", "run_kind", "scored_day"],
                         ["scored_month"])
    return path


_UNION_SQL = """
SELECT *, 'baseline' AS run_kind FROM predictions
UNION ALL
SELECT transaction_id, actual_quantity, predicted_quantity, residual, model_version,
       scored_at + INTERVAL 1 DAY AS scored_at, 'drift' AS run_kind FROM predictions"""

_COUNT_BODY = """
SELECT run_kind, model_version, count(*) AS n_rows, min(scored_at) AS first_scored,
       max(scored_at) AS last_scored, round(sum(residual), 6) AS sum_residual
FROM {src} GROUP BY run_kind, model_version"""


def _counts(df: DataFrame) -> DataFrame:
    return df.groupBy("run_kind", "model_version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("scored_at").alias("first_scored"),
        F.max("scored_at").alias("last_scored"), F.sum("residual").alias("sum_residual"))


@query("shifted_predictions_union", with_views(_COUNT_BODY.format(src="u"), "predictions",
                                               extra=[("u", _UNION_SQL)]))
def q_shifted_predictions_union(spark: SparkSession, base: str) -> DataFrame:
    """Overwrite baseline, append stress rows one day later, read back."""
    path = _write_baseline_and_drift(spark, *_prediction_rows(spark, base))
    return _counts(spark.read.parquet(path))


@query("shifted_metrics_by_day", with_views(f"""
SELECT date_trunc('day', scored_at) AS window_start, date_trunc('day', scored_at) + INTERVAL 1 DAY AS window_end,
       run_kind, count(*) AS n_scored, round(sqrt(avg(residual ^ 2)), 6) AS rmse
FROM u GROUP BY 1, 2, run_kind""", "predictions", extra=[("u", _UNION_SQL)]))
def q_shifted_metrics_by_day(spark: SparkSession, base: str) -> DataFrame:
    """A15 on the appended table: the two runs land in separate day windows."""
    path = _write_baseline_and_drift(spark, *_prediction_rows(spark, base))
    m = met.metrics_by_window(spark.read.parquet(path), keys=("run_kind",))
    return m.select("window_start", "window_end", "run_kind", "n_scored", "rmse")


@query("idempotent_append", with_views(_COUNT_BODY.format(src="u"), "predictions",
                                       extra=[("u", _UNION_SQL)]))
def q_idempotent_append(spark: SparkSession, base: str) -> DataFrame:
    """Appending the same stress rows again writes nothing."""
    baseline, drift = _prediction_rows(spark, base)
    path = _write_baseline_and_drift(spark, baseline, drift)
    sk.append_idempotent(spark, drift, path, ["transaction_id", "model_version", "run_kind", "scored_day"],
                         ["scored_month"])
    return _counts(spark.read.parquet(path))


@query("after_reset", with_views(_COUNT_BODY.format(
    src=f"(SELECT * FROM u WHERE NOT coalesce(scored_at > TIMESTAMP '{AS_OF}', false))"),
    "predictions", extra=[("u", _UNION_SQL)]))
def q_after_reset(spark: SparkSession, base: str) -> DataFrame:
    """Delete rows scored after ``as_of`` (new folder, not in place)."""
    path = _write_baseline_and_drift(spark, *_prediction_rows(spark, base))
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    kept = sk.delete_where(spark, path, F.col("scored_at") > as_of, partition_by=["scored_month"])
    return _counts(spark.read.parquet(kept))


@query("after_reset_partitions", with_views(_COUNT_BODY.format(
    src=f"(SELECT * FROM u WHERE NOT coalesce(scored_at > TIMESTAMP '{AS_OF}' OR model_version = '2' AND scored_at < TIMESTAMP '1993-01-01 00:00:00', false))"),
    "predictions", extra=[("u", _UNION_SQL)]))
def q_after_reset_partitions(spark: SparkSession, base: str) -> DataFrame:
    """The same delete on a catalog table; only the months that hold a match are rewritten and repointed."""
    path = _write_baseline_and_drift(spark, *_prediction_rows(spark, base))
    name = sk.register_partitioned(spark, f"predictions_{uuid.uuid4().hex}", path, ["scored_month"])
    late = F.col("scored_at") > F.lit(AS_OF).cast("timestamp_ntz")
    early = (F.col("model_version") == "2") & (F.col("scored_at") < F.lit("1993-01-01 00:00:00").cast("timestamp_ntz"))
    sk.delete_from_partitions(spark, name, late | early, ["scored_month"])
    return _counts(spark.table(name))


@query("parquet_snapshot_roundtrip", with_views(
    "SELECT split, count(*) AS n_rows, sum(quantity) AS sum_quantity, count(DISTINCT transaction_id) AS n_keys "
    "FROM split_rows GROUP BY split", "features", extra=[_split_view()]))
def q_parquet_snapshot_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """K3 K1: training snapshot written as Parquet and read back whole."""
    path = scratch_path(spark, "snapshot")
    sk.write_table(spl.assign_split(features(spark, base)), path, "overwrite", ["split"])
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.sum("quantity").alias("sum_quantity"),
                                     F.countDistinct("transaction_id").alias("n_keys"))


LOGGED_AT = "2024-02-01 00:00:00"


@query("run_log_append", with_views(f"""
SELECT run_id, kind, key, round(metric_value, 6) AS metric_value, param_value, TIMESTAMP '{LOGGED_AT}' AS logged_at
FROM (
  SELECT 'batch_inference_v' || model_version AS run_id, 'metric' AS kind, 'batch_rmse' AS key, rmse AS metric_value, NULL AS param_value FROM mv
  UNION ALL SELECT 'batch_inference_v' || model_version, 'metric', 'batch_mae', mae, NULL FROM mv
  UNION ALL SELECT 'batch_inference_v' || model_version, 'metric', 'batch_r2', r2, NULL FROM mv
  UNION ALL SELECT 'batch_inference_v' || model_version, 'param', 'num_rows_scored', NULL, CAST(n_scored AS VARCHAR) FROM mv
  UNION ALL SELECT 'batch_inference_v' || model_version, 'param', 'model_version', NULL, model_version FROM mv)""",
    "predictions", extra=[("mv", """
SELECT model_version, count(*) AS n_scored, sqrt(avg((actual_quantity - predicted_quantity) ^ 2)) AS rmse,
       avg(abs(actual_quantity - predicted_quantity)) AS mae,
       1 - sum((actual_quantity - predicted_quantity) ^ 2) / nullif(regr_syy(actual_quantity, actual_quantity), 0) AS r2
FROM predictions GROUP BY model_version""")]))
def q_run_log_append(spark: SparkSession, base: str) -> DataFrame:
    """Batch metrics per version -> long run-log rows, appended to
    the run log; its metrics and params read back (tags: ``append_batch_log``)."""
    return rl.read_run_log(spark, append_batch_log(spark, base), ["metric", "param"])


def append_batch_log(spark: SparkSession, base: str) -> str:
    """Append metrics, params and tags of the batch runs to run_metrics, run_params and run_tags."""
    m = met.metrics_by(fx.predictions(spark, base), ["model_version"]).withColumn(
        "run_id", F.format_string("batch_inference_v%s", F.col("model_version")))
    rows = rl.metrics_to_log_rows(
        m, "run_id", [], {"num_rows_scored": "n_scored", "model_version": "model_version"},
        F.lit(LOGGED_AT), {DRIFT_TAG: "'false'"})
    metric_rows = rl.metrics_to_log_rows(
        m.withColumnsRenamed({"rmse": "batch_rmse", "mae": "batch_mae", "r2": "batch_r2"}),
        "run_id", ["batch_rmse", "batch_mae", "batch_r2"], {}, F.lit(LOGGED_AT))
    return rl.append_run_log(spark, metric_rows.unionByName(rows), scratch_path(spark, "run-log"))
