"""Registered queries over time: drift between windows, as-of joins, and the gate on a spine without gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift as dr
from ..operators import gate as gt
from ..operators import window_drift as wd
from ..operators.ordering import asof_join
from ..session import materialize
from ..sources import fixtures as fx
from ..streaming import jobs
from .oracle_views import with_views
from .registry import query

#: Bins of the scored columns: ten between these bounds, values outside in the end bins.
EDGES = {"actual_quantity": (0.0, 50.0), "predicted_quantity": (24.0, 27.0), "residual": (-25.0, 25.0)}
#: Day ranges compared, last day excluded.
BASE, CURRENT = ("1994-01-01", "1995-07-01"), ("1996-01-01", "1996-07-01")
KEYS = ["model_version"]

_IN = {side: f"day >= DATE '{lo}' AND day < DATE '{hi}'" for side, (lo, hi) in (("base", BASE), ("cur", CURRENT))}
_LONG_SQL = "\nUNION ALL ".join(
    f"SELECT model_version, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value, CAST(scored_at AS DATE) AS day, "
    f"CAST(least(greatest(floor(({c} - {lo}) / ({hi} - {lo}) * 10), 0), 9) AS INTEGER) AS bin FROM predictions" for c, (lo, hi) in EDGES.items())
_BINNED_SQL = with_views("""
SELECT model_version, column_name, CAST(max(tb) AS BIGINT) AS n_base, CAST(max(tc) AS BIGINT) AS n_cur,
       round(sum((greatest(nc / tc, 1e-6) - greatest(nb / tb, 1e-6)) * ln(greatest(nc / tc, 1e-6) / greatest(nb / tb, 1e-6))), 6) AS psi,
       round(max(abs(cb / tb - cc / tc)), 6) AS ks
FROM (SELECT *, sum(nb) OVER w AS cb, sum(nc) OVER w AS cc, sum(nb) OVER g AS tb, sum(nc) OVER g AS tc
      FROM counts WINDOW w AS (PARTITION BY model_version, column_name ORDER BY bin), g AS (PARTITION BY model_version, column_name))
GROUP BY model_version, column_name""", "predictions", extra=[("long", _LONG_SQL), ("counts", f"""
SELECT v.model_version, v.column_name, b.bin, count(*) FILTER (WHERE l.bin = b.bin AND {_IN["base"]}) AS nb, count(*) FILTER (WHERE l.bin = b.bin AND {_IN["cur"]}) AS nc
FROM (SELECT DISTINCT model_version, column_name FROM long) v CROSS JOIN (SELECT unnest(range(10)) AS bin) b
     JOIN long l ON l.model_version = v.model_version AND l.column_name = v.column_name GROUP BY 1, 2, 3""")])


def _states(predictions: DataFrame) -> DataFrame:
    """The state table of the predictions, stored."""
    return materialize(wd.daily_states(predictions, EDGES, KEYS), "drift-states")


@query("drift_windows", _BINNED_SQL)
def q_drift_windows(spark: SparkSession, base: str) -> DataFrame:
    """PSI and KS per version and column between two ranges of scored days, from the daily states."""
    return wd.binned_drift(wd.window_pairs(_states(fx.predictions(spark, base)), BASE, CURRENT, KEYS), KEYS)


@query("drift_windows_ks", with_views(f"""
SELECT model_version, column_name, CAST(max(tb) AS BIGINT) AS n_base, CAST(max(tc) AS BIGINT) AS n_cur, round(max(abs(cb / tb - cc / tc)), 6) AS ks, true AS sketch_in_bound
FROM (SELECT model_version, column_name, sum(nb) OVER w AS cb, sum(nc) OVER w AS cc, sum(nb) OVER g AS tb, sum(nc) OVER g AS tc
      FROM (SELECT model_version, column_name, value, count(*) FILTER (WHERE {_IN["base"]}) AS nb, count(*) FILTER (WHERE {_IN["cur"]}) AS nc FROM long GROUP BY 1, 2, 3)
      WINDOW w AS (PARTITION BY model_version, column_name ORDER BY value ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY model_version, column_name))
GROUP BY model_version, column_name""", "predictions", extra=[("long", _LONG_SQL)]))
def q_drift_windows_ks(spark: SparkSession, base: str) -> DataFrame:
    """The exact KS between two ranges of scored days, and whether the merged sketches give it within their bound."""
    p = fx.predictions(spark, base)
    day = F.to_date("scored_at")
    inside = [(day >= F.lit(lo).cast("date")) & (day < F.lit(hi).cast("date")) for lo, hi in (BASE, CURRENT)]
    rows = F.explode(F.array(*[F.struct(F.concat_ws("|", "model_version", F.lit(c)).alias("column_name"), F.col(c).alias("value")) for c in EDGES])).alias("_e")
    long = p.where(inside[0] | inside[1]).select(inside[1].alias("is_cur"), rows).select("is_cur", "_e.*")
    exact = dr.ks_numeric_long(long).select(F.col("column_name").alias("_name"), F.col("ks").alias("_exact"))
    sketched = wd.sketched_drift(wd.window_pairs(_states(p), BASE, CURRENT, KEYS), KEYS)
    return (sketched.join(F.broadcast(exact), F.concat_ws("|", "model_version", "column_name") == F.col("_name"))  # a row per version and column
            .select("model_version", "column_name", "n_base", "n_cur", F.col("_exact").alias("ks"), (F.abs(F.col("ks") - F.col("_exact")) <= wd.ks_bound()).alias("sketch_in_bound")))


@query("stream_drift_windows", _BINNED_SQL)
def q_stream_drift_windows(spark: SparkSession, base: str) -> DataFrame:
    """T1s M16: states kept as rows arrive, in two runs over a growing folder and with the last batch replayed; the drift equals that of one batch."""
    paths = jobs.StreamPaths.fresh(spark, "drift")
    p = fx.predictions(spark, base)
    early = F.col("scored_at") < F.lit("1995-01-01").cast("timestamp_ntz")
    write = jobs.state_writer(paths.sink, lambda rows: wd.daily_states(rows, EDGES, KEYS))
    for part in (p.filter(early), p.filter(~early)):
        jobs.land_files(part, paths.source)
        jobs.run_batches(jobs.read_stream(spark, paths.source, p.schema), write, paths.checkpoint)
    last = spark.read.parquet(paths.sink).agg(F.max("batch_id")).first()[0]
    write(p.filter(~early), last)  # as after a failure between the write and the commit
    return wd.binned_drift(wd.window_pairs(spark.read.parquet(paths.sink), BASE, CURRENT, KEYS), KEYS)


# ---------------------------------------------------------------------------
# the newest retrain before each scored run
# ---------------------------------------------------------------------------
_POINTS_SQL = ("points", "SELECT *, 'model_' || CAST(run_id % 7 AS VARCHAR) AS name FROM metrics WHERE metric_name IN ('batch_rmse', 'batch_r2')")
_ASOF_SQL = ("met", """
SELECT * FROM (
  SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY name ORDER BY t, side, num ROWS UNBOUNDED PRECEDING) AS retrain
  FROM (SELECT name, metric_time AS t, 1 AS side, 0 AS num, NULL AS v, run_id, metric_name, metric_value, step FROM points
        UNION ALL SELECT name, creation_timestamp, 0, CAST(version AS INTEGER), {'version': version, 'at': creation_timestamp}, NULL, NULL, NULL, NULL FROM model_versions)) WHERE side = 1""")
_BREACH_SQL = "coalesce(CASE WHEN metric_name = 'batch_rmse' THEN metric_value > 5.0 ELSE metric_value < 0.5 END AND NOT isnan(metric_value), false)"


def _points_with_retrain(spark: SparkSession, base: str) -> DataFrame:
    points = fx.metrics(spark, base).filter(F.col("metric_name").isin("batch_rmse", "batch_r2"))
    points = points.withColumn("name", F.concat(F.lit("model_"), (F.col("run_id") % 7).cast("string")))
    retrains = fx.model_versions(spark, base).select("name", "version", F.col("creation_timestamp").alias("retrain_time"))
    return asof_join(points, retrains, ["name"], "metric_time", "retrain_time", ["version", "retrain_time"], ties=[F.col("version").cast("int")], group_bound=7)


@query("points_asof_retrain", with_views("""
SELECT run_id, metric_name, step, t AS metric_time, metric_value, name, retrain.version AS version, retrain."at" AS retrain_time
FROM met""", "metrics", "model_versions", extra=[_POINTS_SQL, _ASOF_SQL]), raw=("metric_value",))
def q_points_asof_retrain(spark: SparkSession, base: str) -> DataFrame:
    """Every batch metric point with the version that the newest retrain before it made."""
    return _points_with_retrain(spark, base).select("run_id", "metric_name", "step", "metric_time", "metric_value", "name", "version", "retrain_time")


@query("retrain_triggers", with_views(f"""
SELECT name, retrain.version AS version, retrain."at" AS retrain_time, count(*) AS n_points, count(*) FILTER ({_BREACH_SQL}) AS n_breaches,
       min(t) FILTER ({_BREACH_SQL}) AS first_breach_time,
       arg_min(run_id, (t, run_id, metric_name)) FILTER ({_BREACH_SQL}) AS first_breach_run
FROM met GROUP BY 1, 2, 3""", "metrics", "model_versions", extra=[_POINTS_SQL, _ASOF_SQL]))
def q_retrain_triggers(spark: SparkSession, base: str) -> DataFrame:
    """Per model and retrain, the first breach after it, which triggers the next one; later breaches are answered by that."""
    return gt.first_breaches(_points_with_retrain(spark, base), ["name", "version", "retrain_time"])


@query("gate_spine_6h", with_views("""
SELECT experiment_id, window_start, window_end, CASE WHEN isnan(r.value) THEN NULL ELSE r.value END AS latest_rmse, CASE WHEN isnan(q.value) THEN NULL ELSE q.value END AS latest_r2,
       coalesce(r.value > 5.0, false) AS rmse_breach, coalesce(q.value < 0.5, false) AS r2_breach,
       coalesce(r.value > 5.0, false) OR coalesce(q.value < 0.5, false) AS retrain_needed,
       CASE WHEN coalesce(r.value > 5.0, false) THEN 'BREACH' ELSE 'OK' END AS rmse_status, CASE WHEN coalesce(q.value < 0.5, false) THEN 'BREACH' ELSE 'OK' END AS r2_status,
       CAST(epoch(window_end) - floor(epoch(r."at")) AS BIGINT) AS rmse_age_s, CAST(epoch(window_end) - floor(epoch(q."at")) AS BIGINT) AS r2_age_s
FROM (SELECT s.experiment_id, s.window_start, s.window_start + INTERVAL 6 HOUR AS window_end, last_value(p.r IGNORE NULLS) OVER w AS r, last_value(p.q IGNORE NULLS) OVER w AS q
      FROM spine s LEFT JOIN found p ON p.experiment_id = s.experiment_id AND p.window_start = s.window_start
      WINDOW w AS (PARTITION BY s.experiment_id ORDER BY s.window_start ROWS UNBOUNDED PRECEDING))""", "metrics", "runs", extra=[
    ("spine", """SELECT experiment_id, unnest(generate_series(time_bucket(INTERVAL 6 HOUR, min(start_time)), time_bucket(INTERVAL 6 HOUR, max(end_time)), INTERVAL 6 HOUR)) AS window_start
FROM runs GROUP BY experiment_id"""),
    ("found", """SELECT r.experiment_id, time_bucket(INTERVAL 6 HOUR, m.metric_time) AS window_start,
       arg_max({'value': m.metric_value, 'at': m.metric_time}, (m.metric_time, m.run_id)) FILTER (WHERE m.metric_name = 'batch_rmse') AS r,
       arg_max({'value': m.metric_value, 'at': m.metric_time}, (m.metric_time, m.run_id)) FILTER (WHERE m.metric_name = 'batch_r2') AS q
FROM metrics m JOIN runs r ON m.run_id = r.run_id WHERE m.metric_name IN ('batch_rmse', 'batch_r2') GROUP BY 1, 2""")]))
def q_gate_spine_6h(spark: SparkSession, base: str) -> DataFrame:
    """T4s without gaps: a decision for every 6-hour window from an experiment's first run to its last, on the newest metrics so far and with their age."""
    runs = fx.runs(spark, base)
    points = fx.metrics(spark, base, with_step=False).join(runs.select("run_id", "experiment_id"), "run_id")
    bounds = runs.groupBy("experiment_id").agg(F.min("start_time").alias("first"), F.max("end_time").alias("last"))
    spine = gt.time_spine(bounds, ["experiment_id"], "first", "last", "6 hours")
    w = gt.carried_windows(points, spine, "6 hours", ["experiment_id"])
    w = w.withColumnsRenamed({"batch_rmse_age_s": "rmse_age_s", "batch_r2_age_s": "r2_age_s"})
    return gt.evaluate(w, keep=["experiment_id", "window_start", "window_end", "rmse_age_s", "r2_age_s"])
