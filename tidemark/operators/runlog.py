"""Run-log tables (runs, experiments, metric history, tags, params) and the
queries the watcher runs over them.

The run log is plain tables; "latest" is an aggregate (``max_by``), never a
``row_number() = 1`` window, so a run with millions of metric points costs a
single small state per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DRIFT_TAG, WATCHED_METRICS
from ..session import materialize
from .ordering import lag_in_groups, latest_per_key, number_in_groups, trailing_mean_in_groups
from .sinks import append_idempotent

METRIC_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("metric_value", T.DoubleType(), True),
    T.StructField("metric_time", T.TimestampNTZType(), True),
    T.StructField("step", T.LongType(), True),
])
KV_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
])


def runs_for_experiment(runs: DataFrame, experiments: DataFrame, name: str) -> DataFrame:
    e = experiments.filter(F.col("name") == name).select("experiment_id")
    return runs.join(e, "experiment_id", "left_semi")


def recent_runs(runs: DataFrame, experiments: DataFrame, name: str, n: int = 10) -> DataFrame:
    """Newest ``n`` runs of an experiment (top-k: per-task top n, then merge)."""
    r, e = runs.alias("r"), experiments.alias("e")
    return (r.join(e, F.col("r.experiment_id") == F.col("e.experiment_id"), "inner")
            .filter(F.col("e.name") == name)
            .select("r.run_id", "r.run_name", "r.status", "r.start_time", "r.end_time",
                    "r.experiment_id")
            .orderBy(F.desc("start_time"), F.asc("run_id")).limit(n))


def metric_history(metrics: DataFrame, runs: DataFrame, experiments: DataFrame, name: str,
                   names: list[str] = WATCHED_METRICS, with_step: bool = False,
                   ordered: bool = True) -> DataFrame:
    """Metric points of an experiment's runs, newest run first.

    The name and IN-list filters reach the scans; the experiment side is one
    row after its filter, and the run side shrinks with it before meeting
    the (large) metric history.
    """
    m, r, e = metrics.alias("m"), runs.alias("r"), experiments.alias("e")
    cols = [F.col("m.run_id"), F.col("r.run_name"), F.col("m.metric_name"),
            F.col("m.metric_value"), F.col("m.metric_time"),
            F.col("r.start_time").alias("run_start_time")]
    if with_step:
        cols.append(F.col("m.step"))
    out = (m.join(r, F.col("m.run_id") == F.col("r.run_id"), "inner")
           .join(e, F.col("r.experiment_id") == F.col("e.experiment_id"), "inner")
           .filter((F.col("e.name") == name) & F.col("m.metric_name").isin(*names))
           .select(*cols))
    return out.orderBy(F.desc("run_start_time"), "metric_name") if ordered else out


def latest_metrics_long(metrics: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(run_id, metric_name, metric_value): newest point per run and metric
    (highest step, then latest time)."""
    src = metrics.filter(F.col("metric_name").isin(*names)) if names else metrics
    order = ["step", "metric_time"] if "step" in metrics.columns else ["metric_time"]
    return latest_per_key(src, ["run_id", "metric_name"], order, ["metric_value"])


def metrics_wide(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Long metric history -> one row per run, one column per metric (latest value)."""
    latest = latest_metrics_long(metrics, names)
    return latest.groupBy("run_id").pivot("metric_name", names).agg(F.first("metric_value"))


def tags_wide(tags: DataFrame, keys: list[str], defaults: dict[str, str]) -> DataFrame:
    """Tag rows -> columns with ``dict.get(key, default)`` semantics."""
    wide = tags.filter(F.col("key").isin(*keys)).groupBy("run_id").pivot("key", keys) \
        .agg(F.max("value"))
    return wide.select("run_id", *[F.coalesce(F.col(k), F.lit(defaults.get(k))).alias(k)
                                   for k in keys])


def run_summary(runs: DataFrame, metrics: DataFrame, tags: DataFrame,
                metric_names: list[str] = ("batch_rmse", "batch_mae", "batch_r2")) -> DataFrame:
    """The watcher's per-run record: name, start (also as epoch ms), latest
    batch metrics, drift tag with default 'false'."""
    names = list(metric_names)
    wide = metrics_wide(metrics, names)
    tw = tags_wide(tags, [DRIFT_TAG], {DRIFT_TAG: "false"})
    base = runs.select("run_id", "run_name", "start_time", "experiment_id",
                       F.unix_millis(F.col("start_time").cast("timestamp")).alias("start_time_ms"))
    out = base.join(wide, "run_id", "left").join(tw, "run_id", "left")
    return out.select(
        "run_id", "experiment_id", F.coalesce("run_name", F.lit("")).alias("run_name"),
        F.timestamp_millis("start_time_ms").cast("timestamp_ntz").alias("start_time"),
        "start_time_ms", *names, F.coalesce(F.col(DRIFT_TAG), F.lit("false")).alias(DRIFT_TAG))


def search_runs(summary: DataFrame, predicate, n: int = 10) -> DataFrame:
    """``search_runs(filter, order_by=start_time DESC, max_results=n)``."""
    return summary.filter(predicate).orderBy(F.desc("start_time"), F.asc("run_id")).limit(n)


def without_tags(summary: DataFrame, exclude: dict[str, str]) -> DataFrame:
    """Drop runs whose tag column equals the given value (e.g. stress runs:
    ``{"drift_simulation": "true"}``).  Default watcher behaviour keeps every
    run; this is the opt-in filter."""
    out = summary
    for key, value in (exclude or {}).items():
        out = out.filter(~F.coalesce(F.col(key) == F.lit(value), F.lit(False)))
    return out


def newest_run(summary: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Newest run's fields, one row per ``by`` group; with no group a single
    row that is all NULL when nothing qualifies (global aggregate)."""
    packed = F.struct(*[F.col(c) for c in cols])
    order = F.struct(F.col("start_time"), F.col("run_id"))
    agg = (summary.groupBy(*by) if by else summary).agg(F.max_by(packed, order).alias("_n"))
    return agg.select(*(by or []), *[F.col(f"_n.{c}").alias(c) for c in cols])


def runs_latest(updates: DataFrame, key: str, time_cols: list[str], value_cols: list[str]) -> DataFrame:
    """Latest state per run from an update log (the ``*_latest`` tables)."""
    return latest_per_key(updates, [key], time_cols, value_cols)


def metric_trend(history: DataFrame, window_rows: int = 5,
                 n_metric_names: int | None = None) -> DataFrame:
    """Per metric, runs in start order: previous value, change, trailing mean.

    Input: (run_id, metric_name, metric_value, run_start_time), one row per
    run and metric.  Few metric names means each is a hot group: position,
    lag and trailing mean use the range-partitioned numbering and keyed
    self-joins instead of a window per metric.
    """
    numbered = number_in_groups(history, ["metric_name"], ["run_start_time", "run_id"],
                                out="position", group_bound=n_metric_names)
    with_prev = lag_in_groups(numbered, ["metric_name"], "position", "metric_value", "prev_value")
    with_ma = trailing_mean_in_groups(with_prev, ["metric_name"], "position", "metric_value",
                                      f"moving_avg_{window_rows}", window_rows)
    return with_ma.withColumn("delta", F.col("metric_value") - F.col("prev_value"))


def remove_tagged_runs(runs: DataFrame, tags: DataFrame, key: str = DRIFT_TAG,
                       value: str = "true") -> tuple[DataFrame, DataFrame]:
    """(kept runs, removed count): anti-join against the tagged run ids."""
    tagged = tags.filter((F.col("key") == key) & (F.col("value") == value)).select("run_id")
    kept = runs.join(tagged, "run_id", "left_anti")
    removed = runs.join(tagged, "run_id", "left_semi").agg(F.count(F.lit(1)).alias("n_removed"))
    return kept, removed


def metrics_to_log_rows(wide: DataFrame, run_id_col: str, metric_cols: list[str],
                        param_cols: dict[str, str], at, tag_cols: dict[str, str] | None = None) -> DataFrame:
    """Wide result rows -> run-log rows (K7): one row per metric / param / tag.

    ``stack`` keeps it a projection (no shuffle); the time is an argument.
    """
    metric_entries = [F.struct(F.lit("metric").alias("kind"), F.lit(c).alias("key"),
                               F.col(c).cast("double").alias("metric_value"),
                               F.lit(None).cast("string").alias("param_value"))
                      for c in metric_cols]
    param_entries = [F.struct(F.lit(kind).alias("kind"), F.lit(k).alias("key"),
                              F.lit(None).cast("double").alias("metric_value"),
                              F.expr(v).cast("string").alias("param_value"))
                     for kind, cols in (("param", param_cols), ("tag", tag_cols or {})) for k, v in cols.items()]
    entries = F.explode(F.array(*metric_entries, *param_entries)).alias("_e")
    return wide.select(F.col(run_id_col).alias("run_id"), entries).select(
        "run_id", "_e.kind", "_e.key", "_e.metric_value", "_e.param_value",
        F.lit(at).cast("timestamp_ntz").alias("logged_at"))


#: Run-log table and value column of each kind of log row.
LOG_TABLES = {"metric": ("run_metrics", "metric_value"), "param": ("run_params", "param_value"), "tag": ("run_tags", "param_value")}


def append_run_log(spark: SparkSession, rows: DataFrame, path: str) -> str:
    """Append the rows of ``metrics_to_log_rows`` to the tables run_metrics,
    run_params and run_tags below ``path`` (K7); logging them again writes nothing."""
    rows = materialize(rows, "run-log")
    for kind, (name, value) in LOG_TABLES.items():
        append_idempotent(spark, rows.filter(F.col("kind") == kind).select("run_id", "key", F.col(value).alias("value"), "logged_at"),
                          f"{path}/{name}", ["run_id", "key", "logged_at"])
    return path


def read_run_log(spark: SparkSession, path: str, kinds: list[str] = tuple(LOG_TABLES)) -> DataFrame:
    """The log rows of ``kinds`` below ``path``, in the shape of ``metrics_to_log_rows``."""
    out = None
    for kind in kinds:
        name, value = LOG_TABLES[kind]
        values = {"metric_value": F.lit(None).cast("double"), "param_value": F.lit(None).cast("string")} | {value: F.col("value")}
        t = spark.read.parquet(f"{path}/{name}").select(
            "run_id", F.lit(kind).alias("kind"), "key", *[v.alias(c) for c, v in values.items()], "logged_at")
        out = t if out is None else out.unionByName(t)
    return out


def empty_metric_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], METRIC_LOG_SCHEMA)
