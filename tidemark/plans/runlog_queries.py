"""Registered queries over the run log, gate and model registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import WATCHED_METRICS, WatchConfig
from ..functions.guards import map_get
from ..operators import gate as gt
from ..operators import registry as reg
from ..operators import runlog as rl
from ..sources import fixtures as fx
from .oracle_views import with_views
from .registry import query

EXPERIMENT = "exp_3"
_IN_LIST = ", ".join(f"'{m}'" for m in WATCHED_METRICS)


@query("recent_runs", with_views(f"""
SELECT r.run_id, r.run_name, r.status, r.start_time, r.end_time, r.experiment_id
FROM runs r JOIN experiments e ON r.experiment_id = e.experiment_id
WHERE e.name = '{EXPERIMENT}'
ORDER BY r.start_time DESC, r.run_id LIMIT 10""", "runs", "experiments"))
def q_recent_runs(spark: SparkSession, base: str) -> DataFrame:
    """Last 10 runs of one experiment."""
    return rl.recent_runs(fx.runs(spark, base), fx.experiments(spark, base), EXPERIMENT)


_HISTORY_SQL = f"""
SELECT m.run_id, r.run_name, m.metric_name, round(m.metric_value, 6) AS metric_value, m.metric_time,
       r.start_time AS run_start_time{{step}}
FROM metrics m JOIN runs r ON m.run_id = r.run_id JOIN experiments e ON r.experiment_id = e.experiment_id
WHERE e.name = '{EXPERIMENT}' AND m.metric_name IN ({_IN_LIST})
ORDER BY r.start_time DESC, m.metric_name"""


@query("metric_history", with_views(_HISTORY_SQL.format(step=""), "metrics", "runs", "experiments"))
def q_metric_history(spark: SparkSession, base: str) -> DataFrame:
    """Watched metric points of one experiment."""
    return rl.metric_history(fx.metrics(spark, base, with_step=False), fx.runs(spark, base),
                             fx.experiments(spark, base), EXPERIMENT)


@query("metric_history_with_step", with_views(_HISTORY_SQL.format(step=", m.step"),
                                              "metrics", "runs", "experiments"))
def q_metric_history_with_step(spark: SparkSession, base: str) -> DataFrame:
    """Older history layout with the per-metric step counter."""
    return rl.metric_history(fx.metrics(spark, base), fx.runs(spark, base),
                             fx.experiments(spark, base), EXPERIMENT, with_step=True)


_SUMMARY_SQL = """
SELECT r.run_id, r.experiment_id, coalesce(r.run_name, '') AS run_name,
       make_timestamp((epoch_us(r.start_time) // 1000) * 1000) AS start_time,
       epoch_us(r.start_time) // 1000 AS start_time_ms,
       round(w.batch_rmse, 6) AS batch_rmse, round(w.batch_mae, 6) AS batch_mae,
       round(w.batch_r2, 6) AS batch_r2,
       coalesce(tg.drift_simulation, 'false') AS drift_simulation
FROM runs r
LEFT JOIN (SELECT run_id,
                  arg_max(metric_value, step) FILTER (WHERE metric_name = 'batch_rmse') AS batch_rmse,
                  arg_max(metric_value, step) FILTER (WHERE metric_name = 'batch_mae') AS batch_mae,
                  arg_max(metric_value, step) FILTER (WHERE metric_name = 'batch_r2') AS batch_r2
           FROM metrics GROUP BY run_id) w ON r.run_id = w.run_id
LEFT JOIN (SELECT run_id, max(value) AS drift_simulation FROM run_tags
           WHERE key = 'drift_simulation' GROUP BY run_id) tg ON r.run_id = tg.run_id"""


def _summary(spark: SparkSession, base: str) -> DataFrame:
    return rl.run_summary(fx.runs(spark, base), fx.metrics(spark, base), fx.run_tags(spark, base))


@query("run_metrics_wide", with_views("SELECT * FROM summary", "runs", "metrics", "run_tags",
                                      extra=[("summary", _SUMMARY_SQL)]))
def q_run_metrics_wide(spark: SparkSession, base: str) -> DataFrame:
    """Per run latest batch metrics + tag with default."""
    return _summary(spark, base)


@query("latest_batch_runs", with_views(f"""
SELECT s.run_id, s.run_name, s.start_time, s.batch_rmse, s.batch_mae, s.batch_r2, s.drift_simulation
FROM summary s JOIN experiments e ON s.experiment_id = e.experiment_id
WHERE e.name = '{EXPERIMENT}' AND s.batch_rmse > 0
ORDER BY s.start_time DESC, s.run_id LIMIT 10""", "runs", "metrics", "run_tags", "experiments",
    extra=[("summary", _SUMMARY_SQL)]))
def q_latest_batch_runs(spark: SparkSession, base: str) -> DataFrame:
    """Search runs with batch_rmse > 0, newest first, at most 10."""
    s = rl.runs_for_experiment(_summary(spark, base), fx.experiments(spark, base), EXPERIMENT)
    return rl.search_runs(s, F.col("batch_rmse") > 0, 10).select(
        "run_id", "run_name", "start_time", "batch_rmse", "batch_mae", "batch_r2",
        "drift_simulation")


_NEWEST_SQL = """
SELECT experiment_id, run_id, batch_rmse, batch_r2, start_time FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY start_time DESC, run_id DESC) AS rn
  FROM summary WHERE batch_rmse > 0) WHERE rn = 1"""


def _newest(spark: SparkSession, base: str) -> DataFrame:
    s = _summary(spark, base).filter(F.col("batch_rmse") > 0)
    return rl.newest_run(s, ["run_id", "batch_rmse", "batch_r2", "start_time"], ["experiment_id"])


@query("latest_batch_run", with_views("SELECT * FROM newest", "runs", "metrics", "run_tags",
                                      extra=[("summary", _SUMMARY_SQL), ("newest", _NEWEST_SQL)]))
def q_latest_batch_run(spark: SparkSession, base: str) -> DataFrame:
    """Newest qualifying run per experiment (aggregate, not a window)."""
    return _newest(spark, base)


_NEWEST_CLEAN_SQL = _NEWEST_SQL.replace("WHERE batch_rmse > 0", "WHERE batch_rmse > 0 AND drift_simulation <> 'true'")


def _gate_sql(src: str, keys: str) -> str:
    rmse = "CASE WHEN isnan(batch_rmse) THEN NULL ELSE batch_rmse END"
    r2 = "CASE WHEN isnan(batch_r2) THEN NULL ELSE batch_r2 END"
    rb = f"coalesce({rmse} > 5.0, false)"
    r2b = f"coalesce({r2} < 0.5, false)"
    return f"""
SELECT {keys}, {rmse} AS latest_rmse, {r2} AS latest_r2, {rb} AS rmse_breach, {r2b} AS r2_breach,
       {rb} OR {r2b} AS retrain_needed,
       CASE WHEN {rb} THEN 'BREACH' ELSE 'OK' END AS rmse_status,
       CASE WHEN {r2b} THEN 'BREACH' ELSE 'OK' END AS r2_status
FROM {src}"""


@query("gate", with_views(_gate_sql("newest", "experiment_id, run_id"), "runs", "metrics",
                          "run_tags", extra=[("summary", _SUMMARY_SQL), ("newest", _NEWEST_SQL)]))
def q_gate(spark: SparkSession, base: str) -> DataFrame:
    """Thresholds on the newest batch metrics, per experiment."""
    return gt.evaluate(_newest(spark, base), keep=["experiment_id", "run_id"])


@query("gate_single", with_views(_gate_sql(f"""(SELECT arg_max(run_id, (start_time, run_id)) AS run_id,
        arg_max(batch_rmse, (start_time, run_id)) AS batch_rmse,
        arg_max(batch_r2, (start_time, run_id)) AS batch_r2
   FROM summary s JOIN experiments e ON s.experiment_id = e.experiment_id
   WHERE e.name = '{EXPERIMENT}' AND batch_rmse > 0) g""", "run_id"),
    "runs", "metrics", "run_tags", "experiments", extra=[("summary", _SUMMARY_SQL)]))
def q_gate_single(spark: SparkSession, base: str) -> DataFrame:
    """O4 + gate for one experiment: always one row (NULL metrics -> no breach)."""
    s = rl.runs_for_experiment(_summary(spark, base), fx.experiments(spark, base), EXPERIMENT)
    newest = rl.newest_run(s.filter(F.col("batch_rmse") > 0), ["run_id", "batch_rmse", "batch_r2"])
    return gt.evaluate(newest, keep=["run_id"])


_TIMES_SQL = """
SELECT r.experiment_id,
       max(m.metric_time) FILTER (WHERE m.metric_name = 'batch_rmse') AS batch_time,
       max(m.metric_time) FILTER (WHERE m.metric_name = 'rmse') AS retrain_time
FROM metrics m JOIN runs r ON m.run_id = r.run_id GROUP BY r.experiment_id"""


@query("gate_guarded", with_views("""
SELECT g.experiment_id, g.run_id, g.latest_rmse, g.latest_r2, g.rmse_breach, g.r2_breach,
       g.retrain_needed AND coalesce(t.retrain_time IS NULL OR t.batch_time > t.retrain_time, false)
         AS retrain_needed,
       g.rmse_status, g.r2_status, t.batch_time, t.retrain_time
FROM gate g LEFT JOIN times t ON g.experiment_id = t.experiment_id""",
    "runs", "metrics", "run_tags",
    extra=[("summary", _SUMMARY_SQL), ("newest", _NEWEST_SQL),
           ("gate", _gate_sql("newest", "experiment_id, run_id")), ("times", _TIMES_SQL)]))
def q_gate_guarded(spark: SparkSession, base: str) -> DataFrame:
    """A breach retrains only if logged after the last retrain's metrics."""
    g = gt.evaluate(_newest(spark, base), keep=["experiment_id", "run_id"])
    m = fx.metrics(spark, base, with_step=False)
    r = fx.runs(spark, base).select("run_id", "experiment_id")
    times = m.join(r, "run_id").groupBy("experiment_id").agg(
        F.max(F.when(F.col("metric_name") == "batch_rmse", F.col("metric_time"))).alias("batch_time"),
        F.max(F.when(F.col("metric_name") == "rmse", F.col("metric_time"))).alias("retrain_time"))
    return gt.guarded(g.join(times, "experiment_id", "left"), "batch_time", "retrain_time")


@query("gate_per_6h", with_views(_gate_sql("""(
  SELECT r.experiment_id, time_bucket(INTERVAL 6 HOUR, m.metric_time) AS window_start,
         time_bucket(INTERVAL 6 HOUR, m.metric_time) + INTERVAL 6 HOUR AS window_end,
         arg_max(m.metric_value, (m.metric_time, m.run_id)) FILTER (WHERE m.metric_name = 'batch_rmse') AS batch_rmse,
         arg_max(m.metric_value, (m.metric_time, m.run_id)) FILTER (WHERE m.metric_name = 'batch_r2') AS batch_r2
  FROM metrics m JOIN runs r ON m.run_id = r.run_id
  WHERE m.metric_name IN ('batch_rmse', 'batch_r2')
  GROUP BY 1, 2, 3) w""", "experiment_id, window_start, window_end"), "metrics", "runs"))
def q_gate_per_6h(spark: SparkSession, base: str) -> DataFrame:
    """T4s (batch form): one gate row per experiment and 6-hour watcher window."""
    m = fx.metrics(spark, base, with_step=False).join(
        fx.runs(spark, base).select("run_id", "experiment_id"), "run_id")
    w = gt.latest_in_windows(m, "6 hours", ["experiment_id"])
    return gt.evaluate(w, keep=["experiment_id", "window_start", "window_end"])


@query("runs_latest", """
SELECT user_id AS run_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS update_time,
       count(*) AS n_updates
FROM events GROUP BY user_id""")
def q_runs_latest(spark: SparkSession, base: str) -> DataFrame:
    """Latest state per run from an update log (events as run updates)."""
    from ..sources.tables import read_table
    ev = read_table(spark, base, "events", ["event_id", "user_id", "event_type", "ts"])
    latest = rl.runs_latest(ev, "user_id", ["ts", "event_id"], ["event_type", "ts"])
    counts = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_updates"))
    return latest.join(counts, "user_id").select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("status"),
        F.col("ts").alias("update_time"), "n_updates")


_LATEST_LONG_SQL = f"""
SELECT m.run_id, m.metric_name, arg_max(m.metric_value, m.step) AS metric_value
FROM metrics m WHERE m.metric_name IN ({_IN_LIST}) GROUP BY m.run_id, m.metric_name"""


@query("metric_trend", with_views("""
SELECT l.metric_name, l.run_id, r.start_time AS run_start_time, round(l.metric_value, 6) AS metric_value,
       row_number() OVER w AS position,
       round(lag(l.metric_value) OVER w, 6) AS prev_value,
       round(l.metric_value - lag(l.metric_value) OVER w, 6) AS delta,
       round(avg(l.metric_value) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS moving_avg_5
FROM latest l JOIN runs r ON l.run_id = r.run_id
WINDOW w AS (PARTITION BY l.metric_name ORDER BY r.start_time, l.run_id)""",
    "metrics", "runs", extra=[("latest", _LATEST_LONG_SQL)]))
def q_metric_trend(spark: SparkSession, base: str) -> DataFrame:
    """Per metric, runs in start order with previous value, change and
    5-run trailing mean (skew-safe: no window per metric name)."""
    latest = rl.latest_metrics_long(fx.metrics(spark, base), WATCHED_METRICS)
    hist = latest.join(fx.runs(spark, base).select("run_id", F.col("start_time").alias("run_start_time")),
                       "run_id")
    return rl.metric_trend(hist, n_metric_names=len(WATCHED_METRICS)).select(
        "metric_name", "run_id", "run_start_time", "metric_value", "position", "prev_value",
        "delta", "moving_avg_5")


@query("runs_without_tag", with_views("""
SELECT r.* FROM runs r
WHERE NOT EXISTS (SELECT 1 FROM run_tags t WHERE t.run_id = r.run_id
                  AND t.key = 'drift_simulation' AND t.value = 'true')""", "runs", "run_tags"))
def q_runs_without_tag(spark: SparkSession, base: str) -> DataFrame:
    """Drop the runs tagged as stress runs (anti-join)."""
    kept, _ = rl.remove_tagged_runs(fx.runs(spark, base), fx.run_tags(spark, base))
    return kept


@query("removed_run_count", with_views("""
SELECT count(*) AS n_removed FROM runs r
WHERE EXISTS (SELECT 1 FROM run_tags t WHERE t.run_id = r.run_id
              AND t.key = 'drift_simulation' AND t.value = 'true')""", "runs", "run_tags"))
def q_removed_run_count(spark: SparkSession, base: str) -> DataFrame:
    """How many tagged runs the reset removes."""
    _, removed = rl.remove_tagged_runs(fx.runs(spark, base), fx.run_tags(spark, base))
    return removed


@query("best_run", with_views("""
SELECT experiment_id, run_id AS best_run_id, round(rmse, 6) AS best_rmse FROM (
  SELECT r.experiment_id, l.run_id, l.metric_value AS rmse,
         row_number() OVER (PARTITION BY r.experiment_id ORDER BY l.metric_value, l.run_id) AS rn
  FROM latest l JOIN runs r ON l.run_id = r.run_id WHERE l.metric_name = 'rmse') WHERE rn = 1""",
    "metrics", "runs", extra=[("latest", _LATEST_LONG_SQL)]))
def q_best_run(spark: SparkSession, base: str) -> DataFrame:
    """Lowest rmse per experiment; ties -> first run id."""
    latest = rl.latest_metrics_long(fx.metrics(spark, base), ["rmse"])
    r = fx.runs(spark, base).select("run_id", "experiment_id")
    joined = latest.join(r, "run_id")
    best = joined.groupBy("experiment_id").agg(
        F.min(F.struct("metric_value", "run_id")).alias("_b"))
    return best.select("experiment_id", F.col("_b.run_id").alias("best_run_id"),
                       F.col("_b.metric_value").alias("best_rmse"))


# ---------------------------------------------------------------------------
# registry
# ---------------------------------------------------------------------------
MODEL = "model_3"


@query("version_history", with_views(f"""
SELECT name, version, creation_timestamp, status, run_id FROM model_versions
WHERE name = '{MODEL}' ORDER BY CAST(version AS INTEGER) DESC""", "model_versions"))
def q_version_history(spark: SparkSession, base: str) -> DataFrame:
    """Versions of one model, numerically descending."""
    return reg.version_history(fx.model_versions(spark, base), MODEL).select(
        "name", "version", "creation_timestamp", "status", "run_id")


@query("version_history_ascending", with_views(f"""
SELECT name, version, creation_timestamp, status, run_id FROM model_versions
WHERE name = '{MODEL}'""", "model_versions"))
def q_version_history_ascending(spark: SparkSession, base: str) -> DataFrame:
    """Versions of one model, numerically ascending."""
    return reg.version_history(fx.model_versions(spark, base), MODEL, descending=False).select(
        "name", "version", "creation_timestamp", "status", "run_id")


@query("tag_lookup", with_views("""
SELECT r.run_id, coalesce(max(CASE WHEN t.key = 'drift_simulation' THEN t.value END), 'false') AS drift_simulation
FROM runs r LEFT JOIN run_tags t ON t.run_id = r.run_id GROUP BY r.run_id""", "runs", "run_tags"))
def q_tag_lookup(spark: SparkSession, base: str) -> DataFrame:
    """Lookup with a default in a real map of each run's tags (few tags a run)."""
    tags = fx.run_tags(spark, base).groupBy("run_id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("tags"))
    return fx.runs(spark, base).select("run_id").join(tags, "run_id", "left").select(
        "run_id", map_get("tags", "drift_simulation", "false").alias("drift_simulation"))


@query("latest_version", with_views("""
SELECT name, arg_max(version, CAST(version AS INTEGER)) AS latest_version,
       arg_max(run_id, CAST(version AS INTEGER)) AS run_id,
       arg_max(creation_timestamp, CAST(version AS INTEGER)) AS creation_timestamp,
       count(*) AS n_versions
FROM model_versions GROUP BY name""", "model_versions"))
def q_latest_version(spark: SparkSession, base: str) -> DataFrame:
    """Numeric maximum version per model."""
    return reg.latest_versions(fx.model_versions(spark, base))


_CHAMP_SQL = """
SELECT name, 'champion' AS alias, arg_max(version, CAST(version AS INTEGER)) AS version,
       max(creation_timestamp) AS set_time
FROM model_versions GROUP BY name"""


@query("champion_lookup", with_views("""
SELECT v.name, v.version, a.alias, v.creation_timestamp, v.status, v.run_id
FROM aliases a JOIN model_versions v ON a.name = v.name AND a.version = v.version""",
    "model_versions", extra=[("aliases", _CHAMP_SQL)]))
def q_champion_lookup(spark: SparkSession, base: str) -> DataFrame:
    """Alias -> version record for every model."""
    mv = fx.model_versions(spark, base)
    return reg.resolve_alias(reg.champion_from_latest(mv), mv).select(
        "name", "version", "alias", "creation_timestamp", "status", "run_id")


_OLD_ALIASES_SQL = """
SELECT name, 'champion' AS alias, version, creation_timestamp AS set_time FROM model_versions WHERE version = '1'
UNION ALL
SELECT name, 'challenger' AS alias, version, creation_timestamp AS set_time FROM model_versions WHERE version = '2'"""


def _old_aliases(mv: DataFrame) -> DataFrame:
    return (mv.filter(F.col("version") == "1").select(
        "name", F.lit("champion").alias("alias"), "version", F.col("creation_timestamp").alias("set_time"))
        .unionByName(mv.filter(F.col("version") == "2").select(
            "name", F.lit("challenger").alias("alias"), "version",
            F.col("creation_timestamp").alias("set_time"))))


@query("alias_upsert", with_views("""
SELECT name, alias, arg_max(version, (set_time, src)) AS version, max(set_time) AS set_time
FROM (SELECT *, 0 AS src FROM old_aliases UNION ALL SELECT *, 1 AS src FROM champ)
GROUP BY name, alias""", "model_versions",
    extra=[("old_aliases", _OLD_ALIASES_SQL), ("champ", _CHAMP_SQL)]))
def q_alias_upsert(spark: SparkSession, base: str) -> DataFrame:
    """Alias rows upserted, newest writer wins per (model, alias)."""
    mv = fx.model_versions(spark, base)
    return reg.upsert_aliases(_old_aliases(mv), reg.champion_from_latest(mv))


PROMOTED_AT = "2024-02-01 00:00:00"


@query("promote", with_views(f"""
SELECT v.name, v.version, v.run_id, v.creation_timestamp, v.status, a.alias
FROM (SELECT name, version, creation_timestamp, status, run_id FROM prod
      UNION ALL
      SELECT p.name, CAST(p.max_v + 1 AS VARCHAR), TIMESTAMP '{PROMOTED_AT}', 'READY', c.run_id
      FROM (SELECT 'prod_' || name AS name, run_id FROM model_versions mv
            WHERE EXISTS (SELECT 1 FROM champ ch WHERE ch.name = mv.name AND ch.version = mv.version)) c
      JOIN (SELECT name, max(CAST(version AS INTEGER)) AS max_v FROM prod GROUP BY name) p
        ON p.name = c.name) v
LEFT JOIN (SELECT name, alias, arg_max(version, (set_time, src)) AS version FROM (
             SELECT name, 'champion' AS alias, version, creation_timestamp AS set_time, 0 AS src
             FROM prod WHERE version = '3'
             UNION ALL
             SELECT c.name, 'champion', CAST(p.max_v + 1 AS VARCHAR), TIMESTAMP '{PROMOTED_AT}', 1
             FROM (SELECT 'prod_' || name AS name FROM champ) c
             JOIN (SELECT name, max(CAST(version AS INTEGER)) AS max_v FROM prod GROUP BY name) p
               ON p.name = c.name) GROUP BY name, alias) a
  ON a.name = v.name AND a.version = v.version""", "model_versions",
    extra=[("champ", _CHAMP_SQL),
           ("prod", """SELECT 'prod_' || name AS name, version, creation_timestamp, status, run_id
                       FROM model_versions WHERE CAST(version AS INTEGER) <= 3""")]))
def q_promote(spark: SparkSession, base: str) -> DataFrame:
    """Copy each dev champion to prod as the next version and move
    prod's champion alias to it."""
    mv = fx.model_versions(spark, base)
    dev_aliases = reg.champion_from_latest(mv)
    prod = mv.filter(F.col("version").cast("int") <= 3).withColumn(
        "name", F.concat(F.lit("prod_"), F.col("name")))
    prod_aliases = prod.filter(F.col("version") == "3").select(
        "name", F.lit("champion").alias("alias"), "version",
        F.col("creation_timestamp").alias("set_time"))
    versions, aliases = reg.promote(mv, dev_aliases, prod, prod_aliases,
                                    lambda c: F.concat(F.lit("prod_"), c),
                                    F.lit(PROMOTED_AT).cast("timestamp_ntz"))
    return versions.join(aliases.select("name", "version", "alias"), ["name", "version"], "left") \
        .select("name", "version", "run_id", "creation_timestamp", "status", "alias")


@query("gate_excluding_stress", with_views(_gate_sql("newest", "experiment_id, run_id"), "runs", "metrics",
                                           "run_tags", extra=[("summary", _SUMMARY_SQL),
                                                              ("newest", _NEWEST_CLEAN_SQL)]))
def q_gate_excluding_stress(spark: SparkSession, base: str) -> DataFrame:
    """T11 flag: the gate on the newest run that is not tagged as a stress run."""
    cfg = WatchConfig(exclude_tags={"drift_simulation": "true"})
    s = rl.without_tags(_summary(spark, base).filter(F.col("batch_rmse") > 0), cfg.exclude_tags)
    newest = rl.newest_run(s, ["run_id", "batch_rmse", "batch_r2", "start_time"], ["experiment_id"])
    return gt.evaluate(newest, keep=["experiment_id", "run_id"])
