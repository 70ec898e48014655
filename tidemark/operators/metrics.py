"""Batch, sliced, rolled-up and windowed quality metrics in one pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import metric_sums, metrics_from_sums

METRIC_COLS = ["n_scored", "n_null", "rmse", "mae", "r2"]
_SUM_COLS = ["sse", "sae", "sum_y"]


def _finish(agg: DataFrame, keys: list[str]) -> DataFrame:
    return agg.withColumns(metrics_from_sums()).select(*keys, *METRIC_COLS)


def batch_metrics(scored: DataFrame, label: str = "actual_quantity",
                  pred: str = "predicted_quantity") -> DataFrame:
    """One row: rows scored, rows skipped (NULL), RMSE, MAE, R2.  Empty in -> one row, NULL metrics."""
    return _finish(scored.agg(*metric_sums(label, pred)), [])


def metrics_by(scored: DataFrame, keys: list[str], label: str = "actual_quantity",
               pred: str = "predicted_quantity") -> DataFrame:
    """Metrics per slice (e.g. model version).  Few slices = hot slices, so the
    aggregate is the partial/final hash aggregate: one small state per task."""
    return _finish(scored.groupBy(*keys).agg(*metric_sums(label, pred)), keys)


def metrics_rollup(scored: DataFrame, key: str = "model_version") -> DataFrame:
    """Per-slice rows plus the pooled row (``is_total``) from the same sums."""
    agg = scored.rollup(key).agg(*metric_sums(), F.grouping(key).alias("_g"))
    return agg.withColumns(metrics_from_sums()).select(
        key, (F.col("_g") == 1).alias("is_total"), *METRIC_COLS)


def metrics_by_window(scored: DataFrame, ts: str = "scored_at", duration: str = "1 day",
                      keys: tuple[str, ...] = ("model_version",)) -> DataFrame:
    """Tumbling-window metrics per slice (the monitor's time windows)."""
    agg = scored.groupBy(F.window(ts, duration).alias("w"), *keys).agg(*metric_sums())
    return agg.withColumns(metrics_from_sums()).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *keys, *METRIC_COLS)


def merge_metric_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """Combine stored states (e.g. one per streaming batch and key) into final metrics.

    Centred sums merge by the parallel variance formula: each state's own syy
    plus its count times the squared distance of its mean from the joint mean.
    """
    whole = Window.partitionBy(*keys)
    mean = F.sum("sum_y").over(whole) / F.sum("n_scored").over(whole)
    apart = F.col("n_scored") * F.pow(F.col("sum_y") / F.col("n_scored") - F.col("_mean"), 2)
    agg = states.withColumn("_mean", mean).groupBy(*keys).agg(
        F.sum("n_scored").alias("n_scored"), F.sum("n_null").alias("n_null"),
        *[F.sum(c).alias(c) for c in _SUM_COLS],
        F.sum(F.col("syy") + apart).alias("syy"))
    return _finish(agg, keys)


def metric_states(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Unfinished sums per slice: what a stream or an incremental job stores."""
    return scored.groupBy(*keys).agg(*metric_sums())


def net_metric_states(states: DataFrame, keys: list[str], sign: str = "change") -> DataFrame:
    """Final metrics of what is left when states of deleted rows (``sign`` -1) are taken from those of inserted ones (+1).

    Counts and sums subtract.  The label's centred sum of squares is taken back
    by the merge formula reversed: of a whole made of parts A and B,
    syy(A) = syy(whole) - syy(B) - n(A) n(B) / n(whole) * (mean(A) - mean(B))^2.
    Keys whose rows are all deleted have no row; more deletes than inserts are an error.
    """
    inserted = F.col(sign) > 0
    part = lambda c, mine: F.coalesce(F.sum(F.when(mine, F.col(c))), F.lit(0))
    # sums of squares of a side about one centre first: its states' own, and each mean's distance from the side's
    whole = Window.partitionBy(*keys, sign)
    mean = F.sum("sum_y").over(whole) / F.nullif(F.sum("n_scored").over(whole), F.lit(0))
    apart = F.coalesce(F.col("syy") + F.col("n_scored") * F.pow(F.col("sum_y") / F.nullif(F.col("n_scored"), F.lit(0)) - F.col("_mean"), 2), F.lit(0.0))
    columns = ["n_scored", "n_null", *_SUM_COLS, "_syy"]
    both = states.withColumn("_mean", mean).withColumn("_syy", apart).groupBy(*keys).agg(
        *[part(c, mine).alias(f"{c}_{side}") for c in columns for side, mine in (("in", inserted), ("out", ~inserted))])
    left = both.select(*keys, *[(F.col(f"{c}_in") - F.col(f"{c}_out")).alias(c) for c in columns[:-1]], "_syy_in", "_syy_out", "n_scored_in", "n_scored_out", "sum_y_out")
    gap = F.col("n_scored") * F.col("n_scored_out") / F.col("n_scored_in") * F.pow(F.col("sum_y") / F.col("n_scored") - F.col("sum_y_out") / F.col("n_scored_out"), 2)
    syy = F.greatest(F.col("_syy_in") - F.col("_syy_out") - F.when((F.col("n_scored_out") > 0) & (F.col("n_scored") > 0), gap).otherwise(0.0), F.lit(0.0))
    wrong = F.raise_error(F.lit("metric states: more rows deleted than inserted")).cast("long")
    checked = left.withColumn("n_scored", F.when((F.col("n_scored") < 0) | (F.col("n_null") < 0), wrong).otherwise(F.col("n_scored")))
    # one value left has no spread: what rounding leaves of it is none
    kept = checked.where((F.col("n_scored") > 0) | (F.col("n_null") > 0)).withColumn("syy", F.when(F.col("n_scored") > 1, syy).otherwise(0.0))
    sums = {c: F.when(F.col("n_scored") > 0, F.col(c)) for c in _SUM_COLS}
    return _finish(kept.withColumns(sums), keys)
