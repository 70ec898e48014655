"""Drift between a baseline and a current window, per column.

Both windows are stacked into one long frame ``(column_name, value, is_cur)``
so each statistic is one aggregation over both windows, not a join of two.
Per-column reference tables (edges, totals) have one row per column, a size
fixed by the caller's column list, so they are broadcast.

* PSI on fixed equal-width edges: 10 bins between the baseline min and max,
  values outside clamp to the end bins; shares are floored at 1e-6.
* KS: exact two-sample statistic max |F_base(x) - F_cur(x)| over all
  distinct values, with cumulative counts from the skew-safe running sum.
* Moments: mean, sample std, NULL share per window and their change.
* Categorical PSI: share of each category per window, same flooring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .ordering import running_sum_in_groups

EPS = 1e-6
BINS = 10


def stack_row_pairs(df: DataFrame, cols: list[str], shifted: dict) -> DataFrame:
    """Long frame of both windows from ONE pass when the current window is a
    row-wise transform of the baseline (``shifted`` maps column -> expression;
    missing columns are unchanged).  Same rows as stacking the two frames."""
    entries = []
    for flag, exprs in ((False, {}), (True, shifted)):
        for c in cols:
            v = exprs.get(c, F.col(c))
            entries.append(F.struct(F.lit(c).alias("column_name"), v.cast("double").alias("value"),
                                    F.lit(flag).alias("is_cur")))
    return df.select(F.explode(F.array(*entries)).alias("_p")).select(
        "_p.column_name", "_p.value", "_p.is_cur")


def _stack_numeric(base: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    def long(df: DataFrame, flag: bool) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                   F.col(c).cast("double").alias("value")) for c in cols])
        return df.select(F.explode(pairs).alias("_p")).select(
            "_p.column_name", "_p.value", F.lit(flag).alias("is_cur"))

    return long(base, False).unionByName(long(cur, True))


def _stack_text(base: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    def long(df: DataFrame, flag: bool) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                   F.col(c).cast("string").alias("value")) for c in cols])
        return df.select(F.explode(pairs).alias("_p")).select(
            "_p.column_name", "_p.value", F.lit(flag).alias("is_cur"))

    return long(base, False).unionByName(long(cur, True))


def _psi_from_counts(counts: DataFrame, key: str) -> DataFrame:
    """counts: (column_name, key, n_base, n_cur) -> (column_name, psi)."""
    totals = counts.groupBy("column_name").agg(
        F.sum("n_base").alias("tot_base"), F.sum("n_cur").alias("tot_cur"))
    shares = counts.join(F.broadcast(totals), "column_name").select(
        "column_name", key,
        F.greatest(F.col("n_base") / F.col("tot_base"), F.lit(EPS)).alias("pb"),
        F.greatest(F.col("n_cur") / F.col("tot_cur"), F.lit(EPS)).alias("pc"))
    return shares.groupBy("column_name").agg(
        F.sum((F.col("pc") - F.col("pb")) * F.log(F.col("pc") / F.col("pb"))).alias("psi"),
        F.count(F.lit(1)).alias("n_bins"))


def psi_numeric(base: DataFrame, cur: DataFrame, cols: list[str], bins: int = BINS) -> DataFrame:
    return psi_numeric_long(_stack_numeric(base, cur, cols), bins, baseline_edges(base, cols))


def baseline_edges(base: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, lo, hi) of the baseline window: one aggregate over the
    baseline's own columns, then 2 x len(cols) values unpivoted."""
    agg = base.agg(*[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in cols],
                   *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"lo_{c}").alias("lo"),
                              F.col(f"hi_{c}").alias("hi")) for c in cols])
    return agg.select(F.explode(rows).alias("_e")).select("_e.column_name", "_e.lo", "_e.hi")


def psi_numeric_long(long: DataFrame, bins: int = BINS, edges: DataFrame | None = None) -> DataFrame:
    """PSI from a long (column_name, value, is_cur) frame."""
    long = long.filter(F.col("value").isNotNull())
    if edges is None:
        edges = long.filter(~F.col("is_cur")).groupBy("column_name").agg(
            F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = F.col("hi") - F.col("lo")
    raw_bin = F.floor((F.col("value") - F.col("lo")) / width * F.lit(bins))
    binned = long.join(F.broadcast(edges), "column_name").withColumn(
        "bin", F.when(width > 0, F.least(F.greatest(raw_bin, F.lit(0)), F.lit(bins - 1)))
        .otherwise(F.lit(0)).cast("int"))
    counts = binned.groupBy("column_name", "bin").agg(
        F.count(F.when(~F.col("is_cur"), 1)).alias("n_base"),
        F.count(F.when(F.col("is_cur"), 1)).alias("n_cur"))
    return _psi_from_counts(counts, "bin")


def psi_categorical(base: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    long = _stack_text(base, cur, cols)  # NULL is a category of its own
    counts = long.groupBy("column_name", "value").agg(
        F.count(F.when(~F.col("is_cur"), 1)).alias("n_base"),
        F.count(F.when(F.col("is_cur"), 1)).alias("n_cur"))
    return _psi_from_counts(counts, "value").withColumnRenamed("n_bins", "n_categories")


def ks_numeric(base: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    return ks_numeric_long(_stack_numeric(base, cur, cols), len(cols))


def ks_numeric_long(long: DataFrame, n_cols: int | None = None) -> DataFrame:
    """KS from a long (column_name, value, is_cur) frame."""
    long = long.filter(F.col("value").isNotNull())
    # One row per (column, distinct value).  Materialised: the range shuffle
    # below samples its input in a separate job, and the input plan (both
    # windows' feature joins) should run once, not once per consumer.
    per_value = long.groupBy("column_name", "value").agg(
        F.count(F.when(~F.col("is_cur"), 1)).alias("n_base"),
        F.count(F.when(F.col("is_cur"), 1)).alias("n_cur"))
    per_value = materialize(per_value, "ks-values")
    totals = per_value.groupBy("column_name").agg(
        F.sum("n_base").alias("tot_base"), F.sum("n_cur").alias("tot_cur"))
    cum = running_sum_in_groups(per_value, ["column_name"], ["value"],
                                {"n_base": "cum_base", "n_cur": "cum_cur"}, group_bound=n_cols)
    gap = F.abs(F.col("cum_base") / F.col("tot_base") - F.col("cum_cur") / F.col("tot_cur"))
    return cum.join(F.broadcast(totals), "column_name").groupBy("column_name").agg(
        F.max(gap).alias("ks"))


def moments(base: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    return moments_long(_stack_numeric(base, cur, cols))


def moments_long(long: DataFrame) -> DataFrame:
    """Moments from a long (column_name, value, is_cur) frame."""
    v, is_cur = F.col("value"), F.col("is_cur")
    agg = long.groupBy("column_name").agg(
        F.avg(F.when(~is_cur, v)).alias("mean_base"),
        F.avg(F.when(is_cur, v)).alias("mean_cur"),
        F.stddev_samp(F.when(~is_cur, v)).alias("std_base"),
        F.stddev_samp(F.when(is_cur, v)).alias("std_cur"),
        (F.count(F.when(~is_cur & v.isNull(), 1)) / F.count(F.when(~is_cur, 1))).alias("null_rate_base"),
        (F.count(F.when(is_cur & v.isNull(), 1)) / F.count(F.when(is_cur, 1))).alias("null_rate_cur"),
    )
    return agg.withColumns({
        "mean_delta": F.col("mean_cur") - F.col("mean_base"),
        "std_delta": F.col("std_cur") - F.col("std_base"),
    })
