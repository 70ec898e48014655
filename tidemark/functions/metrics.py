"""Regression-quality metrics as mergeable states.

Every metric is derived from five values over scored rows, so batch, per-slice,
rollup and streaming results share one definition and partial aggregation
keeps a single small state per task, however large a slice is:

    n, sum(e^2), sum(|e|), sum(y), syy      with e = y - p

RMSE = sqrt(sse / n), MAE = sae / n, R2 = 1 - sse / syy.  syy is the centred
sum of squares of the label (``regr_syy``), which Spark merges by counts and
means, so a label that varies little around a large value keeps its digits.
R2 is the coefficient of determination, not the squared correlation, and is
NULL when syy is 0 (constant label).  Rows whose label or prediction is NULL
are left out of every value and counted in ``n_null``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def metric_sums(label: str = "actual_quantity", pred: str = "predicted_quantity") -> list[Column]:
    y, p = F.col(label), F.col(pred)
    ok = y.isNotNull() & p.isNotNull()
    e = y - p
    return [
        F.count(F.when(ok, 1)).alias("n_scored"),
        F.count(F.when(~ok, 1)).alias("n_null"),
        F.sum(F.when(ok, e * e)).alias("sse"),
        F.sum(F.when(ok, F.abs(e))).alias("sae"),
        F.sum(F.when(ok, y)).alias("sum_y"),
        F.regr_syy(F.when(ok, y), F.when(ok, y)).alias("syy"),
    ]


def metrics_from_sums(n: str = "n_scored", sse: str = "sse", sae: str = "sae", syy: str = "syy") -> dict[str, Column]:
    nn = F.col(n).cast("double")
    return {
        "rmse": F.sqrt(F.col(sse) / nn),
        "mae": F.col(sae) / nn,
        "r2": 1 - F.col(sse) / F.nullif(F.col(syy), F.lit(0.0)),
    }
