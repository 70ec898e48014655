"""Drift properties and physical-plan checks."""

from pyspark.sql import functions as F

from places import SMALL
from tidemark.operators import drift as dr
from tidemark.plans import QUERIES


def test_psi_and_ks_zero_for_identical_windows(spark):
    df = spark.range(2000).select((F.col("id") % 37).cast("double").alias("x"),
                                  (F.col("id") % 5).cast("string").alias("c"))
    assert all(abs(r.psi) < 1e-12 for r in dr.psi_numeric(df, df, ["x"]).collect())
    assert all(r.ks == 0 for r in dr.ks_numeric(df, df, ["x"]).collect())
    assert all(abs(r.psi) < 1e-12 for r in dr.psi_categorical(df, df, ["c"]).collect())


def test_psi_positive_for_shift(spark):
    a = spark.range(2000).select((F.col("id") % 100).cast("double").alias("x"))
    b = a.select((F.col("x") * 0.5).alias("x"))
    assert dr.psi_numeric(a, b, ["x"]).first().psi > 0.1
    assert 0 < dr.ks_numeric(a, b, ["x"]).first().ks <= 1


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_python_udf_in_batch_plans(spark):
    for name in ["enriched_transactions", "metrics_by_version", "drift_psi", "metric_trend",
                 "gate", "ordinal_encoded", "perturbed_features"]:
        plan = _plan(QUERIES[name](spark, SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_scan_prunes_columns_and_small_dims_broadcast(spark):
    df = QUERIES["enriched_transactions"](spark, SMALL)
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    formatted = _formatted(df)
    # the lineitem scan reads only the 7 columns the fact needs
    assert "l_discount" not in formatted and "l_tax" not in formatted


def test_metric_history_pushes_filters_to_scans(spark):
    df = QUERIES["metric_history"](spark, SMALL)
    formatted = _formatted(df)
    assert "PushedFilters" in formatted
