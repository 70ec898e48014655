"""Forest determinism, model round trip, streaming = batch."""

from pyspark.sql import functions as F

from places import SMALL
from tidemark.plans import QUERIES


def test_canonical_layout_makes_fit_layout_free(spark):
    r = QUERIES["canonical_layout_check"](spark, SMALL).first()
    assert r.n_rows > 0 and r.n_different == 0


def test_reloaded_model_scores_every_row_with_real_keys(spark):
    df = QUERIES["rf_score_reloaded"](spark, SMALL)
    # sf0.001 holds one repeated 4-part key, so compare with the input rows
    assert df.count() == QUERIES["feature_frame"](spark, SMALL).count()
    assert df.filter(F.col("predicted_quantity").isNull()).count() == 0


def test_predictions_and_shifted_scores_are_tables(spark, monkeypatch):
    import datetime

    from tidemark.operators import sinks
    from tidemark.plans import ml_queries as ml

    wrote, appended = [], []
    write, append = sinks.write_table, ml.append_stress
    monkeypatch.setattr(ml.sk, "write_table", lambda df, path, *a: wrote.append(path) or write(df, path, *a))
    monkeypatch.setattr(ml, "append_stress", lambda *a: appended.append(a) or append(*a))
    scored = QUERIES["rf_score"](spark, SMALL)
    keys = ["transaction_id", "model_version", "scored_at"]
    assert len(wrote) == 1 and spark.read.parquet(wrote[0]).select(keys).exceptAll(scored.select(keys)).count() == 0 < scored.count()
    got = {r.window: r.n_scored for r in QUERIES["rf_stress_metrics"](spark, SMALL).collect()}
    (_, model, stressed, path), = appended
    rows = {(r.run_kind, r.scored_at): r.n for r in spark.read.parquet(path).groupBy("run_kind", "scored_at").agg(F.count(F.lit(1)).alias("n")).collect()}
    every = QUERIES["feature_frame"](spark, SMALL).count()
    assert rows == {("baseline", datetime.datetime(2024, 2, 1)): scored.count(), ("drift", datetime.datetime(2024, 2, 2)): every}
    assert got["baseline"] == got["stress_holdout"] <= scored.count() and got["stress"] <= every
    assert append(spark, model, stressed, path).count() == 0


def test_run_log_tables_are_appended(spark):
    from tidemark.operators import runlog
    from tidemark.plans import drift_queries

    path = drift_queries.append_batch_log(spark, SMALL)
    log = runlog.read_run_log(spark, path)
    n = {r.kind: r.n for r in log.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = log.select("run_id").distinct().count()
    assert runs > 0 and n == {"metric": 3 * runs, "param": 2 * runs, "tag": runs}
    assert spark.read.parquet(f"{path}/run_tags").filter("key = 'drift_simulation' AND value = 'false'").count() == runs
    runlog.append_run_log(spark, log, path)
    assert runlog.read_run_log(spark, path).count() == log.count()


def test_sweep_and_best(spark):
    sweep = QUERIES["rf_sweep"](spark, SMALL).collect()
    assert [r.sweep_index for r in sorted(sweep, key=lambda r: r.sweep_index)] == [1, 2, 3, 4]
    assert all(r.rmse >= r.mae >= 0 for r in sweep)


def test_stream_closed_windows_equal_batch(spark):
    stream = QUERIES["stream_daily_metrics"](spark, SMALL)
    batch = QUERIES["metrics_by_day_version"](spark, SMALL)
    joined = stream.join(batch, ["window_start", "model_version"], "left_anti")
    assert stream.count() > 0 and joined.count() == 0


def test_signature_mismatch_is_refused(spark):
    import pytest
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from tidemark.operators import train as tr
    from tidemark.session import scratch_path

    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v")]).fit(df)
    vocab = spark.createDataFrame([("c", "x", 0)], "column_name string, value string, code int")
    path = tr.save(model, vocab, scratch_path(spark, "sig"), signature=df)
    tr.check_signature(df, path)  # same columns: fine
    with pytest.raises(ValueError):
        tr.check_signature(df.drop("b"), path)
    loaded, loaded_vocab = tr.load(spark, path)
    assert loaded_vocab.count() == 1 and loaded.transform(df).count() == 1
