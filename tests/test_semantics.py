"""Unit frames for the semantic traps (NULL, NaN, thresholds, versions, joins)."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import encode as enc
from tidemark.operators import features as feat
from tidemark.operators import gate as gt
from tidemark.operators import metrics as met
from tidemark.operators import registry as reg
from tidemark.operators import runlog as rl
from tidemark.operators import sinks as sk
from tidemark.operators import split as spl
from tidemark.session import scratch_path

SCORED = "actual_quantity double, predicted_quantity double, model_version string"


def test_r2_is_coefficient_of_determination_not_squared_correlation(spark):
    df = spark.createDataFrame([(1.0, 3.0, "1"), (2.0, 2.0, "1"), (3.0, 1.0, "1")], SCORED)
    m = met.batch_metrics(df).first()
    assert m.r2 == pytest.approx(1 - 8 / 2)
    assert m.rmse >= m.mae >= 0


def test_constant_label_gives_null_r2_and_null_label_is_counted(spark):
    df = spark.createDataFrame([(5.0, 4.0, "1"), (5.0, 6.0, "1"), (None, 1.0, "1")], SCORED)
    m = met.batch_metrics(df).first()
    assert m.r2 is None and m.n_scored == 2 and m.n_null == 1
    assert m.rmse == pytest.approx(1.0)


def test_empty_input_gives_one_row_of_nulls(spark):
    df = spark.createDataFrame([], SCORED)
    m = met.batch_metrics(df).collect()
    assert len(m) == 1 and m[0].n_scored == 0 and m[0].rmse is None


def test_rollup_total_matches_pooled(spark):
    df = spark.createDataFrame([(1.0, 2.0, "1"), (3.0, 1.0, "2"), (4.0, 4.5, "2")], SCORED)
    rows = {r.model_version: r for r in met.metrics_rollup(df).collect()}
    pooled = met.batch_metrics(df).first()
    assert rows[None].is_total and rows[None].rmse == pytest.approx(pooled.rmse)
    assert rows[None].r2 == pytest.approx(pooled.r2)


def test_gate_rules(spark):
    rows = [("nan", float("nan"), float("nan")), ("equal", 5.0, 0.5), ("missing", None, None),
            ("rmse", 5.0001, 0.9), ("r2", 1.0, 0.4999)]
    df = spark.createDataFrame(rows, "run_id string, batch_rmse double, batch_r2 double")
    got = {r.run_id: (r.rmse_breach, r.r2_breach, r.retrain_needed)
           for r in gt.evaluate(df, keep=["run_id"]).collect()}
    assert got["nan"] == (False, False, False)
    assert got["equal"] == (False, False, False)
    assert got["missing"] == (False, False, False)
    assert got["rmse"] == (True, False, True)
    assert got["r2"] == (False, True, True)


def test_empty_run_log_gives_null_gate_row(spark):
    s = spark.createDataFrame([], "run_id string, start_time timestamp_ntz, batch_rmse double, batch_r2 double")
    newest = rl.newest_run(s, ["run_id", "batch_rmse", "batch_r2"])
    g = gt.evaluate(newest, keep=["run_id"]).collect()
    assert len(g) == 1 and g[0].run_id is None and g[0].retrain_needed is False


def test_guarded_gate(spark):
    df = spark.createDataFrame(
        [("a", 9.0, 0.1, "2024-01-02", "2024-01-01"), ("b", 9.0, 0.1, "2024-01-01", "2024-01-02"),
         ("c", 9.0, 0.1, "2024-01-01", None)],
        "run_id string, batch_rmse double, batch_r2 double, bt string, rt string")
    g = gt.evaluate(df, keep=["run_id", "bt", "rt"])
    got = {r.run_id: r.retrain_needed for r in gt.guarded(g, "bt", "rt").collect()}
    assert got == {"a": True, "b": False, "c": True}


def test_versions_order_numerically(spark):
    mv = spark.createDataFrame([("m", "9", 1), ("m", "10", 2), ("m", "2", 3)],
                               "name string, version string, run_id int") \
        .withColumn("creation_timestamp", F.current_timestamp().cast("timestamp_ntz")) \
        .withColumn("status", F.lit("READY"))
    assert reg.latest_versions(mv).first().latest_version == "10"
    assert [r.version for r in reg.version_history(mv, "m").collect()] == ["10", "9", "2"]


def test_alias_upsert_and_promote_twice_keeps_one_alias_row(spark):
    mv = spark.createDataFrame([("dev", "1", 11, "2024-01-01"), ("dev", "2", 12, "2024-01-02")],
                               "name string, version string, run_id int, t string") \
        .select("name", "version", "run_id", F.col("t").cast("timestamp_ntz").alias("creation_timestamp"),
                F.lit("READY").alias("status"))
    dev_alias = reg.champion_from_latest(mv)
    prod = mv.filter("false")
    prod_alias = dev_alias.filter("false")
    for i in range(2):
        prod, prod_alias = reg.promote(mv, dev_alias, prod, prod_alias,
                                       lambda c: F.lit("prod"), F.lit(f"2024-02-0{i + 1}"))
    assert sorted(r.version for r in prod.collect()) == ["1", "2"]
    aliases = prod_alias.collect()
    assert len(aliases) == 1 and aliases[0].version == "2"
    assert {r.run_id for r in prod.collect()} == {12}


def test_left_join_keeps_unmatched_and_reports_duplicates(spark):
    tx = spark.createDataFrame([("t1", 1, 10), ("t2", 2, 10), ("t3", 3, 99)],
                               "transaction_id string, customer_id int, franchise_id int") \
        .withColumns({"date_time": F.current_timestamp(), "product": F.lit("p"), "quantity": F.lit(1.0),
                      "unit_price": F.lit(2.0), "payment_method": F.lit("cash")})
    cust = spark.createDataFrame([(1, "F", "S", "EU"), (2, "M", "S", "EU"), (2, "M", "T", "EU")],
                                 "customer_id int, gender string, state string, continent string")
    fr = spark.createDataFrame([(10, "n", "c", "S", "X")],
                               "franchise_id int, name string, city string, size string, country string")
    out = feat.enrich(tx, cust, fr)
    assert out.count() == 4  # t2 fans out over the duplicate key
    assert out.filter("transaction_id = 't3'").first().franchise_name is None
    q = {r.dimension: r for r in feat.join_quality(tx, "customer_id", cust, "customer_id", "c")
         .unionByName(feat.join_quality(tx, "franchise_id", fr, "franchise_id", "f")).collect()}
    assert (q["c"].n_unmatched, q["c"].n_duplicate_keys, q["c"].n_extra_rows) == (1, 1, 1)
    assert q["f"].n_unmatched == 1


def test_unknown_and_null_categories_encode_to_minus_one(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "product string")
    test = spark.createDataFrame([("c",), ("zzz",), (None,)], "product string")
    vocab = enc.fit_vocab(train, ["product"], materialize=False)
    assert {r.value: r.code for r in vocab.collect()} == {"a": 0, "b": 1, "c": 2}
    codes = [r.product for r in enc.apply_vocab(test, vocab, ["product"]).collect()]
    assert sorted(codes) == [-1, -1, 2]


def test_split_disjoint_complete_and_layout_free(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("transaction_id"))
    a = {(r.transaction_id, r.split) for r in spl.assign_split(df).collect()}
    b = {(r.transaction_id, r.split) for r in spl.assign_split(df.repartition(7)).collect()}
    assert a == b and len(a) == 5000
    share = sum(1 for _, s in a if s == "test") / 5000
    assert 0.17 < share < 0.23


def test_sink_schema_check_idempotent_append_and_delete(spark):
    path = scratch_path(spark, "t")
    rows = spark.createDataFrame([("a", 1.0, "2024-01-01 00:00:00"), ("b", 2.0, "2024-01-03 00:00:00")],
                                 "k string, v double, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    sk.write_table(rows, path)
    again = sk.append_idempotent(spark, rows, path, ["k"])
    assert again.count() == 0 and spark.read.parquet(path).count() == 2
    with pytest.raises(sk.SchemaMismatch):
        sk.append_idempotent(spark, rows.withColumn("extra", F.lit(1)), path, ["k"])
    nulls = spark.createDataFrame([("c", 3.0, None)], "k string, v double, t timestamp_ntz")
    sk.append_idempotent(spark, nulls, path, ["k"])
    kept = sk.delete_where(spark, path, F.col("t") > F.lit("2024-01-02").cast("timestamp_ntz"))
    assert sorted(r.k for r in spark.read.parquet(kept).collect()) == ["a", "c"]


def test_map_lookup_default(spark):
    from tidemark.functions.guards import map_get
    df = spark.createDataFrame([({"drift_simulation": "true"},), ({},)], "tags map<string,string>")
    got = [r.x for r in df.select(map_get("tags", "drift_simulation", "false").alias("x")).collect()]
    assert got == ["true", "false"]


def test_nan_is_cleaned_before_compare(spark):
    from tidemark.functions.guards import breach_above
    df = spark.createDataFrame([(math.nan,)], "x double")
    assert df.select(breach_above("x", 5.0).alias("b")).first().b is False


def test_quoted_table_name_and_drop_table(spark):
    from tidemark.sources.tables import read_named
    spark.range(3).createOrReplaceTempView("shop_payload")
    assert read_named(spark, "shop_payload").count() == 3
    spark.range(2).write.mode("overwrite").saveAsTable("tm_drop_me")
    sk.drop_table(spark, "tm_drop_me")
    sk.drop_table(spark, "tm_drop_me")  # IF EXISTS: second drop is a no-op
    assert not spark.catalog.tableExists("tm_drop_me")


def test_environment_selects_schema_and_model_name():
    from tidemark.config import WatchConfig
    assert WatchConfig("dev").schema_name == "dev_mlops"
    assert WatchConfig("prod", "autolog").model_name == "prod_mlops.autolog_model"


def test_json_records_round_trip(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    out = sk.json_records(df, keep=["id"])
    back = out.select("id", F.from_json("record", "id int, s string").alias("r"))
    assert sorted((r.id, r.r.s) for r in back.collect()) == [(1, "a"), (2, None)]


def test_exclude_tags_keeps_untagged_and_missing(spark):
    s = spark.createDataFrame([("a", "true"), ("b", "false"), ("c", None)],
                              "run_id string, drift_simulation string")
    kept = sorted(r.run_id for r in rl.without_tags(s, {"drift_simulation": "true"}).collect())
    assert kept == ["b", "c"]
    assert rl.without_tags(s, {}).count() == 3
