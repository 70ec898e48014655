"""Shapes that decide how shuffles and partitions grow, with the results that they must keep."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift as dr
from tidemark.operators import encode as enc
from tidemark.operators import features as feat
from tidemark.operators import sinks as sk
from tidemark.operators import train as tr
from tidemark.plans import drift_queries, ml_queries
from tidemark.session import scratch_path
from tidemark.sources import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_training_partitions_grow_slower_than_small_tables_need():
    assert [tr.layout_partitions(n) for n in (0, 1, 50_000, 50_001, 480_000)] == [1, 1, 1, 2, 10]
    assert tr.layout_partitions(2_900_000) == 12
    assert tr.layout_partitions(29_000_000) == 58


def _sales(spark):
    orders = spark.createDataFrame([(1, 10, "cash"), (2, 11, "card"), (3, None, None), (3, 10, "card")],
                                   "order_id long, customer_id long, payment_method string")
    lines = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, "c", 5), (3, "d", 6), (4, "e", 5)],
                                  "line_order long, transaction_id string, franchise_id long").withColumns({
        "date_time": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "product": F.lit("p"), "quantity": F.lit(1.0), "unit_price": F.lit(2.0)})
    customers = spark.createDataFrame([(10, "F", "S", "EU"), (10, "M", "T", "EU"), (None, "x", "x", "x")],
                                      "customer_id long, gender string, state string, continent string")
    franchises = spark.createDataFrame([(5, "n", "c", "S", "X")], "franchise_id long, name string, city string, size string, country string")
    return orders, lambda o: lines.join(o, lines.line_order == o.order_id), customers, franchises


def test_customers_joined_to_orders_give_the_rows_of_the_fact_join(spark):
    orders, sales, customers, franchises = _sales(spark)
    of_fact = feat.enrich(sales(orders), customers, franchises)
    of_orders = feat.enrich(sales, customers, franchises, orders=orders)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(of_fact) == rows(of_orders) and of_orders.count() == 8


def test_customers_beyond_the_broadcast_limit_do_not_shuffle_the_fact(spark):
    orders, sales, customers, franchises = _sales(spark)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(feat.enrich(sales, customers, franchises, broadcast_limit=0, orders=orders))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    # the outermost join is printed first: the one with the lines, and the customers' below it
    assert plan.index("hashpartitioning(line_order") < plan.index("hashpartitioning(customer_id")


def test_large_vocabularies_are_joined_last(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "product string, gender string")
    vocab = spark.createDataFrame([("product", "a", 0), ("product", "b" * 50, 1), ("gender", "x", 0)], "column_name string, value string, code int")
    out = enc.apply_vocab(df, vocab, ["product", "gender"])
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.index("_v_product") < plan.index("_v_gender")  # the outermost join is printed first
    assert out.columns == ["product", "gender"] and sorted(map(tuple, out.collect())) == [(-1, -1), (0, 0)]


def test_append_reads_and_shuffles_only_what_may_be_equal(spark, monkeypatch):
    path, plans = scratch_path(spark, "t"), []
    monkeypatch.setattr(sk, "materialize", lambda df, name: plans.append(_plan(df)) or keep(df, name))
    keep = drift_queries.materialize
    old = spark.createDataFrame([("a", None, 1.0), ("b", "y", 2.0), (None, "x", 3.0)], "k string, part string, v double")
    sk.write_table(old, path, "overwrite", ["part"])
    new = spark.createDataFrame([("a", None, 7.0), ("a", "y", 4.0), ("b", "y", 5.0), (None, "x", 6.0), (None, "y", 8.0), (None, "y", 8.0)],
                                "k string, part string, v double")
    added = sk.append_idempotent(spark, new, path, ["k"], ["part"])
    assert sorted(map(str, added.collect())) == sorted(map(str, [r for r in new.distinct().collect() if r.v in (4.0, 8.0)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sk.append_idempotent(spark, new, path, ["k"], ["part"]).count() == 0
        assert sk.append_idempotent(spark, new.where("part = 'y'"), path, ["k"], ["part"]).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[-1].count("Exchange hashpartitioning") == 2  # the new rows and the table's keys, once each


def test_predictions_join_their_fact_once(spark, monkeypatch):
    tx = spark.createDataFrame([("t1", "a", 1.0, "1", "2024-01-01"), ("t2", "a", 3.0, "2", None), ("t3", None, 3.0, "2", None)],
                               "transaction_id string, product_type string, quantity double, fixture_version string, date_time string")
    out = fx.segment_mean_predictions(tx)
    assert sorted((r.transaction_id, r.predicted_quantity, r.residual) for r in out.collect()) == [("t1", 2.0, -1.0), ("t2", 2.0, 1.0)]
    assert "ExistingRDD" not in _plan(out)  # reads the stored rows


def test_drift_windows_are_stored_once(spark, monkeypatch):
    cols = ["unit_price", "hour", "day_of_week", "month", "day_of_month"]
    f = spark.range(50).select(F.col("id").cast("string").alias("transaction_id"), (F.col("id") * 1.5).alias("unit_price"),
                               *[(F.col("id") % 7).cast("int").alias(c) for c in cols[1:]])
    calls = []
    monkeypatch.setattr(drift_queries, "features", lambda *a: calls.append(a) or f)
    got = {r.column_name: r.psi for r in drift_queries.q_drift_psi(spark, "").collect()}
    plain = dr.psi_numeric_long(drift_queries._long_pair(spark, ""), edges=dr.baseline_edges(f, cols))
    assert got == pytest.approx({r.column_name: r.psi for r in plain.collect()})
    assert len(calls) == 2  # once by the query, once by the plain form


def test_copies_are_numbered_like_in_groups(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 0.5), ("b", 2.0), (None, 3.0), (None, None), ("c", None)], "k string, v double")
    got = ml_queries._number_copies(rows, ["k"], ["v"], "copy")
    assert sorted(map(str, got.collect())) == sorted(map(str, ml_queries.number_in_groups(rows, ["k"], ["v"], out="copy").collect()))
