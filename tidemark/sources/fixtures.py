"""Adapters that present the driver tables in the shapes the workflow uses.

Sales fact + two dimensions come from the TPC-H-like tables; the run log,
metric history, tags and model registry come from ``events``.  Every adapter
is a lazy DataFrame over the given tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..session import materialize
from ..operators.ordering import number_in_groups
from .tables import read_table


def orders(spark: SparkSession, base: str) -> DataFrame:
    """Sales orders: the customer and payment method that their line items share."""
    return read_table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"]).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("payment_method"))


def transactions(spark: SparkSession, base: str, with_orders: DataFrame | None = None) -> DataFrame:
    """Sales fact: one row per line item, with a real 4-part key.

    ``with_orders`` are the :func:`orders` with further columns, which the
    fact keeps.  They are joined after the parts: the rows that this join
    shuffles carry the part's texts, which are fewer than the order's.
    """
    li = read_table(spark, base, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate"])
    od = orders(spark, base) if with_orders is None else with_orders
    more = [c for c in od.columns if c not in ("order_id", "customer_id", "payment_method")]
    pt = read_table(spark, base, "part", ["p_partkey", "p_name", "p_type"])
    joined = (li.join(pt, li.l_partkey == pt.p_partkey, "inner")
              .join(od, li.l_orderkey == od.order_id, "inner"))
    return joined.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
                    ).alias("transaction_id"),
        "customer_id",
        F.col("l_suppkey").alias("franchise_id"),
        F.col("l_shipdate").alias("date_time"),
        F.col("p_name").alias("product"),
        F.col("p_type").alias("product_type"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        "payment_method",
        (F.col("l_linenumber") % 3 + 1).cast("string").alias("fixture_version"), *more,
    )


def _nation_region(spark: SparkSession, base: str) -> DataFrame:
    # nation (25 rows) and region (5 rows) have a fixed size at every scale.
    nation = read_table(spark, base, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, base, "region", ["r_regionkey", "r_name"])
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "inner")


def customers(spark: SparkSession, base: str) -> DataFrame:
    cust = read_table(spark, base, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    geo = _nation_region(spark, base)
    return cust.join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey, "inner").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("gender"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("continent"),
    )


def franchises(spark: SparkSession, base: str) -> DataFrame:
    sup = read_table(spark, base, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    geo = _nation_region(spark, base)
    return sup.join(F.broadcast(geo), sup.s_nationkey == geo.n_nationkey, "inner").select(
        F.col("s_suppkey").alias("franchise_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("city"),
        F.when(F.col("s_acctbal") < 2500, "S").when(F.col("s_acctbal") < 6500, "M")
        .otherwise("L").alias("size"),
        F.col("r_name").alias("country"),
    )


def segment_mean_predictions(tx: DataFrame) -> DataFrame:
    """Deterministic stand-in model: the mean label of the product type.

    Written as aggregate + join rather than ``avg() OVER (PARTITION BY type)``:
    the aggregate is partial per task, so a type holding a third of all rows
    never lands in one task.  The per-type table (one row per type) is
    materialised and measured, then broadcast, so the fact is never
    shuffled by type (a handful of hot keys); if it were too large it would
    be a shuffle join handled by AQE's skew rule.  The columns of the fact that
    both reads need are stored, so that its joins run once.
    """
    tx = materialize(tx.select("transaction_id", "product_type", "quantity", "fixture_version", "date_time"), "sales")
    means = tx.groupBy("product_type").agg(F.avg("quantity").alias("predicted_quantity"))
    means = checked_broadcast(materialize(means, "type-means"))
    return tx.join(means, "product_type", "inner").select(
        "transaction_id",
        F.col("quantity").alias("actual_quantity"),
        "predicted_quantity",
        (F.col("quantity") - F.col("predicted_quantity")).alias("residual"),
        F.col("fixture_version").alias("model_version"),
        F.col("date_time").alias("scored_at"),
    )


def predictions(spark: SparkSession, base: str) -> DataFrame:
    return segment_mean_predictions(transactions(spark, base))


def _events(spark: SparkSession, base: str, cols: list[str]) -> DataFrame:
    return read_table(spark, base, "events", cols)


def experiments(spark: SparkSession, base: str) -> DataFrame:
    ev = _events(spark, base, ["user_id"])
    return (ev.select((F.col("user_id") % 5).alias("experiment_id")).distinct()
            .select("experiment_id",
                    F.concat(F.lit("exp_"), F.col("experiment_id").cast("string")).alias("name")))


def runs(spark: SparkSession, base: str) -> DataFrame:
    ev = _events(spark, base, ["user_id", "ts", "event_type"])
    errors = F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0))
    return ev.groupBy("user_id").agg(
        F.when(errors > 15, "FAILED").otherwise("FINISHED").alias("status"),
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
    ).select(
        F.col("user_id").alias("run_id"),
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_name"),
        "status", "start_time", "end_time",
        (F.col("user_id") % 5).alias("experiment_id"),
    )


def metric_name_expr() -> F.Column:
    et = F.col("event_type")
    return (F.when(et == "view", "batch_rmse").when(et == "click", "batch_mae")
            .when(et == "purchase", "batch_r2").when(et == "signup", "rmse")
            .otherwise("other"))


def metrics(spark: SparkSession, base: str, with_step: bool = True) -> DataFrame:
    """Metric history; ``step`` counts the logs of one (run, event type)."""
    ev = _events(spark, base, ["event_id", "user_id", "event_type", "value", "ts"])
    if with_step:
        ev = number_in_groups(ev, ["user_id", "event_type"], ["ts", "event_id"], out="step")
    cols = [
        F.col("user_id").alias("run_id"),
        metric_name_expr().alias("metric_name"),
        F.when(F.col("event_type") == "purchase", 1 - F.col("value") / 100)
        .otherwise(F.col("value") / 10).alias("metric_value"),
        F.col("ts").alias("metric_time"),
    ]
    if with_step:
        cols.append(F.col("step"))
    return ev.select(*cols)


def run_tags(spark: SparkSession, base: str) -> DataFrame:
    ev = _events(spark, base, ["user_id"]).distinct()
    return ev.select(
        F.col("user_id").alias("run_id"),
        F.lit("drift_simulation").alias("key"),
        F.when(F.col("user_id") % 10 == 0, "true").otherwise("false").alias("value"),
    )


def model_versions(spark: SparkSession, base: str) -> DataFrame:
    """Registry rows; the version counter runs per model name (7 names)."""
    ev = _events(spark, base, ["event_id", "user_id", "event_type", "ts"]).filter(
        F.col("event_type") == "signup").withColumn("_model", F.col("user_id") % 7)
    numbered = number_in_groups(ev, ["_model"], ["ts", "event_id"], out="_v", group_bound=7)
    return numbered.select(
        F.concat(F.lit("model_"), F.col("_model").cast("string")).alias("name"),
        F.col("_v").cast("string").alias("version"),
        F.col("ts").alias("creation_timestamp"),
        F.lit("READY").alias("status"),
        F.col("event_id").alias("run_id"),
    )


def payload(spark: SparkSession, base: str) -> DataFrame:
    """Request/response log: JSON request text plus arrival time."""
    ev = _events(spark, base, ["event_id", "ts", "props"])
    return ev.select(F.col("event_id").alias("request_id"),
                     F.col("props").alias("request"), F.col("ts").alias("arrival_time"))


def payload_calls(spark: SparkSession, base: str) -> DataFrame:
    """Request/response log with up to four records a request; a few calls are cut off, empty, failed or short."""
    ev = _events(spark, base, ["event_id", "ts", "event_type", "props"])
    record = F.struct("event_id", F.from_json("props", "k INT")["k"].alias("k"), "event_type")
    calls = (ev.groupBy(F.expr("event_id div 4").alias("request_id"))
             .agg(F.max("ts").alias("arrival_time"), F.sort_array(F.collect_list(record)).alias("r")))
    request = F.to_json(F.struct(F.col("r").alias("dataframe_records")))
    response = F.to_json(F.struct(F.transform("r", lambda r: r["event_id"] % 100 + F.lit(0.5)).alias("predictions")))
    odd = F.col("request_id") % 17
    return calls.select(
        "request_id", "arrival_time",
        F.when(odd == 3, F.left(request, F.length(request) - 3)).when(odd == 5, '{"inputs":[]}').otherwise(request).alias("request"),
        F.when(odd == 7, F.lit(None)).when(odd == 9, '{"error":"timeout"}').when(odd == 11, '{"predictions":[1.5]}').otherwise(response).alias("response"))
