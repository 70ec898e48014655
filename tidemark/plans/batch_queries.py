"""Registered batch queries over the fixture adapters (features and metrics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import metrics as met
from ..sources import fixtures as fx
from .oracle_views import with_views
from .registry import query

R = 6  # rounding digits in oracle SQL


def enriched(spark: SparkSession, base: str) -> DataFrame:
    return feat.enrich(lambda orders: fx.transactions(spark, base, orders), fx.customers(spark, base),
                       fx.franchises(spark, base), orders=fx.orders(spark, base))


def features(spark: SparkSession, base: str) -> DataFrame:
    return feat.feature_frame(enriched(spark, base))


_METRIC_SQL = f"""count(CASE WHEN actual_quantity IS NOT NULL AND predicted_quantity IS NOT NULL THEN 1 END) AS n_scored,
       count(CASE WHEN actual_quantity IS NULL OR predicted_quantity IS NULL THEN 1 END) AS n_null,
       round(sqrt(avg((actual_quantity - predicted_quantity) ^ 2)), {R}) AS rmse,
       round(avg(abs(actual_quantity - predicted_quantity)), {R}) AS mae,
       round(1 - sum((actual_quantity - predicted_quantity) ^ 2) / nullif(regr_syy(actual_quantity, actual_quantity), 0), {R}) AS r2"""


@query("enriched_transactions", with_views(f"""
SELECT transaction_id, date_time, product, quantity, unit_price,
       payment_method, gender, state, customer_continent, franchise_name, franchise_city,
       franchise_size, franchise_country
FROM enriched""", "enriched"), raw=("unit_price",))
def q_enriched_transactions(spark: SparkSession, base: str) -> DataFrame:
    """Fact left-joined to customers and franchises."""
    return enriched(spark, base)


@query("batch_metrics", with_views(f"SELECT {_METRIC_SQL} FROM predictions", "predictions"))
def q_batch_metrics(spark: SparkSession, base: str) -> DataFrame:
    """A2-A5: rows scored, RMSE, MAE, R2 in one aggregate."""
    return met.batch_metrics(fx.predictions(spark, base))


@query("metrics_by_version", with_views(
    f"SELECT model_version, {_METRIC_SQL} FROM predictions GROUP BY model_version", "predictions"))
def q_metrics_by_version(spark: SparkSession, base: str) -> DataFrame:
    """Metrics per model version."""
    return met.metrics_by(fx.predictions(spark, base), ["model_version"])


# ---------------------------------------------------------------------------
# features, split, encoding, stress copy
# ---------------------------------------------------------------------------
from ..config import CATEGORICAL_COLS, DRIFT_SEED, NUMERIC_COLS, SPLIT_SEED  # noqa: E402
from ..functions.calendar import calendar_columns  # noqa: E402
from ..functions.hashing import sql_hash_uniform, sql_hash_uniforms  # noqa: E402
from ..operators import encode as enc  # noqa: E402
from ..operators import perturb as pert  # noqa: E402
from ..operators import split as spl  # noqa: E402
from ..operators.ordering import number_in_groups  # noqa: E402
from ..session import materialize  # noqa: E402
from ..sources.tables import read_table  # noqa: E402

_SPLIT_SQL = (f"CASE WHEN {sql_hash_uniform(SPLIT_SEED, 'transaction_id', 'split')} < 0.2 "
              f"THEN 'test' ELSE 'train' END")
_FEATURE_COLS = ", ".join(CATEGORICAL_COLS + NUMERIC_COLS + ["quantity"])


def _split_view() -> tuple[str, str]:
    return ("split_rows", f"SELECT *, {_SPLIT_SQL} AS split FROM features")


@query("calendar_features", f"""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
       CAST(month(ts) AS INTEGER) AS month, CAST(dayofmonth(ts) AS INTEGER) AS day_of_month
FROM events""")
def q_calendar_features(spark: SparkSession, base: str) -> DataFrame:
    """P4 X1-X4 on event timestamps (order/ship dates carry no hour)."""
    ev = read_table(spark, base, "events", ["event_id", "ts"])
    return ev.select("event_id", *[c.alias(n) for n, c in calendar_columns("ts").items()])


@query("feature_frame", with_views(f"SELECT transaction_id, {_FEATURE_COLS} FROM features",
                                   "features"), raw=("unit_price",))
def q_feature_frame(spark: SparkSession, base: str) -> DataFrame:
    """Key, 9 categoricals, 5 numerics in fixed order, label."""
    return features(spark, base)


def _quality_sql(dim: str, key: str, fact_key: str, where: str) -> str:
    return f"""
SELECT '{dim}' AS dimension, count(*) AS n_fact_rows,
       count(CASE WHEN k.copies IS NULL THEN 1 END) AS n_unmatched,
       (SELECT count(*) FROM (SELECT {key}, count(*) AS c FROM {dim} WHERE {where} GROUP BY {key}) d
        WHERE d.c > 1) AS n_duplicate_keys,
       CAST(coalesce(sum(CASE WHEN k.copies > 1 THEN k.copies - 1 END), 0) AS BIGINT) AS n_extra_rows
FROM transactions t LEFT JOIN (SELECT {key}, count(*) AS copies FROM {dim} WHERE {where} GROUP BY {key}) k
     ON t.{fact_key} = k.{key}"""


@query("left_join_misses", with_views(
    _quality_sql("customers", "customer_id", "customer_id", "gender <> 'BUILDING'")
    + "\nUNION ALL" + _quality_sql("franchises", "franchise_id", "franchise_id", "TRUE"),
    "transactions", "customers", "franchises"))
def q_left_join_misses(spark: SparkSession, base: str) -> DataFrame:
    """Unmatched / duplicate dimension keys (one segment removed)."""
    tx = fx.transactions(spark, base)
    cust = fx.customers(spark, base).filter(F.col("gender") != "BUILDING")
    return feat.join_quality(tx, "customer_id", cust, "customer_id", "customers").unionByName(
        feat.join_quality(tx, "franchise_id", fx.franchises(spark, base), "franchise_id",
                          "franchises"))


@query("split_counts", with_views("SELECT split, count(*) AS n_rows FROM split_rows GROUP BY split",
                                  "features", extra=[_split_view()]))
def q_split_counts(spark: SparkSession, base: str) -> DataFrame:
    """Deterministic 80/20 split sizes."""
    return spl.split_sizes(features(spark, base))


@query("split_members", with_views("SELECT transaction_id, split FROM split_rows",
                                   "features", extra=[_split_view()]))
def q_split_members(spark: SparkSession, base: str) -> DataFrame:
    """M1: side of every row (stable under repartitioning)."""
    return spl.assign_split(features(spark, base).select("transaction_id"))


def _stack_sql(src: str, where: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {src} WHERE {where}"
        for c in CATEGORICAL_COLS)


_VOCAB_SQL = f"""
SELECT column_name, value,
       CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT column_name, value FROM ({_stack_sql('split_rows', "split = 'train'")}) s
      WHERE value IS NOT NULL) d"""


@query("category_vocab", with_views("SELECT * FROM vocab", "features",
                                    extra=[_split_view(), ("vocab", _VOCAB_SQL)]))
def q_category_vocab(spark: SparkSession, base: str) -> DataFrame:
    """Sorted distinct categories of the training side -> codes."""
    train, _ = spl.train_test(features(spark, base))
    return enc.fit_vocab(train)


def _encoded_sql() -> str:
    joins, sel = [], []
    for i, c in enumerate(CATEGORICAL_COLS):
        joins.append(f"LEFT JOIN vocab v{i} ON v{i}.column_name = '{c}' AND v{i}.value = CAST(t.{c} AS VARCHAR)")
        sel.append(f"CAST(coalesce(v{i}.code, -1) AS INTEGER) AS {c}")
    nums = ", ".join(f"t.{c}" for c in NUMERIC_COLS)
    return (f"SELECT t.transaction_id, {', '.join(sel)}, {nums}, t.quantity\n"
            f"FROM split_rows t {' '.join(joins)}\nWHERE t.split = 'test'")


@query("ordinal_encoded", with_views(_encoded_sql(), "features",
                                     extra=[_split_view(), ("vocab", _VOCAB_SQL)]),
       raw=("unit_price",))
def q_ordinal_encoded(spark: SparkSession, base: str) -> DataFrame:
    """M2: test rows encoded with the training vocabulary; unseen -> -1.

    The split feature frame is materialised once and read by both the
    vocabulary fit and the encoding (instead of re-running its joins)."""
    split = materialize(spl.assign_split(features(spark, base)), "split")
    train = split.filter(F.col("split") == "train").drop("split")
    test = split.filter(F.col("split") == "test").drop("split")
    return enc.apply_vocab(test, enc.fit_vocab(train))


_U = sql_hash_uniforms(DRIFT_SEED, "transaction_id", "stress")

_PERTURB_SQL = f"""
SELECT transaction_id, {", ".join(CATEGORICAL_COLS)},
       unit_price * (CAST({0.1!r} AS DOUBLE) + CAST({5.0 - 0.1!r} AS DOUBLE) * {_U[0]}) AS unit_price,
       CAST(0 + floor(24 * {_U[1]}) AS INTEGER) AS hour,
       CAST(1 + floor(7 * {_U[2]}) AS INTEGER) AS day_of_week,
       CAST(1 + floor(12 * {_U[3]}) AS INTEGER) AS month,
       day_of_month, quantity
FROM features"""


@query("perturbed_features", with_views("SELECT * FROM perturbed", "features",
                                        extra=[("perturbed", _PERTURB_SQL)]), raw=("unit_price",))
def q_perturbed_features(spark: SparkSession, base: str) -> DataFrame:
    """Stress copy with shifted numeric features."""
    return pert.perturb(features(spark, base))


@query("preview_top5", with_views(
    f"SELECT transaction_id, {_FEATURE_COLS} FROM features ORDER BY transaction_id LIMIT 5",
    "features"), raw=("unit_price",))
def q_preview_top5(spark: SparkSession, base: str) -> DataFrame:
    """First five rows by key (a top-k, per-task then merged)."""
    from ..operators.sinks import preview
    return preview(features(spark, base), 5, ["transaction_id"])


_DIGEST_COLS = ["transaction_id", *CATEGORICAL_COLS, "hour", "day_of_week", "month", "day_of_month"]


@query("dataset_digest_md5", with_views(f"""
SELECT count(*) AS n_rows,
       CAST(sum(CAST(('0x' || substr(md5(concat_ws('|', {", ".join(f"CAST({c} AS VARCHAR)" for c in _DIGEST_COLS)},
                                               CAST(CAST(quantity AS BIGINT) AS VARCHAR))), 1, 8)) AS BIGINT)) AS BIGINT) AS digest
FROM features""", "features"))
def q_dataset_digest_md5(spark: SparkSession, base: str) -> DataFrame:
    """A10: order-free content digest (sum of per-row md5 prefixes)."""
    from ..operators.lineage import md5_digest
    return md5_digest(features(spark, base), _DIGEST_COLS, ["quantity"])


_FIELD_SQL = " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in _DIGEST_COLS)
_HALVES_SQL = ", ".join(f"CAST(sum(CAST(('0x' || substr(h, {at}, 16)) AS UBIGINT)) AS VARCHAR) AS {name}" for name, at in (("high", 1), ("low", 17)))


@query("dataset_digest_multiset", with_views(f"""
SELECT coalesce(split, 'all') AS part, count(*) AS n_rows, {_HALVES_SQL}
FROM (SELECT split, md5({_FIELD_SQL}) AS h FROM split_rows) GROUP BY ROLLUP (split)""", "features", extra=[_split_view()]))
def q_dataset_digest_multiset(spark: SparkSession, base: str) -> DataFrame:
    """A10: digest that keeps multiplicities, per side of the split; the whole table's is the sum of its parts'."""
    from ..operators.lineage import add_digests, multiset_digest
    from ..session import materialize
    parts = materialize(multiset_digest(spl.assign_split(features(spark, base)).withColumnRenamed("split", "part"), _DIGEST_COLS, ["part"]), "digests")
    both = parts.unionByName(add_digests(parts).withColumn("part", F.lit("all")))
    return both.select("part", "n_rows", F.col("high").cast("string").alias("high"), F.col("low").cast("string").alias("low"))


@query("dataset_digest")
def q_dataset_digest(spark: SparkSession, base: str) -> DataFrame:
    """A10: row count + xor of xxhash64 over all columns (order-free, JVM-side)."""
    from ..operators.lineage import xxhash_digest
    return xxhash_digest(features(spark, base))


# ---------------------------------------------------------------------------
# metric variants
# ---------------------------------------------------------------------------
_SUMS_SQL = f"""count(CASE WHEN actual_quantity IS NOT NULL AND predicted_quantity IS NOT NULL THEN 1 END) AS n_scored,
       count(CASE WHEN actual_quantity IS NULL OR predicted_quantity IS NULL THEN 1 END) AS n_null,
       round(sqrt(avg((actual_quantity - predicted_quantity) ^ 2)), {R}) AS rmse,
       round(avg(abs(actual_quantity - predicted_quantity)), {R}) AS mae,
       round(1 - sum((actual_quantity - predicted_quantity) ^ 2) / nullif(regr_syy(actual_quantity, actual_quantity), 0), {R}) AS r2"""


@query("metrics_rollup", with_views(f"""
SELECT model_version, GROUPING(model_version) = 1 AS is_total, {_SUMS_SQL}
FROM predictions GROUP BY ROLLUP (model_version)""", "predictions"))
def q_metrics_rollup(spark: SparkSession, base: str) -> DataFrame:
    """Per-version rows and the pooled row from one set of sums."""
    return met.metrics_rollup(fx.predictions(spark, base))


@query("metrics_by_day_version", with_views(f"""
SELECT date_trunc('day', scored_at) AS window_start,
       date_trunc('day', scored_at) + INTERVAL 1 DAY AS window_end, model_version, {_SUMS_SQL}
FROM predictions GROUP BY 1, 2, model_version""", "predictions"))
def q_metrics_by_day_version(spark: SparkSession, base: str) -> DataFrame:
    """Tumbling 1-day windows x model version."""
    return met.metrics_by_window(fx.predictions(spark, base))


@query("predictions_with_residual", with_views("""
SELECT transaction_id, scored_at AS prediction_timestamp, actual_quantity,
       round(predicted_quantity, 6) AS predicted_quantity, round(residual, 6) AS residual,
       model_version, scored_at,
       row_number() OVER (ORDER BY transaction_id, scored_at, actual_quantity, model_version) - 1 AS row_position
FROM predictions""", "predictions"))
def q_predictions_with_residual(spark: SparkSession, base: str) -> DataFrame:
    """Prediction rows keyed by the real id, plus the
    0-based position by key (ties broken by time, label, version) for
    callers that need a row index."""
    p = fx.predictions(spark, base)
    numbered = number_in_groups(
        p, [], ["transaction_id", "scored_at", "actual_quantity", "model_version"], out="_rn")
    return numbered.select(
        "transaction_id", F.col("scored_at").alias("prediction_timestamp"), "actual_quantity",
        "predicted_quantity", "residual", "model_version", "scored_at",
        (F.col("_rn") - 1).alias("row_position"))
