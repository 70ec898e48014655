"""Fact enrichment and the feature frame.

The fact keeps every row (left joins); unmatched dimension keys give NULL
attributes and duplicate dimension keys fan rows out, exactly like a SQL left
join.  :func:`join_quality` reports both so a caller can see it happened.
Customers are joined to the orders where these are given: fewer and narrower
rows than the fact's, and the fact meets the orders anyway.
A dimension is broadcast only after its size has been measured (see
:mod:`joins`); beyond the limit it is a sort-merge join, where AQE's skew
rule splits hot fact keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CATEGORICAL_COLS, KEY_COL, LABEL_COL, NUMERIC_COLS
from ..functions.calendar import calendar_columns
from .joins import DEFAULT_MAX_BYTES, checked_broadcast

ENRICHED_COLS = [
    "transaction_id", "date_time", "product", "quantity", "unit_price", "payment_method",
    "gender", "state", "customer_continent", "franchise_name", "franchise_city",
    "franchise_size", "franchise_country",
]


def _with_customer(df: DataFrame, customers: DataFrame, broadcast_limit: int) -> DataFrame:
    """Rows with ``gender``, ``state`` and ``continent`` of their customer."""
    cust = customers.select("customer_id", "gender", "state", "continent")
    d = df.alias("d")
    c = checked_broadcast(cust, broadcast_limit).alias("c")
    return d.join(c, F.col("d.customer_id") == F.col("c.customer_id"), "left").select(
        "d.*", "c.gender", "c.state", "c.continent")


def enrich(transactions: DataFrame | Callable[[DataFrame], DataFrame], customers: DataFrame, franchises: DataFrame,
           broadcast_limit: int = DEFAULT_MAX_BYTES, orders: DataFrame | None = None) -> DataFrame:
    """Fact left-joined to both dimensions; table-qualified projection + renames.

    With ``orders`` the ``transactions`` are a function of them that keeps
    their further columns, and the customers are joined to the orders.
    """
    fran = franchises.select("franchise_id", "name", "city", "size", "country")
    if orders is None:
        fact = _with_customer(transactions, customers, broadcast_limit)
    else:
        fact = transactions(_with_customer(orders, customers, broadcast_limit))
    t = fact.alias("t")
    f = checked_broadcast(fran, broadcast_limit).alias("f")
    return (
        t.join(f, F.col("t.franchise_id") == F.col("f.franchise_id"), "left")
        .select(
            F.col("t.transaction_id"), F.col("t.date_time"), F.col("t.product"),
            F.col("t.quantity"), F.col("t.unit_price"), F.col("t.payment_method"),
            F.col("t.gender"), F.col("t.state"),
            F.col("t.continent").alias("customer_continent"),
            F.col("f.name").alias("franchise_name"),
            F.col("f.city").alias("franchise_city"),
            F.col("f.size").alias("franchise_size"),
            F.col("f.country").alias("franchise_country"),
        )
    )


def join_quality(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str,
                 dim_name: str) -> DataFrame:
    """One row: fact rows, rows without a dimension match, duplicate dim keys, fan-out.

    Dimension keys are first reduced to (key, copies) by a partial aggregate,
    so a hot fact key never meets more than one row of the dimension.
    """
    copies = dim.groupBy(F.col(dim_key).alias("_k")).agg(F.count(F.lit(1)).alias("_copies"))
    keyed = fact.select(F.col(fact_key).alias("_k"))
    from_fact = keyed.join(copies, "_k", "left").select(F.lit(True).alias("_fact"), "_copies")
    from_dim = copies.select(F.lit(False).alias("_fact"), "_copies")
    both = from_fact.unionByName(from_dim)
    is_fact = F.col("_fact")
    return both.agg(
        F.count(F.when(is_fact, 1)).alias("n_fact_rows"),
        F.count(F.when(is_fact & F.col("_copies").isNull(), 1)).alias("n_unmatched"),
        F.count(F.when(~is_fact & (F.col("_copies") > 1), 1)).alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(is_fact & (F.col("_copies") > 1), F.col("_copies") - 1)),
                   F.lit(0)).cast("long").alias("n_extra_rows"),
    ).select(F.lit(dim_name).alias("dimension"), "n_fact_rows", "n_unmatched",
             "n_duplicate_keys", "n_extra_rows")


def feature_frame(enriched: DataFrame, keep_key: bool = True) -> DataFrame:
    """Key, 9 categoricals, 5 numerics (fixed order), label.

    The key is kept (the single-machine original dropped it and later used a
    row position as 'transaction id').
    """
    feats = enriched.withColumns(calendar_columns("date_time"))
    cols = ([KEY_COL] if keep_key else []) + CATEGORICAL_COLS + NUMERIC_COLS + [LABEL_COL]
    return feats.select(*cols)
