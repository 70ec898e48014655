"""DuckDB SQL for the fixture views, used as CTEs by the oracle queries.

These mirror :mod:`tidemark.sources.fixtures` over the same Parquet tables
(registered as views by the checker) so each oracle query is self-contained.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "transactions": """
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
                 CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS transaction_id,
       o_custkey AS customer_id, l_suppkey AS franchise_id, l_shipdate AS date_time,
       p_name AS product, p_type AS product_type, l_quantity AS quantity,
       l_extendedprice / l_quantity AS unit_price, o_orderpriority AS payment_method,
       CAST(l_linenumber % 3 + 1 AS VARCHAR) AS fixture_version
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "customers": """
SELECT c_custkey AS customer_id, c_mktsegment AS gender, n_name AS state, r_name AS continent
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "franchises": """
SELECT s_suppkey AS franchise_id, s_name AS name, n_name AS city,
       CASE WHEN s_acctbal < 2500 THEN 'S' WHEN s_acctbal < 6500 THEN 'M' ELSE 'L' END AS size,
       r_name AS country
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "enriched": """
SELECT t.transaction_id, t.date_time, t.product, t.quantity, t.unit_price, t.payment_method,
       c.gender, c.state, c.continent AS customer_continent, f.name AS franchise_name,
       f.city AS franchise_city, f.size AS franchise_size, f.country AS franchise_country
FROM transactions t LEFT JOIN customers c ON t.customer_id = c.customer_id
     LEFT JOIN franchises f ON t.franchise_id = f.franchise_id""",
    "features": """
SELECT transaction_id, product, payment_method, gender, state, customer_continent,
       franchise_name, franchise_city, franchise_size, franchise_country, unit_price,
       CAST(hour(date_time) AS INTEGER) AS hour,
       CAST(dayofweek(date_time) + 1 AS INTEGER) AS day_of_week,
       CAST(month(date_time) AS INTEGER) AS month,
       CAST(dayofmonth(date_time) AS INTEGER) AS day_of_month,
       quantity
FROM enriched""",
    "predictions": """
SELECT transaction_id, quantity AS actual_quantity,
       avg(quantity) OVER (PARTITION BY product_type) AS predicted_quantity,
       quantity - avg(quantity) OVER (PARTITION BY product_type) AS residual,
       fixture_version AS model_version, date_time AS scored_at
FROM transactions""",
    "experiments": """
SELECT DISTINCT user_id % 5 AS experiment_id, concat('exp_', CAST(user_id % 5 AS VARCHAR)) AS name
FROM events""",
    "runs": """
SELECT user_id AS run_id, concat('run_', CAST(user_id AS VARCHAR)) AS run_name,
       CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 15
            THEN 'FAILED' ELSE 'FINISHED' END AS status,
       min(ts) AS start_time, max(ts) AS end_time, user_id % 5 AS experiment_id
FROM events GROUP BY user_id""",
    "metrics": """
SELECT user_id AS run_id,
       CASE event_type WHEN 'view' THEN 'batch_rmse' WHEN 'click' THEN 'batch_mae'
                       WHEN 'purchase' THEN 'batch_r2' WHEN 'signup' THEN 'rmse'
                       ELSE 'other' END AS metric_name,
       CASE WHEN event_type = 'purchase' THEN 1 - value / 100 ELSE value / 10 END AS metric_value,
       ts AS metric_time,
       row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS step
FROM events""",
    "run_tags": """
SELECT DISTINCT user_id AS run_id, 'drift_simulation' AS key,
       CASE WHEN user_id % 10 = 0 THEN 'true' ELSE 'false' END AS value
FROM events""",
    "model_versions": """
SELECT concat('model_', CAST(user_id % 7 AS VARCHAR)) AS name,
       CAST(row_number() OVER (PARTITION BY user_id % 7 ORDER BY ts, event_id) AS VARCHAR) AS version,
       ts AS creation_timestamp, 'READY' AS status, event_id AS run_id
FROM events WHERE event_type = 'signup'""",
}

# Which views each view reads (so a query pulls in only what it needs).
DEPENDS: dict[str, list[str]] = {
    "enriched": ["transactions", "customers", "franchises"],
    "features": ["enriched"],
    "predictions": ["transactions"],
}


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with a WITH clause holding ``names`` (plus dependencies),
    followed by the query's own ``extra`` CTEs in the given order."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    parts = [(n, VIEWS[n]) for n in ordered] + list(extra or [])
    ctes = ",\n".join(f"{n} AS ({sql}\n)" for n, sql in parts)
    return f"WITH {ctes}\n{body}"
