"""Registered queries over the payload log with several records a request."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import payload as pl
from ..sources import fixtures as fx
from ..streaming import jobs
from .registry import query

FIELDS = {"event_id": "bigint", "k": "int", "event_type": "string"}

#: The log of fixtures.payload_calls, and its lists.
_CALLS_SQL = """
WITH grouped AS (
SELECT event_id // 4 AS request_id, max(ts) AS arrival_time,
       concat('{"dataframe_records":[', string_agg(concat('{"event_id":', event_id, ',"k":', coalesce(CAST(json_extract(props, '$.k') AS VARCHAR), 'null'), ',"event_type":"', event_type, '"}'), ',' ORDER BY event_id), ']}') AS request,
       concat('{"predictions":[', string_agg(CAST(event_id % 100 + 0.5 AS VARCHAR), ',' ORDER BY event_id), ']}') AS response
FROM events GROUP BY 1),
calls AS (
SELECT request_id, arrival_time,
       CASE WHEN request_id % 17 = 3 THEN left(request, length(request) - 3)
            WHEN request_id % 17 = 5 THEN '{"inputs":[]}' ELSE request END AS request,
       CASE WHEN request_id % 17 = 7 THEN NULL WHEN request_id % 17 = 9 THEN '{"error":"timeout"}'
            WHEN request_id % 17 = 11 THEN '{"predictions":[1.5]}' ELSE response END AS response
FROM grouped),
parsed AS (
SELECT request_id, arrival_time,
       CASE WHEN json_valid(request) THEN json_extract(request, '$.dataframe_records') END AS records,
       CASE WHEN json_valid(response) THEN CAST(json_extract(response, '$.predictions') AS DOUBLE[]) END AS predictions,
       CASE WHEN request IS NULL OR NOT json_valid(request) THEN 'request_not_json'
            WHEN json_extract(CASE WHEN json_valid(request) THEN request END, '$.dataframe_records') IS NULL THEN 'request_without_records'
            WHEN response IS NULL OR NOT json_valid(response) THEN 'response_not_json'
            WHEN json_extract(response, '$.predictions') IS NULL THEN 'response_without_predictions' END AS broken
FROM calls),
usable AS (
SELECT request_id, arrival_time, predictions, CAST(json_array_length(records) AS INTEGER) AS n, CAST(records AS JSON[]) AS records
FROM parsed WHERE broken IS NULL),
exploded AS (
SELECT request_id, arrival_time, predictions, n, unnest(range(n)) AS position, unnest(records) AS record FROM usable)
"""


def _calls(spark: SparkSession, base: str) -> DataFrame:
    return pl.parse_calls(fx.payload_calls(spark, base))


@query("payload_records", _CALLS_SQL + """
SELECT request_id, CAST(position AS INTEGER) AS position, CAST(json_extract(record, '$.event_id') AS BIGINT) AS event_id,
       CAST(json_extract(record, '$.k') AS INTEGER) AS k, json_extract_string(record, '$.event_type') AS event_type,
       predictions[position + 1] AS prediction, n = len(predictions) AS aligned
FROM exploded""")
def q_payload_records(spark: SparkSession, base: str) -> DataFrame:
    """One row per record of a request with its own prediction."""
    return pl.explode_records(_calls(spark, base), FIELDS, ["request_id"])


@query("payload_broken", _CALLS_SQL + """
SELECT broken, count(*) AS n_calls FROM parsed WHERE broken IS NOT NULL GROUP BY broken""")
def q_payload_broken(spark: SparkSession, base: str) -> DataFrame:
    """Calls that cannot be used, counted by reason."""
    return pl.broken_counts(_calls(spark, base))


@query("stream_payload_records", _CALLS_SQL + """
SELECT request_id, CAST(position AS INTEGER) AS position, CAST(json_extract(record, '$.event_id') AS BIGINT) AS event_id,
       CAST(json_extract(record, '$.k') AS INTEGER) AS k, json_extract_string(record, '$.event_type') AS event_type,
       predictions[position + 1] AS prediction, n = len(predictions) AS aligned
FROM exploded""")
def q_stream_payload_records(spark: SparkSession, base: str) -> DataFrame:
    """T3s: the same rows from calls that land in two deliveries; the second run reads only the new files."""
    paths = jobs.StreamPaths.fresh(spark, "payload-records")
    log = fx.payload_calls(spark, base)
    early = F.col("request_id") % 2 == 0
    for delivery in (early, ~early):
        jobs.land_files(log.where(delivery), paths.source)
        rows = pl.explode_records(pl.parse_calls(jobs.read_stream(spark, paths.source, log.schema)), FIELDS, ["request_id"])
        jobs.run_available_now(rows, paths.sink, paths.checkpoint)
    return spark.read.parquet(paths.sink)
