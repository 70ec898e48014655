"""Serving payload log: one row per record of a request, aligned with its prediction.

A logged call holds its records as ``{"dataframe_records": [...]}`` and the
model's answer as ``{"predictions": [...]}``, both as JSON text.  They are parsed
once into VARIANT, so records whose fields differ need no common schema; only
the asked fields are cast.  Everything is row-wise: batch and stream share it.

Defined results: a call whose request or response is null, no JSON or without
its list is broken and kept apart with the reason (request first); a list of
another length is aligned by position, what is missing is null and flagged; an
empty list of records gives no row; a field or prediction of another type is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = ("request_not_json", "request_without_records", "response_not_json", "response_without_predictions")


def parse_calls(log: DataFrame, records: str = "$.dataframe_records", predictions: str = "$.predictions") -> DataFrame:
    """``log`` with ``records`` (array<variant>), ``predictions`` (array<double>) and ``broken`` (why the call is not usable, else null)."""
    parsed = log.withColumns({"_req": F.try_parse_json("request"), "_res": F.try_parse_json("response")})
    parsed = parsed.withColumns({"records": F.try_variant_get("_req", records, "array<variant>"),
                                 "predictions": F.try_variant_get("_res", predictions, "array<double>")})
    reason = F.lit(None).cast("string")
    for bad, why in reversed(list(zip((F.col("_req"), F.col("records"), F.col("_res"), F.col("predictions")), REASONS))):
        reason = F.when(bad.isNull(), why).otherwise(reason)
    return parsed.withColumn("broken", reason).drop("_req", "_res")


def explode_records(calls: DataFrame, fields: dict[str, str], keep: list[str]) -> DataFrame:
    """``keep``, position, ``fields`` (name -> SQL type), prediction and aligned: a row per record of every usable call."""
    def field(record: Column, name: str, kind: str) -> Column:
        return F.try_variant_get(record, f"$['{name}']", kind).alias(name)

    rows = (calls.where(F.col("broken").isNull())
            .select(*keep, "predictions", (F.size("records") == F.size("predictions")).alias("aligned"),
                    F.posexplode("records").alias("position", "_record")))
    return rows.select(*keep, "position", *(field(F.col("_record"), n, k) for n, k in fields.items()),
                       F.get("predictions", F.col("position")).alias("prediction"), "aligned")


def broken_counts(calls: DataFrame) -> DataFrame:
    """(broken, n_calls): unusable calls by reason."""
    return calls.where(F.col("broken").isNotNull()).groupBy("broken").agg(F.count(F.lit(1)).alias("n_calls"))


def observed_schema(log: DataFrame, column: str = "request") -> str:
    """The one type that fits all parsed values of a JSON column (merged map-side, one small state a task)."""
    return log.select(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first()["s"]
