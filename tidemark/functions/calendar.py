"""Calendar features of a timestamp (JVM built-ins, inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_columns(ts: str | Column) -> dict[str, Column]:
    """hour, day_of_week (1 = Sunday), month, day_of_month."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return {
        "hour": F.hour(c),
        "day_of_week": F.dayofweek(c),
        "month": F.month(c),
        "day_of_month": F.dayofmonth(c),
    }


def with_calendar(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(calendar_columns(ts))
