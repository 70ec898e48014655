"""Broadcast behind a measured size.

Without table statistics Spark estimates a join's output as the product of
its inputs' sizes, so a dimension that is itself a join (customer x nation
x region) looks huge, the planner picks a sort-merge join and the whole fact
is shuffled before AQE can switch to a broadcast.  Here the dimension is
measured instead: one aggregate over it (rows, bytes of its values) -- a
scan of the small side only -- and the broadcast hint is added only when
both are under the limits.  Above them the join stays a shuffle join, where
AQE's skew rule handles hot fact keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BYTES = 64 * 1024 * 1024
DEFAULT_MAX_ROWS = 20_000_000
# per-row overhead of Spark's hashed relation (pointers, key, row header)
_ROW_OVERHEAD = 32


def _width(field: T.StructField) -> F.Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 4
    return F.lit(8)


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate in-memory bytes) of ``df``, computed by Spark.

    Measured anew each time: a folder that grew since must not be broadcast
    on the strength of an old figure.
    """
    width = sum((_width(f) for f in df.schema.fields), F.lit(_ROW_OVERHEAD))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return int(r["n"] or 0), int(r["b"] or 0)


def checked_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES,
                      max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    rows, size = measure(df)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
