"""NULL/NaN-safe comparisons, defaults and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_metric(c: str | Column) -> Column:
    """NaN becomes NULL: Spark orders NaN above every number, Python does not."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nanvl(col, F.lit(None).cast("double"))


def breach_above(c: str | Column, threshold: float) -> Column:
    """``x is not None and x > t``: missing or NaN never breaches, equality is OK."""
    return F.coalesce(clean_metric(c) > F.lit(threshold), F.lit(False))


def breach_below(c: str | Column, threshold: float) -> Column:
    return F.coalesce(clean_metric(c) < F.lit(threshold), F.lit(False))


def status_text(flag: Column) -> Column:
    return F.when(flag, "BREACH").otherwise("OK")


def map_get(map_col: str | Column, key: str, default=None) -> Column:
    """``d.get(key, default)`` on a MapType column."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    got = F.try_element_at(m, F.lit(key))
    return got if default is None else F.coalesce(got, F.lit(default))


def round_doubles(df: DataFrame, digits: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round every DOUBLE/FLOAT column not in ``keep`` (results compared across engines)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in keep:
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
