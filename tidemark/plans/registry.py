"""Named queries and their DuckDB oracles.

``QUERIES[name](spark, base_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``.
Every double in a registered result is rounded to 6 places (both sides).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..config import ROUND_DIGITS
from ..functions.guards import round_doubles
from ..session import ensure_checkpoint_dir

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, raw: tuple[str, ...] = ()):
    """Register ``fn`` under ``name``.

    Doubles are rounded to 6 places, except ``raw`` columns: values made by a
    single IEEE operation on input columns (e.g. price / quantity) are the
    same double in every engine, and rounding them would only expose the
    engines' different tie rules (HALF_UP on decimal text vs binary).
    """

    def wrap(fn: Callable[[SparkSession, str], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, base: str) -> DataFrame:
            ensure_checkpoint_dir(spark)  # lineage cuts and sinks need the shared folder
            return round_doubles(fn(spark, base), ROUND_DIGITS, keep=raw)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return wrap
