"""Drift between any two time windows of a scored table, from daily states that merge.

A scored table is reduced once to one state per (day, keys, column): a KLL
quantile sketch, counts over fixed bins, and row counts.  All of them merge, so
the drift between two day ranges reads the state table only, however many rows
the days hold, and states of later days, or of rows that arrive late, are added
without touching the earlier ones.

* binned PSI and KS use the fixed bins: exact for those bins, the same on every run;
* sketched KS and PSI (ten bins of equal baseline share) need no edges.

The sketches' KS comes from ``POINTS`` quantiles of either side.  A quantile's
rank is off by at most ``rank_error()`` with 99 % confidence, and the grid adds one
step a side, so the KS is off by at most ``ks_bound()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .drift import BINS, EPS

#: Sketch size, and quantiles read from a sketch.
SKETCH_K = 800
POINTS = 400
STATE_COLS = ["sketch", "n", "n_null", "bins"]


def rank_error(k: int = SKETCH_K) -> float:
    """Normalised rank error of a KLL sketch of size ``k`` at 99 % confidence."""
    return 2.296 / k ** 0.9723


def ks_bound(k: int = SKETCH_K, points: int = POINTS) -> float:
    return 2 * (rank_error(k) + 1 / points)


def _bin(value: Column, lo: Column, hi: Column) -> Column:
    raw = F.floor((value - lo) / (hi - lo) * F.lit(BINS))
    return F.when(value.isNotNull(), F.least(F.greatest(raw, F.lit(0)), F.lit(BINS - 1))).cast("int")  # greatest skips NULL


def daily_states(scored: DataFrame, edges: dict[str, tuple[float, float]], keys: list[str],
                 time_col: str = "scored_at") -> DataFrame:
    """(day, keys, column_name, sketch, n, n_null, bins) of the columns in ``edges`` (column -> bounds of its bins).

    One partial aggregate: a hot day or key is one state per task.  Values
    outside the bounds count in the end bins; NULL and NaN only in ``n_null``.
    """
    entries = [F.struct(F.lit(c).alias("column_name"), F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias("value"),
                        F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi")) for c, (lo, hi) in edges.items()]
    long = scored.select(F.to_date(time_col).alias("day"), *keys, F.explode(F.array(*entries)).alias("_e")).select(
        "day", *keys, "_e.column_name", "_e.value", _bin(F.col("_e.value"), F.col("_e.lo"), F.col("_e.hi")).alias("bin"))
    return (long.groupBy("day", *keys, "column_name").agg(
        F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("sketch"), F.count("value").alias("n"),
        F.count(F.when(F.col("value").isNull(), 1)).alias("n_null"),
        *[F.count(F.when(F.col("bin") == i, 1)).alias(f"_b{i}") for i in range(BINS)])
        .withColumn("bins", F.array(*[F.col(f"_b{i}") for i in range(BINS)])).drop(*[f"_b{i}" for i in range(BINS)]))


def window_pairs(states: DataFrame, base: tuple[str, str], cur: tuple[str, str], keys: list[str]) -> DataFrame:
    """(keys, column_name) with the merged states of both day ranges (first day included, last not), suffixed ``_base`` and ``_cur``."""
    day = F.col("day")
    inside = {side: (day >= F.lit(first).cast("date")) & (day < F.lit(last).cast("date")) for side, (first, last) in (("base", base), ("cur", cur))}
    aggs = []
    for side, ok in inside.items():
        aggs += [F.kll_merge_agg_double(F.when(ok, F.col("sketch"))).alias(f"sketch_{side}"),
                 F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias(f"n_{side}"),
                 F.array(*[F.coalesce(F.sum(F.when(ok, F.get("bins", F.lit(i)))), F.lit(0)) for i in range(BINS)]).alias(f"bins_{side}")]
    return states.where(inside["base"] | inside["cur"]).groupBy(*keys, "column_name").agg(*aggs)


def _psi(base_shares: Column, cur_shares: Column) -> Column:
    floor = lambda x: F.greatest(x, F.lit(EPS))
    terms = F.zip_with(base_shares, cur_shares, lambda b, c: (floor(c) - floor(b)) * F.log(floor(c) / floor(b)))
    return F.aggregate(terms, F.lit(0.0), lambda t, x: t + x)


def binned_drift(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, column_name, n_base, n_cur, psi, ks) over the fixed bins; NULL where a window is empty."""
    def shares(side: str) -> Column:
        return F.transform(f"bins_{side}", lambda x: x / F.nullif(F.col(f"n_{side}"), F.lit(0)))

    steps = F.transform(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.abs(
        F.aggregate(F.slice("_base", F.lit(1), i), F.lit(0.0), lambda t, x: t + x) - F.aggregate(F.slice("_cur", F.lit(1), i), F.lit(0.0), lambda t, x: t + x)))
    both = (F.col("n_base") > 0) & (F.col("n_cur") > 0)
    return (pairs.withColumns({f"_{side}": shares(side) for side in ("base", "cur")})
            .select(*keys, "column_name", "n_base", "n_cur", F.when(both, _psi(F.col("_base"), F.col("_cur"))).alias("psi"), F.when(both, F.array_max(steps)).alias("ks")))


def sketched_drift(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, column_name, n_base, n_cur, psi, ks) from the sketches alone; NULL where a window is empty."""
    ranks = F.array(*[F.lit((i + 1) / POINTS) for i in range(POINTS)])
    both = (F.col("n_base") > 0) & (F.col("n_cur") > 0)
    read = pairs.where(both).select(*keys, "column_name", "n_base", "n_cur", *[F.kll_sketch_get_quantile_double(f"sketch_{s}", ranks).alias(f"_{s}") for s in ("base", "cur")])
    below = lambda side, x: F.size(F.filter(f"_{side}", lambda q: q <= x)) / F.lit(float(POINTS))
    ks = F.array_max(F.transform(F.array_union("_base", "_cur"), lambda x: F.abs(below("base", x) - below("cur", x))))
    edges = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(BINS - 1)), lambda i: F.element_at("_base", (i * POINTS / BINS).cast("int"))))
    share = lambda side: F.transform(F.sequence(F.lit(0), F.size("_edges")), lambda i: (
        F.when(i < F.size("_edges"), below(side, F.get("_edges", i))).otherwise(F.lit(1.0)) - F.when(i > 0, below(side, F.get("_edges", i - 1))).otherwise(F.lit(0.0))))
    found = read.withColumn("_edges", edges).select(*keys, "column_name", "n_base", "n_cur", _psi(share("base"), share("cur")).alias("psi"), ks.alias("ks"))
    empty = pairs.where(~both).select(*keys, "column_name", "n_base", "n_cur", F.lit(None).cast("double").alias("psi"), F.lit(None).cast("double").alias("ks"))
    return found.unionByName(empty)
