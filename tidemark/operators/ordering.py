"""Order-dependent operators that stay balanced when one group is huge.

A window ``partitionBy(g).orderBy(o)`` sends every row of group ``g`` to one
task.  With a key that holds a third of the table that task is the job.  The
operators here lay rows out with a *range* shuffle on ``(g, o)`` instead, so a
hot group is cut across many partitions, do the order-dependent step inside
each partition, and then stitch partitions together with a per
``(partition, group)`` summary whose size is bounded by
``#groups + #partitions``.  No task ever holds a whole group.

The layout is written once, with partition and position as stored columns.
Both the rows and the summary read that table: a range shuffle that is
evaluated twice samples its boundaries twice, and adaptive execution merges
the two by their own sizes, so positions would not mean the same on both
sides.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

_ID = "_tm_id"
_PART = "_tm_part"
_POS = "_tm_pos"
_FIRST = "_tm_first"
_N = "_tm_n"
_BEFORE = "_tm_before"
# monotonically_increasing_id puts the partition index above bit 33.
_POS_BITS = 33
# Largest caller-declared group count for which the summary is broadcast.
_MAX_BROADCAST_GROUPS = 100_000


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _summary_side(summary: DataFrame, group_bound: int | None) -> DataFrame:
    """Broadcast the (partition, group) summary when the caller bounds the
    number of groups: it then has at most ``group_bound`` + #partitions rows
    (a proven size), and the large side is joined in place.  Without a bound
    it stays a shuffle join, balanced because the key includes the partition."""
    return F.broadcast(summary) if group_bound is not None and group_bound <= _MAX_BROADCAST_GROUPS \
        else summary


def _key_condition(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality on ``keys`` that also matches NULL with NULL; plain ``=`` for
    keys neither side can hold NULL in (a simpler, cheaper hash key)."""
    lnull = {f.name: f.nullable for f in left.schema.fields}
    rnull = {f.name: f.nullable for f in right.schema.fields}
    parts = [left[k] == right[k] if not (lnull[k] or rnull[k]) else left[k].eqNullSafe(right[k])
             for k in keys]
    return reduce(lambda a, b: a & b, parts)


def _stitch(laid: DataFrame, summary: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows with their summary's ``values``; a row without a summary row is an error, never dropped."""
    joined = _left_null_safe_join(laid, summary, keys)
    missing = F.raise_error(F.lit("ordering: a row has no (partition, group) summary"))
    return joined.withColumns({v: F.when(F.col(v).isNull(), missing.cast(joined.schema[v].dataType)).otherwise(F.col(v))
                               for v in values})


def _range_layout(df: DataFrame, group_cols: list[str],
                  order_cols: Sequence[str | Column]) -> DataFrame:
    keys = [*_as_cols(group_cols), *_as_cols(order_cols)]
    laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = laid.withColumn(_ID, F.monotonically_increasing_id())
    laid = laid.withColumns({
        _PART: F.shiftright(F.col(_ID), _POS_BITS),
        _POS: F.col(_ID).bitwiseAND(F.lit((1 << _POS_BITS) - 1)),
    }).drop(_ID)
    return materialize(laid, "layout")


def number_in_groups(df: DataFrame, group_cols: list[str],
                     order_cols: Sequence[str | Column], out: str = "rn",
                     group_bound: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)`` without a hot task.

    Rows are range-partitioned and sorted on (group, order); the position of a
    row inside its partition comes from ``monotonically_increasing_id``.  Per
    (partition, group) the first position and the row count are aggregated,
    a running count over partitions gives each slice its offset, and one join
    on (partition, group) adds it back.
    """
    laid = _range_layout(df, group_cols, order_cols)
    stats = laid.groupBy(_PART, *group_cols).agg(
        F.min(_POS).alias(_FIRST), F.count(F.lit(1)).alias(_N))
    earlier = (Window.partitionBy(*group_cols).orderBy(_PART)
               .rowsBetween(Window.unboundedPreceding, -1))
    stats = stats.withColumn(_BEFORE, F.coalesce(F.sum(_N).over(earlier), F.lit(0)))
    bound = 1 if not group_cols else group_bound
    joined = _stitch(laid, _summary_side(stats.drop(_N), bound), [_PART, *group_cols], [_FIRST, _BEFORE])
    return joined.withColumn(
        out, (F.col(_BEFORE) + F.col(_POS) - F.col(_FIRST) + 1).cast("long")
    ).drop(_PART, _POS, _FIRST, _BEFORE)


def running_sum_in_groups(df: DataFrame, group_cols: list[str],
                          order_cols: Sequence[str | Column],
                          value_cols: dict[str, str], group_bound: int | None = None) -> DataFrame:
    """Running totals ``sum(v) OVER (PARTITION BY g ORDER BY o ROWS UNBOUNDED PRECEDING)``.

    ``value_cols`` maps input column -> output column.  The running sum inside
    a partition uses a window keyed by (partition, group), so a hot group is
    spread over as many tasks as the range shuffle made partitions; the
    totals of earlier partitions are added from a small summary table.
    """
    laid = _range_layout(df, group_cols, order_cols).drop(_POS)
    local_w = (Window.partitionBy(_PART, *group_cols).orderBy(*_as_cols(order_cols))
               .rowsBetween(Window.unboundedPreceding, 0))
    local = laid.withColumns({
        f"_tm_local_{out}": F.sum(src).over(local_w) for src, out in value_cols.items()})
    totals = laid.groupBy(_PART, *group_cols).agg(
        *[F.sum(src).alias(f"_tm_tot_{out}") for src, out in value_cols.items()])
    earlier = (Window.partitionBy(*group_cols).orderBy(_PART)
               .rowsBetween(Window.unboundedPreceding, -1))
    before = [f"_tm_before_{out}" for out in value_cols.values()]
    totals = totals.select(_PART, *group_cols, *[
        F.coalesce(F.sum(f"_tm_tot_{out}").over(earlier), F.lit(0)).alias(f"_tm_before_{out}")
        for out in value_cols.values()])
    bound = 1 if not group_cols else group_bound
    joined = _stitch(local, _summary_side(totals, bound), [_PART, *group_cols], before)
    return joined.withColumns({
        out: F.col(f"_tm_before_{out}") + F.col(f"_tm_local_{out}") for out in value_cols.values()
    }).drop(_PART, *[f"_tm_before_{o}" for o in value_cols.values()],
            *[f"_tm_local_{o}" for o in value_cols.values()])


def last_in_groups(df: DataFrame, group_cols: list[str], order_cols: Sequence[str | Column],
                   value_cols: dict[str, str], group_bound: int | None = None) -> DataFrame:
    """``last(v) IGNORE NULLS OVER (PARTITION BY g ORDER BY o ROWS UNBOUNDED PRECEDING)``.

    ``value_cols`` maps input column -> output column.  Inside a partition the
    scan is a window keyed by (partition, group); the last value of each
    (partition, group) is an aggregate, and what earlier partitions end with
    comes from that summary, so a hot group is spread like in
    :func:`running_sum_in_groups`.
    """
    laid = _range_layout(df, group_cols, order_cols)
    local_w = Window.partitionBy(_PART, *group_cols).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
    local = laid.withColumns({f"_tm_local_{out}": F.last(src, ignorenulls=True).over(local_w) for src, out in value_cols.items()})
    ends = laid.groupBy(_PART, *group_cols).agg(*[
        F.max_by(F.col(src), F.when(F.col(src).isNotNull(), F.col(_POS))).alias(f"_tm_end_{out}") for src, out in value_cols.items()])
    earlier = (Window.partitionBy(*group_cols).orderBy(_PART)
               .rowsBetween(Window.unboundedPreceding, -1))
    summary = ends.select(_PART, *group_cols, F.lit(True).alias(_N), *[
        F.last(f"_tm_end_{out}", ignorenulls=True).over(earlier).alias(f"_tm_before_{out}") for out in value_cols.values()])
    bound = 1 if not group_cols else group_bound
    joined = _stitch(local, _summary_side(summary, bound), [_PART, *group_cols], [_N])
    return joined.withColumns({out: F.coalesce(f"_tm_local_{out}", f"_tm_before_{out}") for out in value_cols.values()}).drop(
        _PART, _POS, _N, *[f"_tm_before_{o}" for o in value_cols.values()], *[f"_tm_local_{o}" for o in value_cols.values()])


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
              right_cols: list[str], ties: Sequence[str | Column] = (), strict: bool = False,
              group_bound: int | None = None) -> DataFrame:
    """Each left row with ``right_cols`` of the newest right row of its keys at or (``strict``) before its time.

    Both sides become one sequence per key, scanned once for the last right
    row, so there is neither a range join nor a window per key.  Of right rows
    at one time the last by ``ties`` counts.  Left rows without one, with a
    NULL key or with a NULL time get NULLs; right rows with a NULL time are
    never met.
    """
    time, side, tie = "_tm_time", "_tm_side", "_tm_tie"
    row, found = "_tm_row", "_tm_found"
    shared = [f"_tm_key{i}" for i in range(len(keys))]
    packed = F.struct(*[F.col(c) for c in left.columns])
    value = F.struct(*[F.col(c) for c in right_cols])
    tie_value = F.struct(*_as_cols(ties or [right_time]))
    rights = right.where(F.col(right_time).isNotNull()).select(
        *[F.col(k).alias(s) for k, s in zip(keys, shared)], F.col(right_time).alias(time), F.lit(1 if strict else 0).alias(side),
        tie_value.alias(tie), value.alias(found))
    lefts = left.select(*[F.col(k).alias(s) for k, s in zip(keys, shared)], F.col(left_time).alias(time), F.lit(0 if strict else 1).alias(side), packed.alias(row))
    events = lefts.unionByName(rights, allowMissingColumns=True)
    scanned = last_in_groups(events, shared, [time, side, tie], {found: "_tm_last"}, group_bound)
    keyed = reduce(lambda a, b: a & b, [F.col(s).isNotNull() for s in shared], F.col(time).isNotNull())
    met = F.when(keyed, F.col("_tm_last"))
    return scanned.where(F.col(row).isNotNull()).select(
        *[F.col(f"{row}.{c}").alias(c) for c in left.columns], *[met[c].alias(c) for c in right_cols])


def lag_in_groups(numbered: DataFrame, group_cols: list[str], rn_col: str,
                  value_col: str, out: str, offset: int = 1) -> DataFrame:
    """``lag(value, offset)`` given a row number from :func:`number_in_groups`.

    A self-join on (group, rn - offset): the join key is unique per row, so
    the hash shuffle is balanced even inside a hot group.
    """
    prev = numbered.select(
        *group_cols, (F.col(rn_col) + offset).alias(rn_col), F.col(value_col).alias(out))
    return _left_null_safe_join(numbered, prev, [*group_cols, rn_col])


def trailing_mean_in_groups(numbered: DataFrame, group_cols: list[str], rn_col: str,
                            value_col: str, out: str, rows: int) -> DataFrame:
    """``avg(value) OVER (... ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW)``.

    Each row is sent to the ``rows`` positions whose frame contains it
    (``explode`` of a fixed-size offset array) and averaged there; all keys
    are (group, position), so no key is hot.
    """
    shifted = numbered.select(
        *group_cols,
        F.explode(F.sequence(F.col(rn_col), F.col(rn_col) + (rows - 1))).alias(rn_col),
        F.col(value_col).alias("_tm_v"))
    frame = shifted.groupBy(*group_cols, rn_col).agg(F.avg("_tm_v").alias(out))
    return _left_null_safe_join(numbered, frame, [*group_cols, rn_col])


def _left_null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    cond = _key_condition(left, right, keys)
    right_cols = [right[c] for c in right.columns if c not in keys]
    return left.join(right, cond, "left").select(left["*"], *right_cols)


def latest_per_key(df: DataFrame, key_cols: list[str], order_cols: list[str],
                   value_cols: list[str]) -> DataFrame:
    """Newest row per key as an aggregate (``max_by`` on a struct).

    The aggregate is partial on the map side, so a key with a third of all
    rows costs one small state per task, unlike ``row_number() = 1``.
    """
    packed = F.struct(*[F.col(c) for c in value_cols])
    order = F.struct(*[F.col(c) for c in order_cols])
    return (df.groupBy(*key_cols)
            .agg(F.max_by(packed, order).alias("_tm_latest"))
            .select(*key_cols, *[F.col(f"_tm_latest.{c}").alias(c) for c in value_cols]))
