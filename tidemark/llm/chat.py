"""Chat formatting of reply trees, on DataFrame and SQL functions only.

Messages form trees (id, parent, score).  Self-joins that double the distance
each time give every message its root, depth and summed branch score, so n
levels take log2(n) joins; leaves are ranked in each tree by mean score, and
the same jumps, applied backwards, list the root-to-leaf path of each chosen
leaf.  A path becomes one conversation:

    <|im_start|>role\\ntext<|im_end|>\\n   for each turn

``%`` and ``<|`` inside roles and texts (and line ends in roles) are escaped
as ``%25``, ``%3C|``, ``%0A``, so control strings in a text stay text and
``parse`` gives every turn back.

Edge cases: null roles and texts are empty; a parent that does not exist makes
a root; messages on a cycle of parents, which have no root, become roots of
their own; ties between branches go to the smaller leaf id, ties in turn
order to role and text; repeated rows of a conversation are turns of their own;
of repeated (tree, node) rows of a tree the least by parent, score, role and
text counts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("%0A"), F.lit("\n")), F.lit("%3C|"), F.lit("<|")), F.lit("%25"), F.lit("%"))


def from_turns(conversations: DataFrame) -> DataFrame:
    """Linear conversations as trees: (tree, node, parent, score, role, text), each turn the child of the one before.

    Window over one conversation's turns: a conversation is one output row,
    so its turns meet in one task in any case.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
            .select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"),
                    F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))


def jumps(edges: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, depth, total, leaf) and, for k = 0, 1, ..., the tables (tree, node, up) of ancestors 2**k above."""
    parents = edges.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    state = edges.join(parents, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("parent") == F.col("_n")), "left").select(
        "tree", "node", F.col("_n").alias("up"), F.col("_n").isNotNull().cast("long").alias("depth"), F.col("score").alias("total"))
    first = state = materialize(state, "chat-jumps")
    tables, levels = [], math.ceil(math.log2(max(2, state.count()))) + 1
    at_root, active = [state.where(F.col("up").isNull())], state.where(F.col("up").isNotNull())
    while not active.isEmpty() and len(tables) < levels:  # messages that have met their root leave the joins
        tables.append(active.select("tree", "node", "up"))
        every = reduce(DataFrame.unionByName, at_root, active)
        above = every.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_u"), F.col("depth").alias("_d"), F.col("total").alias("_s"))
        state = materialize(
            active.join(above, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("up") == F.col("_n")))
            .select("tree", "node", F.col("_u").alias("up"), (F.col("depth") + F.col("_d")).alias("depth"), (F.col("total") + F.col("_s")).alias("total")), "chat-jumps")
        at_root.append(state.where(F.col("up").isNull()))
        active = state.where(F.col("up").isNotNull())
    # what still has an ancestor after log2(n) doublings lies on or under a cycle
    if not active.isEmpty():
        keys = materialize(active.select(F.col("tree").alias("_t"), F.col("node").alias("_n")), "chat-cycles")
        cut = edges.join(keys, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")), "left")
        return jumps(cut.withColumn("parent", F.when(F.col("_n").isNull(), F.col("parent"))).select(*edges.columns))
    inner = first.select(F.col("tree").alias("_t"), F.col("up").alias("_n")).where(F.col("_n").isNotNull()).distinct()
    nodes = reduce(DataFrame.unionByName, at_root).join(inner, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")), "left")
    return nodes.select("tree", "node", "depth", "total", F.col("_n").isNull().alias("leaf")), tables


def best_paths(edges: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, node, depth): the members of the ``branches`` best root-to-leaf paths of each tree (None: all)."""
    nodes, tables = jumps(edges)
    nodes = materialize(nodes, "chat-nodes")
    leaves = nodes.where("leaf")
    ranked = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / (F.col("depth") + 1)), "node")
    if branches == 1:  # a partial aggregate, not a window
        leaves = (leaves.groupBy("tree").agg(F.max_by("node", F.struct(F.col("total") / (F.col("depth") + 1), -F.col("node"))).alias("leaf"))
                  .withColumn("rank", F.lit(1)))
    else:
        leaves = leaves.withColumn("rank", F.row_number().over(ranked)).select("tree", F.col("node").alias("leaf"), "rank")
        leaves = leaves if branches is None else leaves.where(F.col("rank") <= branches)
    paths = leaves.withColumn("node", F.col("leaf"))
    for t in tables:  # after table k, a path holds the nearest 2**(k+1) members; written each time, so that a level adds one join to the plan
        t = t.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "up")
        paths = materialize(paths, "chat-paths")
        paths = paths.unionByName(paths.join(t, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n"))).select("tree", "leaf", "rank", F.col("up").alias("node")))
    depth = nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "depth")
    return paths.join(depth, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n"))).select("tree", "leaf", "rank", "node", "depth")


def distinct_nodes(nodes: DataFrame) -> DataFrame:
    """``nodes`` with one row for each (tree, node): of several the least by parent, score, role and text."""
    again = materialize(nodes.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select(F.col("tree").alias("_t"), F.col("node").alias("_n")), "chat-repeated")
    if again.isEmpty():
        return nodes
    same = F.col("tree").eqNullSafe(F.col("_t")) & F.col("node").eqNullSafe(F.col("_n"))
    least = F.min(F.struct("parent", "score", "role", "text")).alias("_least")
    one = nodes.join(again, same, "left_semi").groupBy("tree", "node").agg(least).select("tree", "node", "_least.*")
    columns = ["tree", "node", "parent", "score", "role", "text"]
    return nodes.join(again, same, "left_anti").select(*columns).unionByName(one.select(*columns))


def format_trees(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, rank, formatted): one conversation for each chosen path of (tree, node, parent, score, role, text)."""
    nodes = distinct_nodes(nodes)
    paths = best_paths(nodes.select("tree", "node", "parent", "score"), branches)
    turn = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("%0A")), F.lit("\n"), escape(F.col("text")), F.lit(END))
    turns = nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), turn.alias("turn"))
    return (paths.join(turns, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")))
            .groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(F.struct("depth", "turn"))).alias("turns"))
            .select("tree", "rank", F.array_join(F.col("turns.turn"), "").alias("formatted")))


def parse(formatted: Column) -> Column:
    """array<struct<role, text, loss>> read back from a formatted conversation; loss marks assistant texts."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(
        unescape(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.substr(x, F.instr(x, "\n") + 1, F.length(x) - F.instr(x, "\n") - len(END))).alias("text"),
        (F.substring_index(x, "\n", 1) == "assistant").alias("loss")))
