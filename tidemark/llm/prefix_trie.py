"""Prefix trie of conversations, with members, children, leaves and shared bytes of every node.

Turns are dictionary-encoded: each distinct (role, text) has one number.  Equal
sequences of numbers are one row with a count from the start, so that thousands
of copies weigh as much as one.  The sequences are range-partitioned and sorted;
a task cuts its sorted run into shards of at most ``SHARD_TURNS`` turns and
builds a ternary search tree over each, inserting the median first, which
balances the search among siblings.  An iterative traversal, children before
parents, sums members, leaves and savings.

Nodes on the paths of a shard's first and last sequence may go on in other
shards.  They leave the shard as two paths with what the shard knows of them;
the paths of all shards (two for ``SHARD_TURNS`` turns) meet in one last tree,
where counts are added and savings, which are not linear in the members, are
computed once.  All other nodes are complete in their shard; those right under
a boundary node get its least member from the merged paths.

The members that end at a node are hashed as one string: they are numbered
in order without a hot task, joined in pieces of ``PIECE`` ids and hashed piece
after piece, so a task reads the pieces of a node but never holds them together.

Edge cases: null roles and texts are empty; null turns come first, ties in turn
go by role and text; repeated rows are turns of their own; rows without a
conversation id belong to no conversation and are left out; a conversation
without turns is a member of the root; an empty table has no root and gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import checked_broadcast
from tidemark.operators.ordering import number_in_groups
from tidemark.session import materialize

#: Turns of one shard's tree at most (a longer sequence is a shard of its own).
SHARD_TURNS = 100_000
#: Ids joined to one string at most.
PIECE = 1_000

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: A path from ``start`` down: what one shard knows of its nodes.
PATH = "ids array<long>, sizes array<long>, start long, n array<long>, least array<long>, kids array<long>, leaves array<long>, saved array<long>, ends array<string>"


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as array<struct<key, size>>.

    ``key`` identifies role and text, ``size`` is the bytes of the text.  A
    conversation is one row from here on, without its texts.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    key = lambda t: F.unhex(F.sha2(F.concat(F.octet_length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"]), 256))
    return (turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
            .select("conv_id", F.transform("rows", lambda t: F.struct(key(t).alias("key"), F.octet_length(t["text"]).cast("long").alias("size"))).alias("turns")))


def encoded(lists: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes): ``lists`` with the turns' numbers in the dictionary of all turns."""
    turns = lists.select("conv_id", F.posexplode("turns").alias("place", "turn")).select("conv_id", "place", "turn.key", "turn.size")
    numbers = number_in_groups(turns.select("key").distinct(), [], ["key"], "id")
    # a hot turn is one row of the dictionary; its rows of the other side are split by adaptive execution
    found = turns.join(materialize(numbers, "trie-dictionary"), "key")
    rows = found.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "id", "size"))).alias("t"))
    none = F.array().cast("array<long>")
    return rows.select("conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes")).unionByName(
        lists.where(F.size("turns") == 0).select("conv_id", none.alias("ids"), none.alias("sizes")))


def hashed_members(members: DataFrame) -> DataFrame:
    """(sid, ends): of each sequence the SHA-256 of its members' ids, ascending and joined by commas."""
    numbered = number_in_groups(members.select("sid", "conv_id"), ["sid"], ["conv_id"], "place")
    pieces = (numbered.groupBy("sid", F.expr(f"(place - 1) div {PIECE}").alias("piece"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for b in batches:
            done: list[tuple] = []
            for sid, ids in zip(b.column("sid").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if sid != at:
                    if at is not None:
                        done.append((at, state.hexdigest()))
                    at, state = sid, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield _batch(done)
        if at is not None:
            yield _batch([(at, state.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], type=pa.binary()), pa.array([r[1] for r in rows], type=pa.string())], names=["sid", "ends"])

    return pieces.repartition("sid").sortWithinPartitions("sid", "piece").mapInArrow(run, "sid binary, ends string")


class Tree:
    """A ternary search tree over paths; node 0 is the root, and a node's equal child leads to the nodes one turn further."""

    def __init__(self):
        self.split, self.lower, self.higher, self.equal = [0], [-1], [-1], [-1]
        self.parent, self.depth, self.size = [-1], [0], [0]
        self.n, self.least, self.kids, self.leaves, self.saved, self.ends = [0], [None], [0], [0], [0], [None]

    def child(self, node: int, turn: int, size: int) -> int:
        """The node one turn under ``node``, made if there is none."""
        at, link, last = self.equal[node], self.equal, node
        while at >= 0 and self.split[at] != turn:
            link, last = (self.lower, at) if turn < self.split[at] else (self.higher, at)
            at = link[last]
        if at < 0:
            at = link[last] = len(self.split)
            for field, value in ((self.split, turn), (self.lower, -1), (self.higher, -1), (self.equal, -1), (self.parent, node), (self.depth, self.depth[node] + 1), (self.size, size),
                                 (self.n, 0), (self.least, None), (self.kids, 0), (self.leaves, 0), (self.saved, 0), (self.ends, None)):
                field.append(value)
        return at

    def path(self, ids: list[int], sizes: list[int]) -> list[int]:
        """The nodes from the root along ``ids``."""
        nodes = [0]
        for turn, size in zip(ids, sizes, strict=True):
            nodes.append(self.child(nodes[-1], turn, size))
        return nodes

    def add(self, p: dict) -> None:
        for k, node in enumerate(self.path(p["ids"], p["sizes"])[p["start"]:]):
            self.n[node] += p["n"][k]
            self.least[node] = p["least"][k] if self.least[node] is None else min(self.least[node], p["least"][k])
            self.kids[node] += p["kids"][k]
            self.leaves[node] += p["leaves"][k]
            self.saved[node] += p["saved"][k]
            self.ends[node] = p["ends"][k] or self.ends[node]

    def sum_up(self, open_nodes: set[int]) -> None:
        """Children before parents: nodes that are not open become complete and are added to their parents."""
        for node in range(len(self.split) - 1, -1, -1):  # a node is made after its parent
            if node in open_nodes:
                continue
            self.leaves[node] += self.kids[node] == 0
            self.saved[node] += (self.n[node] - 1) * self.size[node]
            if node:
                up = self.parent[node]
                self.kids[up] += 1
                self.leaves[up] += self.leaves[node]
                self.saved[up] += self.saved[node]

    def row(self, node: int, parent: int | None) -> tuple:
        return (self.least[node], self.depth[node], parent, self.n[node], self.kids[node], self.leaves[node], self.saved[node], self.ends[node] or hashlib.sha256(b"").hexdigest())


def by_median(paths: list[dict]) -> Tree:
    """The tree of sorted ``paths``, medians inserted first."""
    tree, todo = Tree(), [(0, len(paths))]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            tree.add(paths[mid := (lo + hi) // 2])
            todo += [(lo, mid), (mid + 1, hi)]
    return tree


def shard_rows(paths: list[dict], shard: int) -> tuple[list[tuple], list[tuple]]:
    """Complete nodes (with shard, side and depth of a parent that is not complete) and the boundary paths of one shard."""
    tree = by_median(paths)
    first, last = (tree.path(p["ids"], p["sizes"]) for p in (paths[0], paths[-1]))
    shared = next((k for k, (a, b) in enumerate(zip(first, last)) if a != b), min(len(first), len(last)))
    side = {node: 0 for node in first} | {node: 1 for node in last[shared:]}
    tree.sum_up(set(side))
    nodes = []
    for node in range(len(tree.split)):
        if node not in side:
            up = tree.parent[node]
            nodes.append((*tree.row(node, None if up in side else tree.least[up]), *((shard, side[up], tree.depth[up]) if up in side else (None, None, None))))
    edges = []
    for which, p, path, start in ((0, paths[0], first, 0), (1, paths[-1], last, shared)):
        if path[start:]:
            edges.append((p["ids"], p["sizes"], start, *([f[x] for x in path[start:]] for f in (tree.n, tree.least, tree.kids, tree.leaves, tree.saved, tree.ends)), shard, which))
    return nodes, edges


def merge_rows(paths: list[dict]) -> list[tuple]:
    """All nodes on boundary paths, complete; a node also stands once for each (shard, side, depth) that names it, with a false flag."""
    paths = sorted(paths, key=lambda p: p["ids"])
    tree = by_median(paths)
    tree.sum_up(set())
    rows = [(*tree.row(node, tree.least[tree.parent[node]] if node else None), True, None, None) for node in range(len(tree.split))]
    for p in paths:
        nodes = tree.path(p["ids"], p["sizes"])
        rows += [(*tree.row(x, None), False, p["shard"], p["side"]) for x in nodes[p["start"]:]]
    return rows


_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _table(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [x.split(" ") for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=_ARROW[t]) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def trie(sequences: DataFrame, shard_turns: int | None = None) -> DataFrame:
    """The nodes of the trie of ``sequences`` (conv_id, ids, sizes), with the columns ``NODE``."""
    limit = shard_turns or SHARD_TURNS
    sequences = materialize(sequences.select("conv_id", "ids", "sizes", F.unhex(F.sha2(F.array_join("ids", ","), 256)).alias("sid")), "trie-sequences")
    distinct = sequences.groupBy("sid").agg(F.first("ids").alias("ids"), F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("least"))
    distinct = materialize(distinct.join(hashed_members(sequences), "sid").drop("sid"), "trie-distinct")
    refs = "shard long, side long, at long"
    schema = f"{NODE}, {refs}, {PATH}, is_path boolean"
    blank_node, blank_path = (None,) * (len(NODE.split(", ")) + 3), (None,) * len(PATH.split(", "))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, run, turns = TaskContext.get().partitionId(), 0, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nodes, edges = shard_rows(run, (part << 32) + count)
            rows = [(*x, *blank_path, False) for x in nodes]
            rows += [(*blank_node[:-3], *x[-2:], None, *x[:-2], True) for x in edges]
            for lo in range(0, len(rows), 10_000):
                yield _table(rows[lo:lo + 10_000], schema)

        for b in batches:
            for r in b.to_pylist():
                if run and turns + len(r["ids"]) + 1 > limit:
                    yield from close()
                    run, turns, count = [], 0, count + 1
                length = len(r["ids"]) + 1
                zeros = [0] * length
                run.append({"ids": r["ids"], "sizes": r["sizes"], "start": 0, "n": [r["members"]] * length, "least": [r["least"]] * length, "kids": zeros, "leaves": zeros, "saved": zeros,
                            "ends": [None] * (length - 1) + [r["ends"]]})
                turns += length
        if run:
            yield from close()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = [p for b in batches for p in b.to_pylist()]
        rows = merge_rows(paths) if paths else []
        for lo in range(0, len(rows), 10_000):
            yield _table(rows[lo:lo + 10_000], f"{NODE}, is_node boolean, shard long, side long")

    rows = materialize(distinct.repartitionByRange("ids").sortWithinPartitions("ids").mapInArrow(shards, schema), "trie-shards")
    names = [x.split(" ")[0] for x in PATH.split(", ")]
    merged = materialize(rows.where("is_path").select(*names, "shard", "side").coalesce(1).mapInArrow(merge, f"{NODE}, is_node boolean, shard long, side long"), "trie-merged")
    columns = [x.split(" ")[0] for x in NODE.split(", ")]
    whole = rows.where(~F.col("is_path") & F.col("shard").isNull()).select(*columns)
    named = checked_broadcast(merged.where(~F.col("is_node")).select("shard", "side", F.col("depth").alias("at"), F.col("conv_id").alias("_parent")))
    under = rows.where(~F.col("is_path") & F.col("shard").isNotNull()).join(named, ["shard", "side", "at"]).withColumn("parent_conv_id", F.col("_parent")).select(*columns)
    return whole.unionByName(under).unionByName(merged.where("is_node").select(*columns))


def rebuilt(lists: DataFrame, family: int, head: Column) -> DataFrame:
    """``lists`` with the first ``head`` turns of each conversation c taken from conversation c - c % family, if there is one.

    ``head`` is a column over conv_id; the families' first turns are joined by
    id, which is unique on both sides of a family's ``family`` rows.
    """
    lists = materialize(lists, "trie-lists")
    base = lists.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("_base"), F.col("turns").alias("_turns"))
    rows = lists.withColumn("_head", head.cast("int")).join(base, F.col("conv_id") - F.col("conv_id") % family == F.col("_base"), "left")
    none = F.array().cast(lists.schema["turns"].dataType)
    return rows.select("conv_id", F.concat(F.slice(F.coalesce("_turns", none), F.lit(1), F.col("_head")), F.slice("turns", F.col("_head") + 1, F.size("turns"))).alias("turns"))
