"""Prefix trie against a plain one, for any number of shards, and the edge cases."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, ids int, least int, depth string"


def brute(convs, family=5):
    """Rows of the contract for {conv_id: [(role, text), ...]}."""
    def rebuilt(c):
        h = zlib.crc32(str(c).encode()) % 9
        return tuple(convs.get(c - c % family, [])[:h] + convs[c][h:])

    whole = {c: rebuilt(c) for c in convs}
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[:-1] == p] for p in members}
    rows = []
    for p, m in members.items():
        todo, leaves, saved = [p], 0, 0
        while todo:
            q = todo.pop()
            todo += children[q]
            leaves += not children[q]
            saved += (len(members[q]) - 1) * len(q[-1][1].encode()) if q else 0
        ends = ",".join(map(str, sorted(c for c in m if whole[c] == p)))
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def made(spark, rows, shard_turns=None):
    lists = prefix_trie.turn_lists(spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA))
    whole = prefix_trie.rebuilt(lists, 5, F.crc32(F.col("conv_id").cast("string")) % 9)
    return sorted(map(tuple, prefix_trie.trie(prefix_trie.encoded(whole), shard_turns).collect()), key=str)


@pytest.mark.parametrize("shard_turns", [1, 7, 40, None])
def test_equals_a_plain_trie(spark, shard_turns):
    rng = random.Random(3)
    convs = {}
    for c in range(120):
        copy = convs[rng.choice(list(convs))] if convs and rng.random() < 0.4 else []
        convs[c] = copy[:rng.randint(0, 12)] + [(rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "", "cc"])) for _ in range(rng.randint(1, 12 if c % 30 else 60))]
    rows = [(c, i, role, text) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    assert made(spark, rows, shard_turns) == brute(convs)


def test_nulls_ties_repeats_missing_bases_and_long_conversations(spark):
    convs = {7: [("", "")] * 3, 12: [("", "b"), ("user", "a"), ("user", "a"), ("user", "b")], 20: [("user", "x" * 40_000)] * 300, 21: [("user", "q")]}
    rows = [(7, None, None, None), (7, None, None, None), (7, 1, "", None), (12, 5, "user", "b"), (12, 5, "user", "a"), (12, 5, "user", "a"), (12, None, None, "b"), (21, 1, "user", "q")]
    rows += [(20, i, "user", "x" * 40_000) for i in range(300)] + [(None, 1, "user", "lost")]
    assert made(spark, rows) == brute(convs) == made(spark, rows, 50)
    assert made(spark, []) == []


def test_many_copies_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    convs = {c: [("user", "same"), ("assistant", "yes")] for c in range(0, 2000, 5)}
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    assert made(spark, rows) == brute(convs)


def test_tree_is_balanced_and_sums_iteratively():
    one = lambda k: {"ids": [k], "sizes": [1], "start": 0, "n": [1, 1], "least": [k, k], "kids": [0, 0], "leaves": [0, 0], "saved": [0, 0], "ends": [None, None]}
    tree = prefix_trie.by_median([one(k) for k in range(1023)])

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.lower[at]), height(tree.higher[at]))
    assert height(tree.equal[0]) == 10
    deep = {"ids": list(range(50_000)), "sizes": [1] * 50_000, "start": 0, **{f: [0] * 50_001 for f in ("kids", "leaves", "saved")}, "n": [2] * 50_001, "least": [0] * 50_001, "ends": [None] * 50_001}
    assert prefix_trie.merge_rows([deep | {"shard": 0, "side": 0}])[0][:7] == (0, 0, None, 2, 1, 1, 50_000)
