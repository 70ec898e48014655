"""Merkle manifest against a plain tree, for every number of passes and the edge cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, rank int, digest string, grp string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (row[0], row[1], row[2], row[3], text)))


def tree(nodes):
    """The top of a list of digests, and of each its siblings from the bottom up as (left, right)."""
    paths, level = [[] for _ in nodes], [(d, [i]) for i, d in enumerate(nodes)]
    while len(level) > 1:
        up = []
        for at in range(0, len(level), merkle.RUN):
            run = level[at:at + merkle.RUN]
            for k, (_, members) in enumerate(run):
                for m in members:
                    paths[m].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1:])))
            up.append((h(*(d for d, _ in run)), [m for _, ms in run for m in ms]))
        level = up
    return level[0][0], paths


def brute(rows):
    """[(doc_id, source, leaf, subroot, root, proof)]"""
    last = lambda x: (x is not None, x if x is not None else 0)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted(((r[0], leaf(r, r[4])) for r in rows if r[1] == s), key=lambda x: (last(x[0]), x[1])) for s in sources]
    trees = [tree([d for _, d in g]) for g in groups]
    if not trees:
        return []
    root, upper = tree([t for t, _ in trees])
    return [(i, s, d, top, root, tuple(path + up)) for s, g, (top, paths), up in zip(sources, groups, trees, upper) for (i, d), path in zip(g, paths)]


def made(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "d", "g") for r in rows], SCHEMA)
    return merkle.manifest(docs.select("doc_id", "source", merkle.leaf_of().alias("leaf")))


def key(x):
    return tuple((v is not None, v) if not isinstance(v, tuple) else v for v in x)


@pytest.mark.parametrize("digits", [1, 3])
def test_equals_a_plain_tree(spark, monkeypatch, digits):
    monkeypatch.setattr(merkle, "DIGITS", digits)  # one digit a block: three passes for 300 rows
    sizes = {"a": 300, "b": 1, "c": 16, "é": 17, None: 2, "": 256, "d": 257, **{f"s{i:02}": 1 for i in range(14)}}
    rows = [(i, s, None if i % 7 == 0 else "en", i, f"Text {i} é") for s, n in sizes.items() for i in range(n)]
    got = sorted(((r.doc_id, r.source, r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in made(spark, rows).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_nulls_ties_repeats_and_empty_tables(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (None, None, None, None, ""), (1, None, "x", 2, "AB"), (1, None, "x", 2, "ab"), (1, "s", "x", 2, "long " * 50_000)]
    got = sorted(((r.doc_id, r.source, r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in made(spark, rows).collect()), key=key)
    assert got == sorted(brute(rows), key=key)
    assert len({x[2] for x in got}) == 5
    assert made(spark, []).collect() == []
    one = made(spark, [(5, "s", "en", 1, "t")]).collect()[0]
    assert one.leaf == one.subroot == one.root and one.proof == []


def test_only_tampered_leaves_fail(spark):
    from tidemark.llm.manifest_queries import op13_merkle_manifest
    small = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in op13_merkle_manifest(spark, small).collect()}
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        changed = zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None and any("A" <= c <= "Z" for c in text)
        assert rows[doc_id].verified == (not changed)


def test_proofs_need_no_join(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, "t", 1, "d", "g") for i in range(40)], SCHEMA)
    plan = merkle.manifest(docs.select("doc_id", "source", merkle.leaf_of().alias("leaf")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Generate") == merkle.DIGITS * 2


def test_fold_and_siblings(spark):
    proof = F.array(F.struct(F.lit("a").alias("left"), F.lit("b").alias("right")), F.struct(F.lit("").alias("left"), F.lit("c").alias("right")))
    r = spark.range(1).select(merkle.fold(F.lit("x"), proof).alias("top"), merkle.siblings(proof).alias("all")).first()
    assert (r.top, r["all"]) == (h(h("axb") + "c"), "abc")
