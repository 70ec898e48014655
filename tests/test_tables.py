"""Partition-wise deletes, metric states that are taken back, and digests of multisets."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lineage
from tidemark.operators import metrics as met
from tidemark.operators import sinks as sk
from tidemark.session import scratch_path


def _table(spark, rows, schema="id long, kind string, v double"):
    path = scratch_path(spark, "parts")
    spark.createDataFrame(rows, schema).repartition(3).write.partitionBy("kind").parquet(path)
    return sk.register_partitioned(spark, f"t_{uuid.uuid4().hex}", path, ["kind"])


def _files(spark, name):
    rows = spark.table(name).select("kind", F.input_file_name().alias("f")).distinct().collect()
    out = {}
    for r in rows:
        out.setdefault(r.kind, set()).add(r.f)
    return out


def test_only_touched_partitions_are_rewritten(spark):
    rows = [(i, k, float(i)) for i, k in enumerate(["a", "b/=' ", None, "d"] * 25)]
    name = _table(spark, rows)
    before = _files(spark, name)
    assert sk.delete_from_partitions(spark, name, (F.col("v") < 30) & F.col("kind").isin("a", "b/=' ") | F.col("kind").isNull() & (F.col("v") < 7) | (F.col("kind") == "d"), ["kind"]) == 4
    after = _files(spark, name)
    left = {(i, k, v) for i, k, v in rows if not (v < 30 and k in ("a", "b/=' ") or k is None and v < 7 or k == "d")}
    assert {tuple(r) for r in spark.table(name).select("id", "kind", "v").collect()} == left
    assert set(after) == {"a", "b/=' ", None}
    assert sk.delete_from_partitions(spark, name, (F.col("kind") == "a") & (F.col("v") == 40.0), ["kind"]) == 1
    last = _files(spark, name)
    assert last["a"] != after["a"] and all(last[k] == after[k] for k in after if k != "a") and not before["a"] & after["a"]
    assert sk.delete_from_partitions(spark, name, F.col("v") > 1e9, ["kind"]) == 0 and _files(spark, name) == last
    assert sk.delete_from_partitions(spark, name, F.col("v").isNull(), ["kind"]) == 0


def test_a_failed_rewrite_leaves_the_table(spark):
    name = _table(spark, [(i, "ab"[i % 2], float(i)) for i in range(20)])
    before, rows = _files(spark, name), sorted(spark.table(name).collect())
    broken = F.when(F.col("kind") == "a", True).otherwise(F.col("v") == F.raise_error(F.lit("stop")).cast("double"))
    with pytest.raises(Exception):
        sk.delete_from_partitions(spark, name, broken, ["kind"])
    assert _files(spark, name) == before and sorted(spark.table(name).collect()) == rows


def _rows(n, seed, offset=0.0):
    rnd = random.Random(seed)
    return [(rnd.choice("ab"), (y := offset + rnd.gauss(0, 3)) if rnd.random() > 0.05 else None, y + rnd.gauss(0, 1)) for _ in range(n)]


SCORED = "model_version string, actual_quantity double, predicted_quantity double"


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_net_states_equal_metrics_of_the_rows_left(spark, offset):
    rows = _rows(600, 3, offset)
    gone = [r for k, r in enumerate(rows) if k % 3 == 0]
    left = [r for k, r in enumerate(rows) if k % 3]
    parts = [(rows[:250], 1), (rows[250:], 1), (gone[:50], -1), (gone[50:], -1)]
    states = None
    for part, sign in parts:
        one = met.metric_states(spark.createDataFrame(part, SCORED).withColumn("change", F.lit(sign)), ["model_version", "change"])
        states = one if states is None else states.unionByName(one)
    got = {r.model_version: r for r in met.net_metric_states(states, ["model_version"]).collect()}
    want = {r.model_version: r for r in met.metrics_by(spark.createDataFrame(left, SCORED), ["model_version"]).collect()}
    assert set(got) == set(want)
    for v, w in want.items():
        assert (got[v].n_scored, got[v].n_null) == (w.n_scored, w.n_null)
        for c in ("rmse", "mae", "r2"):
            assert got[v][c] == pytest.approx(w[c], rel=1e-5)


def test_net_states_of_nothing_one_row_and_too_many_deletes(spark):
    def net(*parts):
        frames = [met.metric_states(spark.createDataFrame(p, SCORED).withColumn("change", F.lit(s)), ["model_version", "change"]) for p, s in parts]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return {r.model_version: tuple(r)[1:] for r in met.net_metric_states(out, ["model_version"]).collect()}

    two = [("a", 1.0, 2.0), ("a", 5.0, 5.0)]
    assert net((two, 1), (two, -1)) == {}
    assert net((two, 1), (two[:1], -1)) == {"a": (1, 0, 0.0, 0.0, None)}
    assert net(([("a", None, 1.0)], 1)) == {"a": (0, 1, None, None, None)}
    with pytest.raises(Exception, match="more rows deleted"):
        net((two[:1], 1), (two, -1))


def test_digest_keeps_multiplicities_and_adds_up(spark):
    def digest(values):
        r = lineage.multiset_digest(spark.createDataFrame([(v,) for v in values], "x string"), ["x"]).first()
        return (r.n_rows, r.high, r.low)

    assert digest(["1", "1", "2", "2"]) != digest(["3", "3", "4", "4"])
    assert digest(["1", "2", None]) == digest([None, "2", "1"]) != digest(["1", "2", ""])
    df = spark.createDataFrame([(dt.date(2024, 1, d % 3 + 1), str(d % 4)) for d in range(50)], "day date, x string")
    parts = lineage.multiset_digest(df, ["x"], ["day"])
    whole = lineage.multiset_digest(df, ["x"]).first()
    assert parts.count() == 3 and tuple(lineage.add_digests(parts).first()) == tuple(whole)
    assert lineage.multiset_digest(df.limit(0), ["x"]).first().n_rows == 0


def test_digest_separates_fields(spark):
    one = lineage.multiset_digest(spark.createDataFrame([("ab", "c")], "x string, y string"), ["x", "y"]).first()
    two = lineage.multiset_digest(spark.createDataFrame([("a", "bc")], "x string, y string"), ["x", "y"]).first()
    assert one != two
