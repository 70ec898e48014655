"""Drift between windows, last-value scans, as-of joins and the time spine against their plain definitions."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import drift as dr
from tidemark.operators import gate as gt
from tidemark.operators import window_drift as wd
from tidemark.operators.ordering import asof_join, last_in_groups
from tidemark.session import materialize, scratch_path
from tidemark.streaming import jobs

DAY = dt.datetime(2024, 1, 1)


def _scored(spark, n=6000, days=20, seed=1):
    """Rows whose values shift by the day; a third of them in version 1 and on the first day."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        day = 0 if rnd.random() < 0.33 else rnd.randrange(days)
        v = rnd.gauss(day * 0.2, 2.0)
        rows.append((DAY + dt.timedelta(days=day, hours=rnd.randrange(24)), "1" if rnd.random() < 0.34 else rnd.choice("23"), v, float(rnd.randrange(5)) if i % 50 else None))
    return spark.createDataFrame(rows, "scored_at timestamp_ntz, model_version string, residual double, few double").repartition(5)


EDGES = {"residual": (-5.0, 8.0), "few": (0.0, 5.0)}
BASE, CURRENT = ("2024-01-01", "2024-01-08"), ("2024-01-06", "2024-01-20")  # the ranges may overlap


def _windows(df, lo, hi):
    return df.where((F.col("scored_at") >= lo) & (F.col("scored_at") < hi))


def test_sketched_ks_is_within_its_bound(spark):
    scored = _scored(spark)
    pairs = wd.window_pairs(materialize(wd.daily_states(scored, EDGES, ["model_version"])), BASE, CURRENT, ["model_version"])
    got = {(r.model_version, r.column_name): r for r in wd.sketched_drift(pairs, ["model_version"]).collect()}
    assert len(got) == 6 and wd.ks_bound() < 0.013
    for v in "123":
        part = scored.where(F.col("model_version") == v)
        exact = {r.column_name: r.ks for r in dr.ks_numeric(_windows(part, *BASE), _windows(part, *CURRENT), list(EDGES)).collect()}
        for c, ks in exact.items():
            assert abs(got[(v, c)].ks - ks) <= wd.ks_bound()
            assert got[(v, c)].psi >= 0
    assert got[("1", "residual")].psi > got[("1", "few")].psi


def test_binned_drift_equals_counting(spark):
    import math
    scored = _scored(spark, 2000)
    pairs = wd.window_pairs(wd.daily_states(scored, EDGES, ["model_version"]), BASE, CURRENT, ["model_version"])
    got = {(r.model_version, r.column_name): r for r in wd.binned_drift(pairs, ["model_version"]).collect()}
    rows = scored.collect()
    for (v, c), r in got.items():
        lo, hi = EDGES[c]
        counts = []
        for first, last in (BASE, CURRENT):
            vals = [x[c] for x in rows if x.model_version == v and x[c] is not None and first <= str(x.scored_at)[:10] < last]
            counts.append([sum(1 for y in vals if min(max(math.floor((y - lo) / (hi - lo) * 10), 0), 9) == b) for b in range(10)])
        nb, nc = map(sum, counts)
        assert (r.n_base, r.n_cur) == (nb, nc)
        pb, pc = ([max(x / n, 1e-6) for x in k] for k, n in zip(counts, (nb, nc)))
        assert r.psi == pytest.approx(sum((c - b) * math.log(c / b) for b, c in zip(pb, pc)))
        assert r.ks == pytest.approx(max(abs(sum(counts[0][:k]) / nb - sum(counts[1][:k]) / nc) for k in range(1, 11)))


def test_empty_windows_and_values_that_are_no_numbers(spark):
    rows = [(DAY, "1", float("nan")), (DAY, "1", None), (DAY, "1", 3.0), (DAY, "2", None), (None, "1", 9.0)]
    df = spark.createDataFrame(rows, "scored_at timestamp_ntz, model_version string, residual double")
    states = wd.daily_states(df, {"residual": (0.0, 10.0)}, ["model_version"])
    assert {(str(r.day), r.model_version): (r.n, r.n_null, r.bins[3]) for r in states.collect()} == {
        ("2024-01-01", "1"): (1, 2, 1), ("2024-01-01", "2"): (0, 1, 0), ("None", "1"): (1, 0, 0)}
    pairs = wd.window_pairs(states, ("2024-01-01", "2024-01-02"), ("2025-01-01", "2025-02-01"), ["model_version"])
    for made in (wd.binned_drift, wd.sketched_drift):
        assert {(r.model_version, r.n_base, r.n_cur, r.psi, r.ks) for r in made(pairs, ["model_version"]).collect()} == {("1", 1, 0, None, None), ("2", 0, 0, None, None)}
    assert wd.binned_drift(wd.window_pairs(wd.daily_states(df.limit(0), {"residual": (0.0, 10.0)}, ["model_version"]), BASE, CURRENT, ["model_version"]), ["model_version"]).collect() == []


def test_replayed_and_empty_batches_count_once(spark):
    paths = jobs.StreamPaths.fresh(spark, "drift-test")
    scored = _scored(spark, 900)
    write = jobs.state_writer(paths.sink, lambda rows: wd.daily_states(rows, EDGES, ["model_version"]))
    parts = [scored.where(F.col("model_version") == v) for v in "123"]
    for p in parts:
        jobs.land_files(p, paths.source)
        jobs.run_batches(jobs.read_stream(spark, paths.source, scored.schema), write, paths.checkpoint)
    jobs.run_batches(jobs.read_stream(spark, paths.source, scored.schema), write, paths.checkpoint)  # nothing new
    write(parts[2], 2)
    write(scored.limit(0), 9)
    states = spark.read.parquet(paths.sink)
    assert sorted(r.batch_id for r in states.select("batch_id").distinct().collect()) == [0, 1, 2]
    batch = wd.binned_drift(wd.window_pairs(wd.daily_states(scored, EDGES, ["model_version"]), BASE, CURRENT, ["model_version"]), ["model_version"])
    stream = wd.binned_drift(wd.window_pairs(states, BASE, CURRENT, ["model_version"]), ["model_version"])
    assert sorted(stream.collect()) == sorted(batch.collect())


def test_last_in_groups_equals_window(spark):
    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", None]), rnd.randrange(400), i, rnd.random() if rnd.random() < 0.1 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, t int, id long, v double").repartition(6)
    got = last_in_groups(df, ["g"], ["t", "id"], {"v": "seen"}).select("id", "seen")
    w = Window.partitionBy("g").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.last("v", ignorenulls=True).over(w).alias("seen"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_equals_search(spark, strict):
    rnd = random.Random(6)
    at = lambda k: DAY + dt.timedelta(minutes=k)
    key = lambda: "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "none", None])
    left = [(i, key(), at(rnd.randrange(300)) if rnd.random() < 0.97 else None) for i in range(2500)]
    right = [(k, at(rnd.randrange(300)), v) for v, k in enumerate(rnd.choice(["hot", "a", "b", None]) for _ in range(400))] + [("a", None, 999)]
    met = asof_join(spark.createDataFrame(left, "id long, name string, scored timestamp_ntz").repartition(5),
                    spark.createDataFrame(right, "name string, made timestamp_ntz, version long").repartition(3), ["name"], "scored", "made", ["version", "made"], ties=["version"], strict=strict)
    by_key: dict = {}
    for k, t, v in sorted((r for r in right if r[0] is not None and r[1] is not None), key=lambda r: (r[1], r[2])):
        by_key.setdefault(k, []).append((t, v))
    want = []
    for i, k, t in left:
        past = by_key.get(k, []) if t is not None else []
        cut = bisect.bisect_left(past, (t, -1)) if strict else bisect.bisect_right(past, (t, 10**9))
        want.append((i, k, t, past[cut - 1][1] if past and cut else None, past[cut - 1][0] if past and cut else None))
    assert sorted(map(tuple, met.collect())) == sorted(want, key=lambda r: r[0])
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_spine_has_no_gaps_and_carries_the_last_run(spark):
    at = lambda h: DAY + dt.timedelta(hours=h)
    points = spark.createDataFrame([("r1", "e", "batch_rmse", 7.0, at(1)), ("r1", "e", "batch_r2", 0.9, at(1)), ("r2", "e", "batch_rmse", 1.0, at(25)), ("r3", "f", "batch_rmse", float("nan"), at(2))],
                                   "run_id string, experiment_id string, metric_name string, metric_value double, metric_time timestamp_ntz")
    bounds = spark.createDataFrame([("e", at(1), at(31)), ("f", at(2), at(2)), ("g", at(7), at(13)), ("h", None, None)], "experiment_id string, first timestamp_ntz, last timestamp_ntz")
    spine = gt.time_spine(bounds, ["experiment_id"], "first", "last", "6 hours")
    rows = gt.evaluate(gt.carried_windows(points, spine, "6 hours", ["experiment_id"]), keep=["experiment_id", "window_start", "batch_rmse_age_s"]).collect()
    got = {(r.experiment_id, (r.window_start - DAY).total_seconds() / 3600): (r.latest_rmse, r.retrain_needed, r.batch_rmse_age_s) for r in rows}
    h = 3600
    assert got == {("e", 0): (7.0, True, 5 * h), ("e", 6): (7.0, True, 11 * h), ("e", 12): (7.0, True, 17 * h), ("e", 18): (7.0, True, 23 * h), ("e", 24): (1.0, False, 5 * h), ("e", 30): (1.0, False, 11 * h),
                   ("f", 0): (None, False, 4 * h), ("g", 6): (None, False, None), ("g", 12): (None, False, None)}


def test_first_breach_answers_the_later_ones(spark):
    at = lambda h: DAY + dt.timedelta(hours=h)
    points = spark.createDataFrame([("m", "1", "r2", "batch_rmse", 9.0, at(3)), ("m", "1", "r1", "batch_rmse", 9.0, at(3)), ("m", "1", "r0", "batch_r2", 0.5, at(1)), ("m", "1", "r3", "batch_r2", 0.4, at(4)),
                                    ("m", "2", "r4", "batch_rmse", float("nan"), at(5)), ("m", "2", "r5", "batch_rmse", None, at(6))],
                                   "name string, version string, run_id string, metric_name string, metric_value double, metric_time timestamp_ntz")
    got = {r.version: tuple(r)[2:] for r in gt.first_breaches(points, ["name", "version"]).collect()}
    assert got == {"1": (4, 3, at(3), "r1"), "2": (2, 0, None, None)}


def test_state_table_is_all_that_drift_reads(spark):
    path = scratch_path(spark, "states")
    wd.daily_states(_scored(spark, 500), EDGES, ["model_version"]).write.parquet(path)
    plan = wd.binned_drift(wd.window_pairs(spark.read.parquet(path), BASE, CURRENT, ["model_version"]), ["model_version"])._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "GreaterThanOrEqual(day" in scan and "sketch" not in scan.split("ReadSchema")[1].splitlines()[0]
