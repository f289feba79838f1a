"""Ordered operators with hot keys: a tiny hot-row limit against plain window functions or loops."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W, functions as F

from frames import rows
from weirworks.functions.expr import micros
from weirworks.operators import analytic, greedy, joins, windows
from weirworks.operators.ordered import Ordered, following, latest, next_known, previous, running_count, running_max, total, trailing_sum

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows: key 0 holds half of them, a quarter in one burst; times repeat."""
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = 0 if i % 2 == 0 else rng.randrange(1, 40)
        second = 5000 + rng.randrange(60) if i % 4 == 0 else rng.randrange(20000)
        data.append((i, key, BASE + dt.timedelta(seconds=second), rng.randrange(100), rng.choice("abc")))
    return spark.createDataFrame(data, "id BIGINT, k BIGINT, ts TIMESTAMP_NTZ, v BIGINT, kind STRING").cache()


LIMITS = [1, 7, 200]  # numbers of slices


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("keys", [["k"], []])
def test_scans_equal_window_functions(skewed, keys, limit):
    known = F.when(F.col("kind") == "a", F.col("v"))
    w = W.partitionBy(*keys).orderBy("ts", "id")
    want = skewed.select(
        "id", F.sum("v").over(w).alias("t"), F.row_number().over(w).cast("bigint").alias("n"), F.max("v").over(w).alias("m"),
        F.lag("kind").over(w).alias("p"), F.lead("kind").over(w).alias("f"),
        F.last(known, True).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("l"),
        F.first(known, True).over(w.rowsBetween(1, W.unboundedFollowing)).alias("x"))
    got = Ordered(skewed, keys, ["ts", "id"], limit).scan(
        t=total("v"), n=running_count(), m=running_max("v"), p=previous("kind"), f=following("kind"), l=latest(known), x=next_known(known))
    assert sorted(map(str, got.result().select(*want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("seconds", [3, 700, 30000])
def test_trailing_sum(skewed, limit, seconds):
    us = seconds * 10**6
    w = W.partitionBy("k").orderBy(micros("ts")).rangeBetween(-us, 0)
    want = skewed.select("id", F.sum("v").over(w).alias("s"))
    got = trailing_sum(skewed, ["k"], "ts", F.col("v"), us, "s", limit).select("id", "s")
    assert rows(got) == rows(want)


def greedy_loop(data, span, max_count=None, gap=None):
    out, state = {}, {}
    for i, k, ts, *_ in sorted(data, key=lambda r: (r[1], r[2], r[0])):
        us = int((ts - BASE).total_seconds() * 10**6)
        a = state.get(k)
        if a is None or us - a["us"] >= span or (max_count and a["n"] >= max_count) or (gap is not None and us - a["last"] > gap):
            a = state[k] = {"us": us, "id": i, "n": 0}
        a["n"] += 1
        a["last"] = us
        out[i] = a["id"]
    return sorted(out.items())


@pytest.mark.parametrize("limit,block", [(1, 1 << 16), (20, 1 << 16), (20, 16)])
@pytest.mark.parametrize("span,max_count,gap", [(60, None, None), (4000, None, 40), (300, 3, None), (50000, 7, 100)])
def test_greedy_chain(skewed, monkeypatch, limit, block, span, max_count, gap):
    monkeypatch.setattr(greedy, "BLOCK", block)
    s = 10**6
    got = greedy.chain(skewed, ["k"], "ts", "id", span * s, max_count, None if gap is None else gap * s, limit)
    want = greedy_loop([tuple(r) for r in skewed.collect()], span * s, max_count, None if gap is None else gap * s)
    assert rows(got, "id", "anchor_id") == want


def test_bounded_sessions_stay_below_bound(skewed):
    out = greedy.bounded_sessions(skewed, ["k"], "ts", "id", "30 seconds", "2 minutes", 100)
    spans = out.groupBy("k", "anchor_ts").agg((F.max(micros("ts")) - F.min(micros("ts")) + 30 * 10**6).alias("span"))
    assert spans.filter(F.col("span") >= 120 * 10**6).isEmpty()
    assert out.count() == skewed.count()


@pytest.mark.parametrize("limit", LIMITS)
def test_sessions(skewed, limit):
    got = rows(windows.assign_sessions(skewed, ["k"], "ts", "id", "5 minutes", limit), "id", "session_start")
    want, state = [], {}
    for i, k, ts, *_ in sorted([tuple(r) for r in skewed.collect()], key=lambda r: (r[1], r[2], r[0])):
        start, last = state.get(k, (ts, ts))
        if ts - last > dt.timedelta(minutes=5):
            start = ts
        state[k] = (start, ts)
        want.append((i, start))
    assert got == sorted(want)


@pytest.mark.parametrize("limit", LIMITS)
def test_asof_and_buffered(skewed, limit):
    left = skewed.filter("kind <> 'a'").select("k", "id", "ts", "v")
    right = skewed.filter("kind = 'a'").select("k", F.col("id").alias("rid"), F.col("ts").alias("rts"), F.col("v").alias("rate"))
    versions = {}
    for r in right.collect():
        versions.setdefault(r.k, []).append((r.rts, r.rid, r.rate))
    want, want_wait = [], []
    for r in left.collect():
        vs = sorted(versions.get(r.k, []))
        back = [v for v in vs if v[0] <= r.ts]
        if back:
            want.append((r.id, back[-1][2]))
        chosen = back[-1] if back else (vs[0] if vs else None)
        if chosen:
            want_wait.append((r.id, chosen[2], max(r.ts, chosen[0])))
    got = joins.asof_join(left, right, ["k"], "ts", "id", "rts", "rid", ["rate"], slices=limit)
    assert rows(got, "id", "rate") == sorted(want)
    got = joins.buffered_asof_join(left, right, ["k"], "ts", "id", "rts", "rid", ["rate"], slices=limit)
    assert rows(got, "id", "rate", "emitted_at") == sorted(want_wait)
    outer = joins.asof_join(left, right, ["k"], "ts", "id", "rts", "rid", ["rate"], how="left", slices=limit)
    assert outer.count() == left.count()


@pytest.mark.parametrize("inclusive", [True, False])
def test_bucketed_interval_join_equals_plain(skewed, inclusive):
    a = skewed.select("k", F.col("id").alias("a"), F.col("ts").alias("ta"))
    b = skewed.select("k", F.col("id").alias("b"), F.col("ts").alias("tb"))
    plain = joins.interval_join(a, b, ["k"], "ta", "tb", "-20 seconds", "45 seconds", inclusive)
    bucketed = joins.interval_join(a, b, ["k"], "ta", "tb", "-20 seconds", "45 seconds", inclusive, bucketed=True)
    assert rows(bucketed, "k", "a", "b") == rows(plain, "k", "a", "b")


def test_match_or_timeout_hot_key(spark):
    left = spark.createDataFrame([(k, BASE + dt.timedelta(days=d)) for k in (1, 2) for d in range(20)], "k BIGINT, ts TIMESTAMP_NTZ")
    right = spark.createDataFrame([(1, BASE + dt.timedelta(days=d * 3)) for d in range(8)], "k BIGINT, rts TIMESTAMP_NTZ")
    for limit in (1000, 4):
        out = joins.match_or_timeout(left, right, ["k"], "ts", "rts", F.lit(1), limit)
        # shipments on days 0, 3, .. 21: days 0, 3, .. 18 (7) and 2, 5, .. 17 (6) have one within a day
        assert rows(out.groupBy("k", "status").count()) == [(1, "on_time", 13), (1, "timeout", 7), (2, "timeout", 20)]


def test_live_counts(skewed):
    out = analytic.live_count_changes(skewed, ["k"], "ts", "id", "10 minutes", 20)
    assert out.filter("live < 0").isEmpty()
    assert out.count() == 2 * skewed.count()
    last = W.partitionBy("k").orderBy(F.desc("at_ts"), F.desc("kind"), F.desc("id"))
    final = out.filter("kind = 'expire'").withColumn("rn", F.row_number().over(last)).filter("rn = 1")
    assert {r.live for r in final.collect()} == {0}


def test_group_lists_are_cut_but_whole(skewed):
    from weirworks.operators.aggs import group_lists

    out = group_lists(skewed, ["k"], ["ts", "id"], F.col("id"), "ids", chunk=7, slices=20).collect()
    assert max(len(r.ids) for r in out) == 7
    want = {}
    for i, k, ts, *_ in sorted([tuple(r) for r in skewed.collect()], key=lambda r: (r[2], r[0])):
        want.setdefault(k, []).append(i)
    got = {}
    for r in sorted(out, key=lambda r: (r.k, r.chunk_no)):
        got.setdefault(r.k, []).extend(r.ids)
    assert got == want


def test_layout_bounds_bursts_and_string_ties(spark):
    """2,000 rows of one key at one time: no slice holds many of them, whatever the tie-break's type."""
    rows_ = [(None if i % 2 else 1, BASE, f"t{i:05d}", float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows_, "k BIGINT, ts TIMESTAMP_NTZ, tie STRING, v DOUBLE")
    laid = Ordered(df, ["k"], ["ts", "tie"], 40)
    sizes = [r["count"] for r in laid.df.groupBy("__slice").count().collect()]
    assert len(sizes) > 30 and max(sizes) < 400
    got = laid.scan(n=running_count(), p=previous("v"), t=total("v")).result()
    w = W.partitionBy("k").orderBy("ts", "tie")
    want = df.select("tie", F.row_number().over(w).cast("bigint").alias("n"), F.lag("v").over(w).alias("p"), F.sum("v").over(w).alias("t"))
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("slices", [2, 200])
def test_null_keys_and_string_ties_in_chains(spark, slices):
    data = [(i, None if i % 3 else i % 2, BASE + dt.timedelta(seconds=i * 7 % 400), f"{i:03d}") for i in range(300)]
    df = spark.createDataFrame(data, "id BIGINT, k BIGINT, ts TIMESTAMP_NTZ, tie STRING")
    got = {r.id: r.anchor_id for r in greedy.chain(df, ["k"], "ts", "tie", 30 * 10**6, 4, slices=slices).collect()}
    want, state = {}, {}
    for i, k, ts, tie in sorted(data, key=lambda r: (r[2], r[3])):
        a = state.get(k)
        if a is None or ts - a[0] >= dt.timedelta(seconds=30) or a[2] >= 4:
            a = state[k] = [ts, tie, 0]
        a[2] += 1
        want[i] = a[1]
    assert got == want


def test_trailing_sum_keeps_null_keys_and_refuses_doubles(spark):
    df = spark.createDataFrame([(None, BASE, 1), (None, BASE, 2), (1, BASE, 5), (1, BASE + dt.timedelta(seconds=9), 7)], "k BIGINT, ts TIMESTAMP_NTZ, v BIGINT")
    assert sorted(r.s for r in trailing_sum(df, ["k"], "ts", F.col("v"), 5 * 10**6, "s").collect()) == [3, 3, 5, 7]
    with pytest.raises(TypeError):
        trailing_sum(df, ["k"], "ts", F.col("v") * 0.5, 1, "s")


def test_running_distinct_keeps_null_rows(spark):
    from weirworks.operators.aggs import running_distinct

    df = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, None, "x"), (4, "a", "x"), (5, "a", "y"), (6, None, "x")], "id BIGINT, k STRING, v STRING")
    assert rows(running_distinct(df, ["k"], ["id"], "v", "n"), "id", "n") == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 1)]


def test_one_first_row_per_session(spark):
    from weirworks.operators.triggers import session_firsts

    df = spark.createDataFrame([(i, 1, BASE) for i in range(10)] + [(10, 1, BASE + dt.timedelta(hours=2)), (11, None, BASE)], "id BIGINT, k BIGINT, ts TIMESTAMP_NTZ")
    assert rows(session_firsts(df, ["k"], "ts", "id", "1 hour"), "id") == [(0,), (10,), (11,)]


def test_full_batches_at_one_time_stay_apart(spark):
    df = spark.createDataFrame([(i, 1, BASE) for i in range(10)], "id BIGINT, k BIGINT, ts TIMESTAMP_NTZ")
    out = greedy.count_or_delay(df, ["k"], "ts", "id", 5, "1 day")
    assert rows(out.groupBy("anchor_ts", "anchor_id").count(), "anchor_id", "count") == [(0, 5), (5, 5)]


def test_defaults_only_where_nothing_matched(spark):
    left = spark.createDataFrame([(1,), (2,)], "k BIGINT")
    right = spark.createDataFrame([(1, None)], "k BIGINT, v BIGINT")
    assert sorted(joins.lookup(left, right, ["k"], "left", {"v": 0}).collect()) == [(1, None), (2, 0)]


def test_weighted_average_of_large_values(spark):
    from weirworks.operators.aggs import weighted_average

    df = spark.createDataFrame([(2**60 + 1, 1), (-7, 0)], "v BIGINT, w BIGINT")
    assert df.agg(weighted_average("v", "w")).first()[0] == 2**60 + 1


def test_scratch_folder_must_be_shared_on_a_cluster():
    from types import SimpleNamespace as Fake

    from weirworks.session import scratch_dir

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            scratch_dir(Fake(conf=Fake(get=lambda *_: None), sparkContext=Fake(master=master)), "x")
    assert scratch_dir(Fake(conf=Fake(get=lambda *_: "s3://b/c/"), sparkContext=Fake(master="yarn")), "x").startswith("s3://b/c/weirworks/x-")


@pytest.mark.parametrize("slices", [1, 40])
def test_running_top_after_each_row(skewed, slices):
    from weirworks.operators.ranking import running_top_n

    got = {r.id: [(e.item, e.total) for e in r.top] for r in running_top_n(skewed, ["kind"], ["ts", "id"], "k", "v", 3, slices=slices).collect()}
    sums, want = {}, {}
    for i, k, ts, v, kind in sorted([tuple(r) for r in skewed.collect()], key=lambda r: (r[2], r[0])):
        mine = sums.setdefault(kind, {})
        mine[k] = mine.get(k, 0) + v
        want[i] = [(a, float(b)) for a, b in sorted(mine.items(), key=lambda x: (-x[1], x[0]))[:3]]
    assert got == want


def test_running_top_of_ordinary_keys_takes_one_shuffle(spark):
    """Totals are added up in the fold (null: nothing), decimal ones by Spark; both give the same tops over several batches of rows."""
    from weirworks.operators.ranking import running_top_n

    df = spark.range(30_000).selectExpr("id % 3 k", "id", "id * 7 % 11 item", "if(id % 5 = 0, null, id % 4) as v", "cast(id % 4 as decimal(10, 0)) as d").withColumn("d", F.when(F.col("v").isNotNull(), F.col("d")))
    plain = running_top_n(df.drop("d"), ["k"], ["id"], "item", "v", 3)
    plan = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("RepartitionByExpression") == 1
    want, held = {}, {}
    for r in df.orderBy("id").collect():
        mine = held.setdefault(r.k, {})
        mine[r.item] = mine.get(r.item, 0) + (r.v or 0)
        want[r.id] = [(x, float(t)) for x, t in sorted(mine.items(), key=lambda e: (-e[1], e[0]))[:3]]
    for got in (plain, running_top_n(df.drop("v"), ["k"], ["id"], "item", "d", 3)):
        assert {r.id: [(e.item, e.total) for e in r.top] for r in got.collect()} == want
