"""Streams replayed one micro-batch per part: closing top-N, panes, refreshed dimensions, compacted upserts, rows without a time."""

from __future__ import annotations

import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from check_queries import TABLES, compare, duck
from frames import rows
from weirworks.operators import joins, ranking, triggers
from weirworks.plans import ORACLES, QUERIES
from weirworks.session import scratch_dir
from weirworks.sources import files
from weirworks.sources.snapshots import Snapshots, refreshed_lookup
from weirworks.sources.upserts import UpsertTable
from weirworks.streaming import stateful
from weirworks.streaming.replay import Replay
from weirworks.streaming.runner import run_append, run_batches, run_to_changes
from weirworks.tables import events

MINUTE = 60 * 10**6


def states(spark, checkpoint, name):
    found = [r.operatorId for r in stateful.list_state_operators(spark, checkpoint).collect() if name in r.operatorName]
    return stateful.read_state(spark, checkpoint, "state", found[0])


def test_top_of_closed_windows(spark, sf):
    """Five micro-batches: the stream gives the batch result of closed windows, and holds no closed window any more."""
    e = events(spark, sf, "view").withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", "ts", "item_id")
    parts = [e.filter(F.floor((F.dayofmonth("ts") - 1) / 6) == i) for i in range(5)]
    replay, checkpoint = Replay(parts), scratch_dir(spark, "checkpoint")
    live = stateful.hot_items(replay.stream().withWatermark("ts", "10 minutes"), "ts", "item_id", "60 minutes", "15 minutes", 2)
    got = run_append(live, checkpoint=checkpoint, feed=replay)
    mark = e.agg(F.max("ts")).first()[0].timestamp() * 10**6 // 1000 * 1000 - 10 * MINUTE
    want = ranking.hot_items(e, "ts", "item_id", "60 minutes", "15 minutes", 2).filter(F.unix_micros("window_end") <= int(mark))
    assert rows(got) == rows(want.select(*got.columns)) and got.count() > 100
    assert states(spark, checkpoint, "transformWithState").count() == 0


def test_top_of_windows_with_unknown_items(spark):
    """Equal counts of an unknown item and a known one; counts go through two stateful steps, not three."""
    data = [(i, i * 60, None if i % 2 else i % 4) for i in range(120)]
    e = spark.createDataFrame(data, "event_id long, s long, item_id int").select("event_id", F.timestamp_seconds("s").alias("ts"), "item_id")
    replay, checkpoint = Replay([e.filter("event_id < 60"), e.filter("event_id >= 60")]), scratch_dir(spark, "checkpoint")
    live = stateful.hot_items(replay.stream().withWatermark("ts", "10 minutes"), "ts", "item_id", "8 minutes", "4 minutes", 3)
    got = run_append(live, checkpoint=checkpoint, feed=replay)
    want = ranking.hot_items(e, "ts", "item_id", "8 minutes", "4 minutes", 3).filter(F.unix_seconds("window_end") <= 119 * 60 - 600).select(*got.columns)
    assert set(map(tuple, got.collect())) == set(map(tuple, want.collect())) and got.count() == want.count() > 60
    assert got.filter("item_id is null").count() > 20 and stateful.list_state_operators(spark, checkpoint).select("operatorId").distinct().count() == 2


def panes_by_hand(arrivals, size, delay, early, late):
    """(key, event time, id, value) per micro-batch, in minutes."""
    held, out, mark, high = defaultdict(lambda: [0, 0, 0, False]), [], 0, None
    for batch in arrivals:
        for key, at, i, value in sorted(batch, key=lambda r: r[2]):
            start = at // size * size
            if mark >= start + size + late:
                continue
            w = held[key, start]
            w[0], w[1] = w[0] + 1, w[1] + value
            if mark >= start + size:
                w[2] += 1
                out.append((key, start, mark, "late", w[2], w[0], w[1]))
            else:
                w[3] = True
        high = max([at for _, at, *_ in batch] + ([high] if high is not None else []))
        before, mark = mark, max(mark, high - delay, 0)
        for (key, start), w in held.items():
            end = start + size
            due = [(t, "early") for t in ([(before // early + 1) * early] if before > 0 else []) if t <= mark and t < end]
            due += [(end, "on_time")] if before < end <= mark else []
            for t, kind in due if w[3] else []:
                w[2] += 1
                out.append((key, start, t, kind, w[2], w[0], w[1]))
    return sorted(out)


@pytest.mark.parametrize("late", [0, 25])
def test_panes_on_stream_and_batch(spark, late):
    """Early, on-time and late results: the stream, the batch formula and a loop agree, and closed windows leave the state."""
    rng = random.Random(late)
    base = 28_400_000  # minutes since the epoch, a time in 2023
    arrivals, at, i = [], base, 0
    for _ in range(9):
        batch = []
        for _ in range(rng.randint(1, 12)):
            at += rng.choice([0, 1, 4, 9])
            i += 1
            batch.append((rng.randint(1, 3), at - rng.choice([0, 0, 3, 12, 45, 90, 200]), i, rng.randint(-5, 9)))
        arrivals.append(batch)
    want = panes_by_hand(arrivals, 60, 10, 15, late)
    assert {k for *_, k, _, _, _ in want} >= {"early", "on_time"} | ({"late"} if late else set())

    schema = "user long, us long, id long, value long, batch long"
    flat = [(k, t * MINUTE, n, v, b) for b, batch in enumerate(arrivals) for k, t, n, v in batch]
    df = spark.createDataFrame(flat, schema).withColumn("at_ts", F.timestamp_micros("us"))
    how = {"size": "60 minutes", "delay": "10 minutes", "early": "15 minutes", "lateness": f"{late} minutes"}

    def shown(panes):
        minutes = [(F.unix_micros(F.col(c).cast("timestamp")) / MINUTE).cast("long") for c in ("window_start", "fired_at")]
        return rows(panes.select("user", *minutes, "kind", "pane", "n", F.col("total").cast("long")))

    for slices in (None, 7):
        assert shown(triggers.fired_panes(df, ["user"], "batch", "at_ts", "id", "value", slices=slices, **how)) == want
    replay, checkpoint = Replay([df.filter(f"batch = {b}").drop("batch", "us") for b in range(len(arrivals))]), scratch_dir(spark, "checkpoint")
    live = stateful.fired_panes(replay.stream(), ["user"], "at_ts", "id", "value", **how)
    assert shown(run_append(live, checkpoint=checkpoint, feed=replay)) == want
    mark = max(t for _, t, *_ in flat) - 10 * MINUTE
    open_windows = {(k, t // (60 * MINUTE)) for k, t, *_ in flat if t // (60 * MINUTE) * 60 * MINUTE + (60 + late) * MINUTE > mark}
    assert states(spark, checkpoint, "transformWithState").count() <= len(open_windows)


def test_panes_of_nothing_and_of_rows_without_time(spark):
    df = spark.createDataFrame([(1, None, 1, 5, 0)], "user long, at_ts timestamp, id long, value long, batch long")
    for part in (df, df.limit(0)):
        assert triggers.fired_panes(part, ["user"], "batch", "at_ts", "id", "value", "1 hour", "1 minute", "10 minutes", "5 minutes").count() == 0


def test_refreshed_dimension(spark, tmp_path):
    """Versions 1 and 2 can't be loaded (damaged file, repeated key): version 0 stays until version 3 comes."""
    schema = spark.createDataFrame([(1, "a")], "k long, name string").schema
    snapshots, out = Snapshots(spark, str(tmp_path / "dim"), schema, ["k"]), str(tmp_path / "out")
    stream = spark.createDataFrame([(k, b) for b in range(4) for k in (1, 2, 3)], "k long, b long")
    replay = Replay([stream.filter(f"b = {b}") for b in range(4)])
    versions = {0: [(1, "a0"), (2, "b0")], 2: [(1, "x"), (1, "y")], 3: [(3, "c3")]}

    def feed():
        for i in replay:
            snapshots.publish(spark.createDataFrame(versions.get(i, [(9, "z")]), schema), i)
            if i == 1:
                for part in Path(snapshots.folder(1)).glob("part-*"):
                    part.write_bytes(b"PAR1 this is no parquet file PAR1")
                    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
            yield i

    run_batches(replay.stream(), refreshed_lookup(snapshots, out), feed=feed())
    got = [tuple(r) for r in spark.read.parquet(out).select("b", "k", "name", "lookup_failed", "version").collect()]
    first = [(1, "a0", False, 0), (2, "b0", False, 0), (3, None, True, 0)]
    assert len(got) == 12 and set(got) == {(b, *r) for b in range(3) for r in first} | {(3, 1, None, True, 3), (3, 2, None, True, 3), (3, 3, "c3", False, 3)}
    assert set(snapshots.failed) == {1, 2} and snapshots.good >= {0, 3}


def test_versioned_lookup_follows_whole_versions(spark):
    e = spark.createDataFrame([(i, f"2024-01-0{d}", k) for i, (d, k) in enumerate([(1, 1), (3, 1), (3, 2), (5, 1), (5, 2)])], "id long, day string, k long")
    e = e.withColumn("ts", F.col("day").cast("timestamp_ntz"))
    versions = spark.createDataFrame([("2024-01-02", 0), ("2024-01-04", 1)], "day string, version long").select(F.col("day").cast("timestamp_ntz").alias("since"), "version")
    dim = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (1, 2, "B")], "version long, k long, name string")
    got = joins.version_lookup(e, "ts", "id", versions, dim, ["k"]).select("id", "name", "lookup_failed")
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, "a", False), (2, "b", False), (3, None, True), (4, "B", False)]


def upserts(spark, tmp_path, every=3):
    schema = spark.createDataFrame([("a", 1)], "k string, v long").schema
    table = UpsertTable(spark, str(tmp_path / "t"), schema, ["k"], every)
    return table, lambda batch_id, **kv: table.write(spark.createDataFrame(list(kv.items()), schema), batch_id)


def test_upserts_are_compacted(spark, tmp_path):
    table, write = upserts(spark, tmp_path)
    assert table.read().count() == 0
    want = {}
    for b in range(11):
        changed = {f"k{b % 4}": b, "all": b}
        write(b, **changed)
        want |= changed
        assert dict(rows(table.read())) == want
        assert len(table.deltas(table.bases()[-1] if table.bases() else -1)) < 3  # a read costs one base and at most two deltas here
    assert len(table.bases()) <= 2 and len(table.deltas()) <= 6
    assert len(table.read().inputFiles()) <= sum(len(list(Path(p).glob("part-*"))) for p in (tmp_path / "t").rglob("*=*")) and table.bases() == [5, 8]


def test_upserts_survive_repeats_and_crashes(spark, tmp_path, monkeypatch):
    table, write = upserts(spark, tmp_path)
    write(0, a=1, b=1)
    write(1, a=2)
    write(1, a=2)  # the batch ran again
    monkeypatch.setattr(table, "clean", lambda keep_from: None)
    write(2, c=3)  # compacts, then stops before anything is removed
    want = {"a": 2, "b": 1, "c": 3}
    assert table.bases() == [2] and len(table.deltas()) == 3 and dict(rows(table.read())) == want
    write(2, c=3)  # the stream starts again with the batch it had not recorded
    assert dict(rows(table.read())) == want
    write(3, a=4)
    half = tmp_path / "t" / "base" / "upto=3"  # a base that was not committed
    half.mkdir(parents=True)
    (half / "part-00000.parquet").write_bytes(b"half")
    assert table.bases() == [2] and dict(rows(table.read())) == want | {"a": 4}
    monkeypatch.undo()
    write(4, b=5)
    write(5, b=6)
    assert table.bases() == [2, 5] and dict(rows(table.read())) == want | {"a": 4, "b": 6}
    assert files.names(spark, str(tmp_path / "nowhere")) == []


def test_changes_of_a_stream_over_many_batches(spark):
    df = spark.createDataFrame([(i % 3, i, i) for i in range(30)], "k long, v long, i long")
    replay = Replay([df.filter(f"floor(i / 3) = {b}") for b in range(10)])
    got = run_to_changes(replay.stream().groupBy("k").agg(F.sum("v").alias("total")), ["k"], feed=replay)
    assert rows(got) == rows(df.groupBy("k").agg(F.sum("v").alias("total")))


@pytest.fixture(scope="module")
def odd_times(spark, sf, tmp_path_factory):
    """The tables with rows without a time and one row long before the others."""
    folder = tmp_path_factory.mktemp("odd")
    for t in TABLES:
        if t != "events":
            (folder / f"{t}.parquet").symlink_to(f"{sf}/{t}.parquet")
    e = spark.read.parquet(f"{sf}/events.parquet")
    odd = F.when(F.col("event_id") % 50 == 0, F.lit(None)).when(F.col("event_id") == 7, F.lit("2020-02-29 13:00:00").cast("timestamp_ntz")).otherwise(F.col("ts"))
    e.withColumn("ts", odd.cast(e.schema["ts"].dataType)).toPandas().to_parquet(folder / "events.parquet", coerce_timestamps="us")
    return str(folder)


@pytest.mark.parametrize("name", ["snk_upsert_changes", "snk_parquet_bucketed", "trig_continuous_proc", "state_read", "state_bootstrap", "state_evolve"])
def test_rows_without_time_and_outliers(spark, odd_times, name):
    assert compare(QUERIES[name](spark, odd_times), duck(odd_times), ORACLES[name]).startswith("OK")


def test_panes_call_the_state_by_buckets(spark):
    """Windows of many keys share state values and timers: none of their own for each of 400 windows."""
    assert "bucket" in stateful.fired_panes(
        Replay([spark.createDataFrame([(k, k, 1) for k in range(400)], "user long, id long, value long").withColumn("at_ts", F.timestamp_seconds("id"))]).stream(),
        ["user"], "at_ts", "id", "value", "1 hour", "1 minute", "10 minutes", "5 minutes")._jdf.queryExecution().analyzed().toString()
    calls = []

    class Value:
        def get(self):
            calls.append("get")

        def update(self, value):
            calls.append("update")
            self.value = value

    class Timers:
        def registerTimer(self, ms):
            calls.append("timer")

        def getCurrentWatermarkInMs(self):
            return 0

    class In(dict):
        def __getattr__(self, name):
            return self[name]

    panes = stateful.Panes(60 * MINUTE, 10 * MINUTE, 5 * MINUTE, ["user", "start_us"], ["bigint", "bigint"])
    panes.state, panes.handle = Value(), Timers()
    batch = (In(tie=i, amount=1.0, user=i % 400, start_us=0) for i in range(1_200))
    assert list(panes.handleInputRows((7,), batch, Timers())) == [] and calls == ["get", "timer", "update"]
    assert panes.state.value[2] == [3] * 400


def test_idle_counts_call_the_state_once_per_key():
    calls = []

    class Fake:
        def __getattr__(self, name):
            return lambda *a: calls.append((name, *a))

    class In:
        def __init__(self, us):
            self.us = self.tie = us

    idle = stateful.IdleCount(100_000)
    idle.state = idle.handle = Fake()
    assert [r.n for r in idle.handleInputRows((1,), map(In, [50_000, 0, 100_000, 300_000]), None)] == [1, 2, 3, 1]
    assert calls == [("get",), ("registerTimer", 400), ("update", (1, 300_000))]
