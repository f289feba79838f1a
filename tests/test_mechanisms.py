"""Buffered sink, rolling files, start positions, metrics of a running query, state that expires, SQL functions, hot keys by count."""

from __future__ import annotations

import json
import time
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from frames import rows
from weirworks.functions.sql import register
from weirworks.operators import ordered, timers
from weirworks.operators.ordered import Grouped, Ordered, following, hot_keys, latest, max_before, next_known, previous, running_count, running_max, scanned_by_key, total
from weirworks.plans.sources import snk_latest_kv
from weirworks.session import scratch_dir
from weirworks.sources import files, readers, writers
from weirworks.streaming import stateful
from weirworks.streaming.metrics import MetricsLog, observed
from weirworks.streaming.replay import Replay
from weirworks.streaming.runner import run_append, run_to_files, use_rocksdb
from weirworks.tables import SCHEMAS, events


def test_sink_flushes_by_number_or_time_across_a_restart(spark, tmp_path):
    """Ten rows flush at once, the rest when the interval is over, after a restart: nothing is lost or repeated."""
    df = spark.createDataFrame([(i,) for i in range(25)], "id long")
    replay = Replay([df.filter("id < 24"), df.filter("id >= 24")])
    use_rocksdb(df)
    out, checkpoint, parts = str(tmp_path / "out"), str(tmp_path / "checkpoint"), iter(replay)
    live = stateful.batch_or_interval(replay.stream(), 1, 10, "4 seconds")
    writer = live.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds")

    def run_until(n):
        query = writer.start()
        deadline = time.time() + 60
        try:
            while time.time() < deadline and query.exception() is None:
                if Path(out, "_spark_metadata").exists() and spark.read.schema(live.schema).parquet(out).count() >= n:
                    break
                time.sleep(0.2)
        finally:
            query.stop()
        assert query.exception() is None

    next(parts)
    run_until(20)
    first = rows(spark.read.schema(live.schema).parquet(out).select("chunk", "reason", "id"))
    assert {(c, r) for c, r, _ in first} >= {(0, "count"), (1, "count")}
    next(parts)
    run_until(25)
    got = rows(spark.read.schema(live.schema).parquet(out).select("chunk", "reason", "id"))
    assert sorted(i for _, _, i in got) == list(range(25))
    sizes = defaultdict(int)
    for c, r, _ in got:
        sizes[c, r] += 1
    assert sizes[0, "count"] == sizes[1, "count"] == 10 and sum(n for (_, r), n in sizes.items() if r == "interval") == 5


@pytest.mark.parametrize("slices", [None, 5])
def test_rolling_parts_keep_size_age_and_idle_time(spark, slices):
    data = [(i, i * 7 + (i // 30) * 400, "x" * (i % 23), "ab"[i % 11 == 0]) for i in range(400)]
    df = spark.createDataFrame(data, "id long, s long, text string, bucket string").select("id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "text", "bucket")
    got = writers.rolling_parts(df, "ts", "id", "bucket", 900, "600 seconds", "100 seconds", slices).withColumn("s", F.unix_seconds(F.col("ts").cast("timestamp")))
    files = defaultdict(list)
    for r in sorted(got.collect(), key=lambda r: r.id):
        files[r.bucket, r.part].append(r)
    assert sum(map(len, files.values())) == 400 and len(files) > 20
    for (bucket, part), held in files.items():
        size = sum(len(json.dumps({"id": r.id, "ts": r.ts.strftime("%Y-%m-%dT%H:%M:%S.000"), "text": r.text, "bucket": r.bucket}, separators=(",", ":"))) + 1 for r in held)
        assert size <= 900 and held[-1].s - held[0].s < 600 and all(b.s - a.s <= 100 for a, b in zip(held, held[1:]))
    for bucket in "ab":
        mine = [files[bucket, p] for p in range(1, sum(b == bucket for b, _ in files) + 1)]
        assert all(a[-1].id < b[0].id for a, b in zip(mine, mine[1:]))  # numbered without gaps, in time order
        assert sum(len(f) == 1 for f in mine) <= len(mine) // 2


def test_rolling_files_on_disk(spark, tmp_path):
    df = spark.range(200).select("id", F.when(F.col("id") % 50 != 0, F.timestamp_seconds(F.col("id") * 60)).cast("timestamp_ntz").alias("ts"))
    path = str(tmp_path / "rolled")
    writers.write_rolling(df, "ts", "id", path, 1_000, "30 minutes", "5 minutes", "HH")
    found = list(Path(path).rglob("part-*.json"))
    assert max(f.stat().st_size for f in found) <= 1_000 and len({f.parent for f in found}) == len(found)
    assert rows(spark.read.json(path).select("id")) == rows(df.select("id"))
    with pytest.raises(ValueError):
        writers.write_rolling(df, "ts", "id", str(tmp_path / "x"), 50, "30 minutes", "5 minutes")


def test_rolling_files_are_written_by_several_tasks_and_read_back(spark, tmp_path):
    """The files are tiny together, but there are many: adaptive execution must not give them to one task."""
    df = spark.range(400).select("id", F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"))
    path, schema = str(tmp_path / "rolled"), "id long, ts timestamp_ntz, bucket string"
    writers.write_rolling(df, "ts", "id", path, 1_000, "30 minutes", "5 minutes", "HH")
    found = list(Path(path).rglob("part-*.json"))
    assert len({f.name.split("-")[1] for f in found}) > 1 and not list(Path(path).rglob("*.json.crc"))
    back = writers.read_rolling(spark, path, schema)
    assert rows(back) == rows(df.withColumn("bucket", F.date_format("ts", "HH")))
    writers.write_rolling(df.limit(0), "ts", "id", str(tmp_path / "none"), 1_000, "30 minutes", "5 minutes", "HH")
    assert writers.read_rolling(spark, str(tmp_path / "none"), schema).count() == 0


def test_rolling_files_are_those_of_sparks_writer(spark, tmp_path, monkeypatch):
    """Same folders and bytes, same rows read back, with NULL times and folder names that are escaped."""
    texts = ["a\nb", 'q"uo\\te', "日本\r", "", None]
    df = spark.createDataFrame([(i, None if i % 17 == 0 else i * 61, texts[i % 5]) for i in range(400)], "id long, s long, text string")
    df = df.select("id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "text")
    folders, schema = {w: str(tmp_path / w) for w in ("python", "spark")}, "id long, ts timestamp_ntz, bucket string, text string"
    held, read = {}, {}
    for way in folders:
        if way == "spark":
            monkeypatch.setattr(files, "local", lambda *_: None)
        writers.write_rolling(df, "ts", "id", folders[way], 1_500, "30 minutes", "5 minutes", "HH:'%=/{[^'", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss")
        assert (Path(folders[way]) / "_SUCCESS").exists()
        held[way] = {str(f.parent.relative_to(folders[way])): f.read_bytes() for f in Path(folders[way]).rglob("part-*.json")}
    assert held["python"] == held["spark"] and len(held["python"]) > 20
    for folder in folders.values():
        some = next(Path(folder).rglob("part-*.json"))
        some.with_name(".left-over").write_bytes(some.read_bytes())  # by a task that was ended
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_rolling(df, "ts", "id", folders["spark"], 1_500, "30 minutes", "5 minutes")
    read["spark"] = writers.read_rolling(spark, folders["python"], schema)
    monkeypatch.undo()
    read["python"] = writers.read_rolling(spark, folders["spark"], schema)
    assert read["python"].schema == read["spark"].schema and rows(read["python"]) == rows(read["spark"])
    assert rows(read["python"].drop("bucket")) == rows(df)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_rolling(df, "ts", "id", folders["python"], 1_500, "30 minutes", "5 minutes")


def test_rolling_files_are_listed_and_read_by_few_tasks(spark, tmp_path):
    """Not by a task for each folder."""
    df = spark.range(8_000).select("id", F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"))
    path = str(tmp_path / "rolled")
    writers.write_rolling(df, "ts", "id", path, 1_000, "30 minutes", "5 minutes", "DD-HH")
    written = len(list(Path(path).rglob("part-*.json")))
    context = spark.sparkContext
    context.setJobGroup("rolling-read", "listing and reading")
    try:
        assert writers.read_rolling(spark, path, "id long, ts timestamp_ntz, bucket string").count() == 8_000
        jobs = context.statusTracker().getJobIdsForGroup("rolling-read")
        stages = {s for j in jobs for s in context.statusTracker().getJobInfo(j).stageIds}
        tasks = sum(info.numTasks for s in stages if (info := context.statusTracker().getStageInfo(s)))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < tasks < 120 < written


def test_rolling_parts_keep_rows_without_bucket_or_tie(spark):
    data = [(None if i % 5 == 0 else i, i, "ab"[i % 2] if i % 3 else None) for i in range(60)]
    df = spark.createDataFrame(data, "id long, s long, bucket string").select("id", F.timestamp_seconds("s").alias("ts"), "bucket")
    got = writers.rolling_parts(df, "ts", "id", "bucket", 400, "20 seconds", "10 seconds")
    assert Counter(map(tuple, got.drop("part").collect())) == Counter(map(tuple, df.collect())) and got.filter("part is null").isEmpty()


def test_tasks_of_the_last_versions_follow_the_rows(spark, tmp_path, monkeypatch):
    """More lines give more tasks, not larger ones, beyond Spark's number of shuffle partitions; a frequent key and odd values are whole."""
    monkeypatch.setattr(ordered, "TASK_ROWS", 250)
    data = [(None if i % 29 == 0 else i // 3 - 400, 7 if i % 3 else i % 41 or None, i % 4, None if i % 11 == 0 else float(i % 50), None if i % 13 == 0 else i % 3) for i in range(5_000)]
    li = spark.createDataFrame(data, "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, d int")
    whole = li.withColumn("l_shipdate", F.expr("timestamp_ntz'1995-01-30' + make_dt_interval(d)")).drop("d")
    known = whole.columns
    typed = [F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], SCHEMAS["lineitem"]).schema]
    whole.select(*typed).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = snk_latest_kv(spark, str(tmp_path))
    want = defaultdict(lambda: [0, None])
    for _, supplier, _, quantity, d in data:
        held = want[d, supplier]
        held[0] += 1
        held[1] = held[1] if quantity is None else (held[1] or 0) + int(quantity)

    def text(d, supplier, n, q):
        days = {0: "19950130", 1: "19950131", 2: "19950201"}
        pairs = {"site_id": supplier, "sub_orders": n, "quantity": q}
        return d if d is None else f"{days[d]}:SITES", supplier if supplier is None else str(supplier), json.dumps({k: v for k, v in pairs.items() if v is not None}, separators=(",", ":"))

    assert Counter(map(tuple, got.select("hash", "field", "value").collect())) == Counter(text(*k, *v) for k, v in want.items())
    assert got.rdd.getNumPartitions() == 20


def test_latest_position_is_kept_over_restarts(spark):
    df = spark.createDataFrame([(i,) for i in range(4)], "id long")
    replay = Replay([df.filter(f"id = {i}") for i in range(4)])
    mark, out, parts = scratch_dir(spark, "mark"), scratch_dir(spark, "latest"), iter(replay)
    next(parts)
    for i in range(3):
        live = readers.from_start(replay.stream(), "latest", replay.folder, mark, "id")
        run_to_files(live, out, mark)
        got = sorted(r.id for r in spark.read.schema("id long").parquet(out).collect())
        assert got == list(range(1, i + 1))
        time.sleep(0.05)
        next(parts)
    with pytest.raises(ValueError):
        readers.from_start(replay.stream(), "middle", replay.folder, mark, "id")


def test_metrics_of_micro_batches_add_up(spark, sf):
    e = events(spark, sf).select("event_id", "event_type", "value")
    replay = Replay([e.filter(f"event_id % 3 = {i}") for i in range(3)])
    watched = observed(replay.stream(), "seen", {"rows": F.lit(True), "errors": F.col("event_type") == "error"}, {"value": (F.col("value"), [10, 100])})
    with MetricsLog(spark, "seen", keep=4) as log:
        run_to_files(watched, scratch_dir(spark, "watched"), feed=replay)
        table = log.table()
    totals = {(r.metric, r.bucket): r.n for r in table.groupBy("metric", "bucket").agg(F.sum("n").alias("n")).collect()}
    bands = [e.filter("value < 10").count(), e.filter("value >= 10 and value < 100").count(), e.filter("value >= 100").count()]
    assert totals == {("rows", -1): e.count(), ("errors", -1): e.filter("event_type = 'error'").count(), **{("value", i): n for i, n in enumerate(bands)}}
    assert table.select("batch_id").distinct().count() == 3 and table.filter("batch_ms > 0").count() > 0


def test_state_of_idle_keys_expires(spark, sf):
    """The stream gives the batch counts, and its state holds exactly the keys that were not idle at the watermark."""
    e = events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")).select("user_id", "event_id", "ts")
    e = e.filter("not (user_id = 1 and ts >= timestamp'2024-01-10')")
    parts = [e.filter(F.floor((F.dayofmonth("ts") - 1) / 10) == i) for i in range(3)]
    replay, checkpoint = Replay(parts), scratch_dir(spark, "checkpoint")
    got = run_append(stateful.counts_with_idle_reset(replay.stream().withWatermark("ts", "1 hour"), "ts", "event_id", "2 days"), checkpoint=checkpoint, feed=replay)
    want = timers.counts_with_idle_reset(e, ["user_id"], "ts", "event_id", "2 days").select("user_id", "event_id", "n")
    assert rows(got.select("user_id", "event_id", "n")) == rows(want)
    last = {r.user_id: r.at for r in e.groupBy("user_id").agg(F.unix_millis(F.max("ts")).alias("at")).collect()}
    mark = max(last.values()) - 3_600_000
    left = {r.user_id for r in stateful.read_state(spark, checkpoint, "state").select("key.user_id").collect()}
    assert left == {u for u, at in last.items() if at + 2 * 86_400_000 >= mark} and 1 in last and 1 not in left


def test_sql_functions(spark):
    register(spark)
    register(spark)
    one = spark.sql("""select date_text(0) a, date_text(0, 'yyyyMMddHH') b, date_text(null) c, strict_upper('x') d, map_number(map('k', '2.5'), 'k') e, map_number(map('k', 'no'), 'k') f,
        map_field(map('k', 'v'), 'z') g, add_seconds(timestamp_ntz'2024-01-01 00:00:00') h, seconds_between(timestamp_ntz'2024-01-01 00:00:01.9', timestamp_ntz'2024-01-01 00:00:00') i,
        geo_distance(1, 2, 1, 2) j""").first()
    assert (one.a, one.b, one.c, one.d, one.e, one.f, one.g, one.i, one.j) == ("1970-01-01", "1970010100", "null", "X", 2.5, None, None, -1, 0.0) and one.h.second == 30
    assert rows(spark.sql("select d, name, num from values ('a#1'), ('b'), ('c#x') as v(d), lateral split_pair(d)").filter("num is not null")) == [("a#1", "a", 1)]
    assert rows(spark.sql("select name, num from values ('a.1') as v(d), lateral split_pair(d, '.')")) == [("a", 1)]
    with pytest.raises(Exception, match="blank"):
        spark.sql("select strict_upper(' ')").collect()


@pytest.fixture(scope="module")
def uneven(spark):
    data = [(None if i % 17 == 0 else "hot" if i % 3 else f"k{i % 7}", i * 31 % 100, i, i % 5 or None) for i in range(900)]
    return spark.createDataFrame(data, "k string, ts long, id long, v long").cache()


def test_hot_keys_are_found_by_count(spark, uneven):
    keyed = uneven.withColumn("key", F.struct("k"))
    assert hot_keys(keyed, "key") is None and hot_keys(keyed.limit(0), "key", 4) is None
    assert {r.key.k for r in hot_keys(keyed, "key", 10).collect()} == {"hot"}


@pytest.mark.parametrize("slices", [None, 3, 12, 60])
def test_scans_by_key_agree_with_the_layout(spark, uneven, slices):
    def steps(seq):
        return seq.scan(s=total("v"), c=running_count(), m=running_max("v"), b=max_before("v"), p=previous("v"), f=following("v"), w=latest("v"), n=next_known("v"))

    def filled(df):
        return rows(df.na.fill(-1).na.fill("none"), "k", "ts", "id", "v", *"scmbpfwn")

    want = filled(steps(Ordered(uneven, ["k"], ["ts", "id"], 7)).result())
    assert filled(steps(Grouped(uneven, ["k"], ["ts", "id"])).result()) == want
    assert filled(scanned_by_key(uneven, ["k"], ["ts", "id"], steps, slices)) == want
