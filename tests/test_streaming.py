"""Streaming runs over several micro-batches against the batch result on what is closed."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from frames import rows
from weirworks.functions.expr import interval_us, micros, n_rows
from weirworks.operators import analytic, dedup, greedy, joins, ranking, rows as R, timers, windows
from weirworks.operators.ordered import Ordered, previous
from weirworks.sources import readers, writers
from weirworks.streaming import stateful
from weirworks.streaming.runner import run_append, run_to_changes, run_to_files
from weirworks.tables import events, stream_events


@pytest.fixture(scope="module")
def batch(spark, sf):
    return events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")).cache()


@pytest.fixture(scope="module")
def end_us(batch):
    return batch.agg(F.max(micros("ts"))).collect()[0][0]


def check_append(stream, full, closed=None, minimum=1):
    """Every streamed row is a batch row, none twice; all ``closed`` batch rows were streamed."""
    got, want = Counter(rows(stream)), Counter(rows(full.select(*stream.columns)))
    assert sum(got.values()) >= minimum
    assert not got - want
    if closed is not None:
        missing = Counter(rows(closed.select(*stream.columns))) - got
        assert not missing, missing


def test_windows(spark, event_files, batch, end_us):
    for size, slide, offset in (("1 hour", None, None), ("1 day", None, "-8 hours"), ("60 minutes", "30 minutes", None)):
        def op(df):
            return windows.windowed(df, "ts", size, slide, offset, ["event_type"], n=n_rows(), top=F.max("value"))
        full = op(batch)
        closed = full.filter(micros("window_end") <= end_us - interval_us("10 minutes") - 10**6)
        check_append(run_append(op(stream_events(spark, event_files, "10 minutes"))), full, closed)


def test_window_all_and_sql(spark, event_files, batch, end_us):
    readers.declare_table(stream_events(spark, event_files), "live_events", "ts", "2 seconds")
    live = spark.sql("select window(ts, '5 minutes').end as window_end, sum(item_id) as number from live_events group by window(ts, '5 minutes')")
    full = batch.groupBy(F.window("ts", "5 minutes")).agg(F.sum("item_id").alias("number")).select(F.col("window.end").alias("window_end"), "number")
    check_append(run_append(live), full, full.filter(micros("window_end") <= end_us - 3 * 10**6))


@pytest.mark.parametrize("per_type", [False, True])
def test_sessions(spark, event_files, batch, end_us, per_type):
    gap = F.when(F.col("event_type") == "view", "2 hours").otherwise("12 hours") if per_type else "12 hours"

    def op(df):
        return windows.session_windows(df, "ts", gap, ["user_id"], n=n_rows())
    full = op(batch)
    check_append(run_append(op(stream_events(spark, event_files, "1 minute"))), full, full.filter(micros("window_end") <= end_us - 61 * 10**6))


def test_sessions_equal_sliced_sessions(batch):
    built_in = windows.session_windows(batch, "ts", "12 hours", ["user_id"], n=n_rows()).select("user_id", "window_start", "n")
    sliced = windows.assign_sessions(batch, ["user_id"], "ts", "event_id", "12 hours", 10).groupBy("user_id", "session_start").agg(n_rows().alias("n"))
    assert rows(sliced) == rows(built_in)


def sides(df):
    a = df.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    b = df.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    return a, b


def stream_sides(spark, folder):
    a, b = sides(stream_events(spark, folder))
    return a.withWatermark("click_ts", "1 hour"), b.withWatermark("purchase_ts", "1 hour")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_window_join(spark, event_files, batch, how):
    def op(a, b):
        j = joins.window_join(a, b, ["user_id"], "click_ts", "purchase_ts", "1 day", "30 seconds", how)
        return j.select("user_id", F.col("w.start").alias("w"), "click_id", "purchase_id")
    full = op(*sides(batch))
    inner = op(*sides(batch)).filter("purchase_id is not null")
    check_append(run_append(op(*stream_sides(spark, event_files))), full, inner)


@pytest.mark.parametrize("inclusive", [True, False])
def test_interval_join(spark, event_files, batch, inclusive):
    def op(a, b, how):
        return joins.interval_join(a, b, ["user_id"], "click_ts", "purchase_ts", "-2 hours", "2 hours", inclusive, how)
    full = op(*sides(batch), "inner")
    check_append(run_append(op(*stream_sides(spark, event_files), "inner")), full, full)


def test_chained_aggregates(spark, event_files, batch):
    def op(df):
        hourly = df.groupBy(F.window("ts", "1 hour").alias("w"), "user_id").agg(n_rows().alias("n"))
        return hourly.groupBy(F.window(F.window_time("w"), "1 day").alias("d")).agg(F.max("n").alias("top")).select(F.col("d.start").alias("day"), "top")
    check_append(run_append(op(stream_events(spark, event_files, "1 minute"))), op(batch), minimum=20)


def test_update_mode_upsert(spark, event_files, batch):
    def op(df):
        return df.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day_text"), "event_type").agg(n_rows().alias("pv"))
    assert rows(run_to_changes(op(stream_events(spark, event_files)), ["day_text", "event_type"])) == rows(op(batch))


def test_dedup_keeps_the_same_rows_as_in_batch(spark, event_files, batch):
    got = run_append(dedup.drop_repeats(stream_events(spark, event_files), ["user_id", "event_type"], "ts", "event_id", "2 hours"))
    want = dedup.drop_repeats(batch, ["user_id", "event_type"], "ts", "event_id", "2 hours")
    assert got.columns == batch.columns and rows(got, "event_id", "value") == rows(want, "event_id", "value")


def test_distinct_per_hour(spark, event_files, batch, end_us):
    def op(df):
        return dedup.distinct_per_window(df, ["event_type"], "user_id", "ts", "1 hour", "devices")
    full = op(batch)
    got = run_append(op(stream_events(spark, event_files, "10 minutes")))
    check_append(got, full, full.filter(micros("window_end") <= end_us - interval_us("10 minutes") - 10**6))


def test_union(spark, event_files, batch):
    def op(df):
        return df.filter("event_type = 'view'").select("event_id", "ts").unionByName(df.filter("event_type = 'click'").select("event_id", "ts"))
    check_append(run_append(op(stream_events(spark, event_files))), op(batch), op(batch))


def test_json_and_lines(spark, batch, tmp_path):
    texts = batch.select(F.to_json(F.struct("event_id", "user_id", "value")).alias("value"))
    texts.repartition(3).write.text(str(tmp_path / "topic"))
    typed = readers.stream_json_files(spark, str(tmp_path / "topic"), "event_id BIGINT, user_id BIGINT, value DOUBLE, absent STRING")
    assert rows(run_append(typed), "event_id", "value") == rows(batch, "event_id", "value")
    words = R.tokens(readers.stream_lines(spark, str(tmp_path / "topic")), "value", "\\W+").groupBy("word").agg(n_rows().alias("n"))
    assert rows(run_to_changes(words, ["word"])) == rows(R.tokens(texts, "value", "\\W+").groupBy("word").agg(n_rows().alias("n")))


def test_time_bucket_files(spark, event_files, batch, tmp_path):
    out = stream_events(spark, event_files).select("event_id", "ts")
    writers.stream_time_buckets(out, "ts", str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    back = spark.read.schema("event_id BIGINT, ts TIMESTAMP, bucket STRING").parquet(str(tmp_path / "out"))
    assert rows(back) == rows(batch.select("event_id", "ts", F.date_format("ts", writers.HOUR_BUCKET).alias("bucket")))


def test_restart_continues_from_checkpoint(spark, batch, tmp_path):
    e = batch.select("event_id", "ts").orderBy("ts")
    cut = e.agg(F.expr("percentile_approx(event_id, 0.5)")).collect()[0][0]
    def run():
        src = spark.readStream.schema("event_id BIGINT, ts TIMESTAMP").parquet(str(tmp_path / "in"))
        run_to_files(src, str(tmp_path / "out"), str(tmp_path / "cp"))
        return spark.read.parquet(str(tmp_path / "out")).count()
    e.filter(F.col("event_id") <= cut).write.mode("append").parquet(str(tmp_path / "in"))
    first = run()
    e.filter(F.col("event_id") > cut).write.mode("append").parquet(str(tmp_path / "in"))
    assert first == e.filter(F.col("event_id") <= cut).count() and run() == e.count()


def test_repeated_batch_is_stored_once(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k STRING, n INT")
    write = writers.append_changes(str(tmp_path / "t"))
    write(df, 0)
    write(df, 0)
    write(spark.createDataFrame([("a", 3)], df.schema), 1)
    assert rows(writers.current_rows(spark, str(tmp_path / "t"), df.schema, ["k"])) == [("a", 3)]


# --- stateful processors ---


def test_pair_matches(spark, event_files, batch):
    pair = joins.in_force("ts", [("2024-01-01 00:00:00", "view,purchase"), ("2024-01-15 00:00:00", "click,error")])
    got = run_append(stateful.pair_matches(stream_events(spark, event_files), "ts", "event_id", "event_type", pair))
    seen = Ordered(batch, ["user_id"], ["ts", "event_id"]).scan(before=previous("event_type")).result()
    want = seen.filter(F.concat_ws(",", "before", "event_type") == pair).filter("before is not null").select("user_id", "event_id", "before", "event_type")
    assert rows(got) == rows(want)


def test_long_paths(spark, event_files, batch):
    limit = joins.in_force("ts", [("2024-01-12 00:00:00", 4)], 1)
    got = run_append(stateful.long_paths(stream_events(spark, event_files), "ts", "event_id", "event_type", "purchase", limit))
    paths = joins.paths_to_event(batch, ["user_id"], ["ts", "event_id"], "event_type", "purchase", [])
    want = paths.filter(F.col("path_length") > joins.in_force("end_ts", [("2024-01-12 00:00:00", 4)], 1))
    assert rows(got) == rows(want.select("user_id", micros("end_ts"), "path_length"))


def test_offline_alerts(spark, event_files, batch, end_us):
    offline = F.col("event_type") == "error"
    got = run_append(stateful.offline_alerts(stream_events(spark, event_files, "1 minute"), "ts", "event_id", offline, "6 hours"))
    full = timers.repeated_alerts(batch, ["user_id"], "ts", "event_id", offline, "6 hours").select("user_id", micros(F.col("alert_at").cast("timestamp")).alias("alert_us"))
    check_append(got, full, full.filter(F.col("alert_us") < end_us - interval_us("6 hours")))


def test_match_or_timeout(spark, event_files, batch, end_us):
    wait = interval_us("1 day")

    def union(df):  # keys repeat: several rows of a user wait at once
        first = df.filter("event_type = 'signup'").select(F.col("user_id").alias("order_key"), "ts", micros("ts").alias("us"), F.lit(0).alias("kind"))
        back = df.filter("event_type = 'purchase'").select(F.col("user_id").alias("order_key"), "ts", micros("ts").alias("us"), F.lit(1).alias("kind"))
        return first.unionByName(back).withColumn("wait_us", F.lit(wait))
    got = run_append(stateful.match_or_timeout(union(stream_events(spark, event_files, "1 minute"))))
    u = union(batch)
    a = u.filter("kind = 0").select("order_key", F.col("ts").cast("timestamp_ntz").alias("ts"))
    b = u.filter("kind = 1").select("order_key", F.col("ts").cast("timestamp_ntz").alias("rts"))
    full = joins.match_or_timeout(a, b, ["order_key"], "ts", "rts", F.lit(1)).select("order_key", "status", micros("event_at").alias("event_us"))
    check_append(got, full, full.filter(F.col("event_us") < end_us - interval_us("2 minutes")))


def test_bounded_sessions(spark, event_files, batch, end_us):
    got = run_append(stateful.bounded_sessions(stream_events(spark, event_files, "1 minute"), "ts", "event_id", "value", "12 hours", "36 hours"))
    full = (
        greedy.bounded_sessions(batch, ["user_id"], "ts", "event_id", "12 hours", "36 hours").groupBy("user_id", "anchor_ts")
        .agg((F.max(micros("ts")) + interval_us("12 hours")).alias("end_us"), n_rows().alias("n"), F.max("value").alias("top"))
        .withColumn("start_us", micros("anchor_ts"))
    )
    check_append(got, full, full.filter(F.col("end_us") < end_us - interval_us("2 minutes")))


def test_running_top(spark, event_files, batch):
    def op(df):
        return df.select((F.col("user_id") % 5).alias("area"), F.col("item_id").cast("bigint").alias("item"), F.lit(1.0).alias("amount"))
    got = run_to_changes(stateful.running_top(op(stream_events(spark, event_files)), 3), ["area", "rank"])
    want = ranking.total_top_n(op(batch), "area", "item", "amount", 3)
    assert rows(got, "area", "rank", "item", "total") == rows(want, "area", "rank", "item", "total")


@pytest.mark.parametrize("wait", [True, False])
def test_conversion(spark, event_files, batch, wait):
    def op(df):
        return df.filter("event_type in ('signup', 'purchase')")
    kind = F.when(F.col("event_type") == "signup", 0).otherwise(1)
    got = run_append(stateful.converted(op(stream_events(spark, event_files)), "ts", "event_id", kind, "value", wait))
    left = batch.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("payment_id"), "ts", F.col("value").alias("amount"))
    right = batch.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("rid"), F.col("ts").alias("rts"), F.col("value").alias("rate"))
    join = joins.buffered_asof_join if wait else joins.asof_join
    want = join(left, right, ["user_id"], "ts", "payment_id", "rts", "rid", ["rate"])
    assert rows(got, "payment_id", "amount", "rate") == rows(want, "payment_id", "amount", "rate")


def test_live_counts(spark, event_files, batch, end_us):
    got = run_append(stateful.live_counts(stream_events(spark, event_files, "1 minute"), "ts", "event_id", "12 hours"))
    full = analytic.live_count_changes(batch, ["user_id"], "ts", "event_id", "12 hours").select("user_id", micros(F.col("at_ts").cast("timestamp")).alias("at_us"), "kind", "live")
    check_append(got, full, full.filter(F.col("at_us") < end_us - interval_us("2 minutes")))


def test_counts_after_silence(spark, event_files, batch, end_us):
    got = run_append(stateful.counts_after_silence(stream_events(spark, event_files, "1 minute"), "ts", "event_id", "12 hours"))
    full = timers.counts_after_silence(batch, ["user_id"], "ts", "event_id", "12 hours").select("user_id", "n", micros(F.col("emitted_at").cast("timestamp")).alias("emitted_us"))
    check_append(got, full, full.filter(F.col("emitted_us") < end_us - interval_us("2 minutes")))


def test_count_or_delay(spark, event_files, batch, end_us):
    got = run_append(stateful.count_or_delay(stream_events(spark, event_files, "1 minute"), "ts", "event_id", 3, "1 day"))
    full = (
        greedy.count_or_delay(batch, ["user_id"], "ts", "event_id", 3, "1 day").groupBy("user_id", micros("anchor_ts").alias("first_us"))
        .agg(n_rows().alias("n"), F.min_by("event_id", "ts").alias("first_id"), F.max_by("event_id", "ts").alias("last_id"))
    )
    check_append(got, full, full.filter(F.col("first_us") < end_us - interval_us("1 day") - interval_us("2 minutes")))


def test_first_per_ttl(spark, event_files, batch):
    got = run_append(stateful.first_per_ttl(stream_events(spark, event_files, "1 minute"), ["user_id"], "ts", "event_id", "24 hours"))
    want = greedy.first_per_ttl(batch, ["user_id"], "ts", "event_id", "24 hours")
    assert rows(got, "event_id") == rows(want, "event_id")


def test_changes(spark, event_files, batch):
    got = run_append(stateful.changes(stream_events(spark, event_files), "ts", "event_id", "event_type"))
    assert rows(got, "event_id") == rows(analytic.changed_rows(batch, ["user_id"], ["ts", "event_id"], "event_type"), "event_id")


def test_jump_alerts(spark, event_files, batch):
    got = run_append(stateful.jump_alerts(stream_events(spark, event_files), "ts", "event_id", "value", 1.5, "6 hours"))
    want = analytic.jump_alerts(batch, ["user_id"], "ts", "event_id", "value", 1.5, "6 hours")
    assert rows(got, "event_id", "previous_value") == rows(want, "event_id", "previous_value")


def test_state_read_and_seed(spark, event_files, batch, tmp_path):
    def op(df):
        return df.select(F.col("user_id").alias("account"), F.col("item_id").cast("bigint").alias("amount"))
    seed = spark.createDataFrame([(1, 2, 2000), (10**6, 3, 300)], "account BIGINT, n BIGINT, total BIGINT")
    checkpoint = str(tmp_path / "cp")
    got = run_to_changes(stateful.account_totals(op(stream_events(spark, event_files)), seed), ["account"], checkpoint=checkpoint)
    want = {r.account: (r.n, r.total) for r in op(batch).groupBy("account").agg(n_rows().alias("n"), F.sum("amount").alias("total")).collect()}
    n, total = want.get(1, (0, 0))
    want[1] = (n + 2, total + 2000)
    have = {r.account: (r.n, r.total) for r in got.collect()}
    assert {k: v for k, v in want.items() if k in have} == have and len(have) >= len(want) - 1
    state = stateful.read_state(spark, checkpoint, "state").select("key.account", "value.n", "value.total").collect()
    assert {r.account: (r.n, r.total) for r in state} == {**want, 10**6: (3, 300)}
    assert stateful.list_state_operators(spark, checkpoint).count() == 1


def test_observed_metrics(spark, batch):
    from pyspark.sql import Observation

    seen = Observation("job")
    batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("event_type") == "error").alias("bad")).write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == batch.count() and seen.get["bad"] == batch.filter("event_type = 'error'").count()
