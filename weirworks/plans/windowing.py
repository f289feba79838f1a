"""Queries of window assignment."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weirworks.functions.expr import interval_us, n_rows
from weirworks.operators import greedy, windows
from weirworks.plans.registry import query
from weirworks.sources.readers import declare_table
from weirworks.tables import events, load


@query("win_tumbling", """
select time_bucket(interval 10 minutes, ts) as window_start, time_bucket(interval 10 minutes, ts) + interval 10 minutes as window_end,
       event_type, count(*) as n, round(sum(value), 4) as total
from events group by 1, 2, 3
""")
def win_tumbling(spark, sf_dir):
    return windows.windowed(load(spark, sf_dir, "events"), "ts", "10 minutes", keys=["event_type"], n=n_rows(), total=F.round(F.sum("value"), 4))


@query("win_tumbling_sql", """
select event_type, sum((props::json->>'k')::int)::bigint as number, time_bucket(interval 5 seconds, ts) + interval 5 seconds as window_end
from events group by event_type, time_bucket(interval 5 seconds, ts)
""")
def win_tumbling_sql(spark, sf_dir):
    name = f"tumbling_input_{uuid.uuid4().hex}"  # concurrent queries don't share it
    declare_table(events(spark, sf_dir), name, "ts")
    return spark.sql(f"""
        select event_type, sum(item_id) as number, window(ts, '5 seconds').end as window_end
        from {name} group by event_type, window(ts, '5 seconds')""")


@query("win_tumbling_offset", """
select time_bucket(interval 1 day, ts, timestamp '2023-12-31 16:00:00') as window_start,
       time_bucket(interval 1 day, ts, timestamp '2023-12-31 16:00:00') + interval 1 day as window_end, user_id, count(*) as n
from events group by 1, 2, 3
""")
def win_tumbling_offset(spark, sf_dir):
    return windows.windowed(load(spark, sf_dir, "events"), "ts", "1 day", offset="-8 hours", keys=["user_id"], n=n_rows())


@query("win_sliding", """
select w as window_start, w + interval 60 minutes as window_end, event_type, count(*) as n, round(sum(value), 4) as total
from (select event_type, value, time_bucket(interval 5 minutes, ts) - to_minutes(5 * unnest(generate_series(0, 11))::int) as w from events)
group by 1, 2, 3
""")
def win_sliding(spark, sf_dir):
    return windows.windowed(load(spark, sf_dir, "events"), "ts", "60 minutes", "5 minutes", keys=["event_type"], n=n_rows(), total=F.round(F.sum("value"), 4))


@query("win_session", """
with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 12 hours then 0 else 1 end as opens from events),
s as (select *, sum(opens) over (partition by user_id order by ts, event_id) as sid from g)
select user_id, min(ts) as window_start, max(ts) + interval 12 hours as window_end, count(*) as n, round(sum(value), 4) as total
from s group by user_id, sid
""")
def win_session(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return (
        windows.assign_sessions(e, ["user_id"], "ts", "event_id", "12 hours")
        .groupBy("user_id", "session_start").agg(F.max("ts").alias("last"), n_rows().alias("n"), F.round(F.sum("value"), 4).alias("total"))
        .select("user_id", F.col("session_start").alias("window_start"),
                (F.col("last") + F.expr("interval 12 hours")).alias("window_end"), "n", "total")
    )


@query("win_session_bounded", """
with recursive r as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events),
w as (
  select user_id, rn, ts, value, ts as s, ts as last from r where rn = 1
  union all
  select r.user_id, r.rn, r.ts, r.value,
         case when r.ts <= w.last + interval 12 hours and r.ts + interval 12 hours - w.s < interval 36 hours then w.s else r.ts end, r.ts
  from w join r on r.user_id = w.user_id and r.rn = w.rn + 1)
select user_id, s as window_start, max(ts) + interval 12 hours as window_end, count(*) as n, round(max((value - 32) * 5.0 / 9.0), 4) as max_c
from w group by user_id, s
""")
def win_session_bounded(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    chained = greedy.bounded_sessions(e, ["user_id"], "ts", "event_id", gap="12 hours", bound="36 hours")
    return (
        chained.groupBy("user_id", F.col("anchor_ts").alias("window_start"), "anchor_id")
        .agg(F.max("ts").alias("last"), n_rows().alias("n"), F.round(F.max((F.col("value") - 32) * 5.0 / 9.0), 4).alias("max_c"))
        .withColumn("window_end", F.col("last") + F.expr("interval 12 hours")).drop("last", "anchor_id")
    )


@query("win_unaligned", """
with u as (select *, epoch_us(ts) as us, (user_id * 7919 % 3600) * 1000000 as off from events),
w as (select *, us - (((us - off) % 3600000000) + 3600000000) % 3600000000 as s from u)
select user_id, make_timestamp(s) as window_start, make_timestamp(s + 3600000000) as window_end, count(*) as n from w group by 1, 2, 3
""")
def win_unaligned(spark, sf_dir):
    phase = (F.col("user_id") * 7919 % 3600) * 1_000_000
    placed = windows.unaligned_windows(load(spark, sf_dir, "events"), "ts", interval_us("1 hour"), phase)
    return placed.groupBy("user_id", "window_start", "window_end").agg(n_rows().alias("n"))


@query("win_per_element", """
with w as (select *, (5000 + user_id) * 1000 as size, epoch_us(ts) - epoch_us(ts) % ((5000 + user_id) * 1000) as s from events)
select user_id, make_timestamp(s) as window_start, make_timestamp(s + size) as window_end, count(*) as n, max(value) as top from w group by 1, 2, 3
""")
def win_per_element(spark, sf_dir):
    size = (F.lit(5000) + F.col("user_id")) * 1000
    placed = windows.per_record_windows(load(spark, sf_dir, "events"), "ts", size)
    return placed.groupBy("user_id", "window_start", "window_end").agg(n_rows().alias("n"), F.max("value").alias("top"))


@query("win_multi_assign", """
with m as (select user_id, date_trunc('minute', ts) as m from events),
w as (select user_id, m - to_minutes(unnest(generate_series(1, 5))::int) as s, 5 as len from m union all select user_id, m, 1 from m)
select user_id, s as window_start, s + to_minutes(len) as window_end, count(*) as n from w group by 1, 2, 3
""")
def win_multi_assign(spark, sf_dir):
    placed = windows.shifted_windows(load(spark, sf_dir, "events").select("user_id", "ts"), "ts", "5 minutes", "1 minute")
    return placed.groupBy("user_id", "window_start", "window_end").agg(n_rows().alias("n"))


@query("win_multi_concurrent", """
with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 1 hour then 0 else 1 end as opens from events),
s as (select *, sum(opens) over (partition by user_id order by ts, event_id) as sid from g),
u as (select user_id, value, epoch_us(ts) as us from events)
select 'tumbling' as kind, user_id, make_timestamp(us - us % 3600000000) as window_start, make_timestamp(us - us % 3600000000 + 3600000000) as window_end,
       round(sum(value), 4) as total from u group by 2, 3, 4
union all
select 'sampled', user_id, make_timestamp(us - us % 18000000000), make_timestamp(us - us % 18000000000 + 3600000000), round(sum(value), 4)
from u where us % 18000000000 < 3600000000 group by 2, 3, 4
union all
select 'session', user_id, min(ts), max(ts) + interval 1 hour, round(sum(value), 4) from s group by user_id, sid
""")
def win_multi_concurrent(spark, sf_dir):
    sums = windows.concurrent_window_sums(
        load(spark, sf_dir, "events"), "ts", "value", ["user_id"], "1 hour", ("1 hour", "5 hours"), "1 hour", "event_id")
    return sums.withColumn("total", F.round("total", 4))


@query("win_count_purge", """
with r as (select *, (row_number() over (partition by user_id order by ts, event_id) - 1) // 2 as batch from events)
select user_id, batch::bigint as batch, count(*) as n, sum((props::json->>'k')::int)::bigint as total from r group by 1, 2 having count(*) = 2
""")
def win_count_purge(spark, sf_dir):
    e = events(spark, sf_dir).select("user_id", "ts", "event_id", "item_id")
    return windows.count_windows(e, ["user_id"], ["ts", "event_id"], 2, n=n_rows(), total=F.sum("item_id"))


@query("win_count_accumulate", """
select event_id, user_id, seen, total from (
  select event_id, user_id, row_number() over w as seen, (sum((props::json->>'k')::int) over w)::bigint as total
  from events window w as (partition by user_id order by ts, event_id rows unbounded preceding)) where seen % 2 = 0
""")
def win_count_accumulate(spark, sf_dir):
    e = events(spark, sf_dir).select("user_id", "ts", "event_id", "item_id")
    return windows.count_accumulate(e, ["user_id"], ["ts", "event_id"], 2, "item_id", "total").select("event_id", "user_id", "seen", "total")


@query("win_count_or_delay", """
with recursive r as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events),
w as (
  select user_id, rn, event_id, ts, ts as a, event_id as aid, 1 as c from r where rn = 1
  union all
  select r.user_id, r.rn, r.event_id, r.ts, case when w.c >= 5 or r.ts - w.a >= interval 1 day then r.ts else w.a end,
         case when w.c >= 5 or r.ts - w.a >= interval 1 day then r.event_id else w.aid end,
         case when w.c >= 5 or r.ts - w.a >= interval 1 day then 1 else w.c + 1 end
  from w join r on r.user_id = w.user_id and r.rn = w.rn + 1)
select user_id, a as chunk_start, count(*) as n, min(event_id) as first_id, max(event_id) as last_id from w group by user_id, a, aid
""")
def win_count_or_delay(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    chained = greedy.count_or_delay(e, ["user_id"], "ts", "event_id", max_count=5, delay="1 day")
    return chained.groupBy("user_id", F.col("anchor_ts").alias("chunk_start"), "anchor_id").agg(
        n_rows().alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")).drop("anchor_id")


@query("win_all", """
select time_bucket(interval 20 seconds, ts) as window_start, time_bucket(interval 20 seconds, ts) + interval 20 seconds as window_end,
       count(*) as n, round(sum(value), 4) as total from events group by 1, 2
""")
def win_all(spark, sf_dir):
    return windows.windowed(load(spark, sf_dir, "events"), "ts", "20 seconds", n=n_rows(), total=F.round(F.sum("value"), 4))
