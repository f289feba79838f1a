"""Queries of early, repeated and late results."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirworks.functions.expr import n_rows
from weirworks.operators import triggers, windows
from weirworks.plans.registry import query
from weirworks.streaming import stateful
from weirworks.streaming.runner import run_append, run_to_changes
from weirworks.tables import dated, event_replay, events, load, replayed_events


@query("trig_continuous_event", """
with t as (select event_type, date_trunc('hour', ts) as tick, count(*) as n, sum((props::json->>'k')::int) as total from events group by 1, 2)
select event_type, date_trunc('day', tick) as window_start, tick + interval 1 hour as fired_at,
       (sum(n) over w)::bigint as n, (sum(total) over w)::bigint as total
from t window w as (partition by event_type, date_trunc('day', tick) order by tick rows unbounded preceding)
""")
def trig_continuous_event(spark, sf_dir):
    return triggers.continuous_results(events(spark, sf_dir), ["event_type"], "ts", "1 day", "1 hour", n=n_rows(), total=F.sum("item_id"))


@query("trig_continuous_proc", """
select user_id, date_trunc('day', ts - interval 16 hours) + interval 16 hours as window_start, count(*) as n, max(value) as top from events group by 1, 2
""")
def trig_continuous_proc(spark, sf_dir):
    replay = event_replay(spark, sf_dir)
    daily = windows.windowed(replayed_events(replay, "1 day"), "ts", "1 day", offset="16 hours", keys=["user_id"], n=n_rows(), top=F.max("value"))
    table = run_to_changes(daily.drop("window_end"), ["user_id", "window_start"], "continuous", feed=replay)
    return table.withColumn("window_start", dated("window_start").cast("timestamp_ntz"))


DISORDERED = "select event_id, user_id, ts as arrived, ts - to_minutes(10 * (event_id % 7)::int) as at_ts from events"


def disordered(spark, sf_dir):
    """Events that arrive up to an hour after they happened."""
    e = load(spark, sf_dir, "events")
    delay = F.make_dt_interval(mins=(F.col("event_id") % 7 * 10).cast("int"))
    return e.select("event_id", "user_id", F.col("ts").alias("arrived"), (F.col("ts") - delay).alias("at_ts"))


WATERMARKED = f"""
with d as ({DISORDERED}),
m as (select *, max(at_ts) over (order by arrived, event_id rows between unbounded preceding and 1 preceding) as high,
      date_trunc('hour', at_ts) as ws, date_trunc('hour', at_ts) + interval 1 hour as we from d)
"""


@query("trig_early_late", WATERMARKED + """
, w as (select *, coalesce(high - interval 15 minutes, timestamp '1970-01-01') as wm from m)
select event_id, user_id, arrived, at_ts, we as window_end,
       case when time_bucket(interval 10 minutes, wm) + interval 10 minutes < we then 'early' when wm < we then 'on_time'
            when wm < we + interval 20 minutes then 'late' else 'dropped' end as label
from w
""")
def trig_early_late(spark, sf_dir):
    return triggers.label_firings(disordered(spark, sf_dir), ["arrived", "event_id"], "at_ts", "1 hour", "15 minutes", "10 minutes", "20 minutes")


def panes_sql(batch: str) -> str:
    """All firings of hourly windows per user, 15 minutes of disorder, early every 10 minutes, 20 minutes of lateness. ``batch``: a row's micro-batch."""
    return f"""
with d as (select event_id, user_id, ts - to_minutes(10 * (event_id % 7)::int) as at_ts, (props::json->>'k')::int as k, {batch} as batch from events),
h as (select batch, epoch_us(max(at_ts)) as top from d group by 1),
g as (select batch, row_number() over (order by batch) as number, greatest((max(top) over (order by batch)) // 1000 * 1000 - 900000000, 0) as after from h),
m as (select *, coalesce(lag(after) over (order by number), 0) as before from g),
t as (select *, (before // 600000000 + 1) * 600000000 as tick, before > 0 and after // 600000000 > before // 600000000 as crossed from m),
r as (select d.*, m.number, m.before, epoch_us(at_ts) - epoch_us(at_ts) % 3600000000 as s from d join m using (batch)),
a as (select *, before >= s + 3600000000 as is_late from r where before < s + 4800000000),
o as (select user_id, s, min(number) as opened from a where not is_late group by 1, 2),
f as (
  select user_id, s, number, 1 as phase, tick as place, 'early' as kind, tick as fired from o join t on number >= opened and crossed and tick < s + 3600000000
  union all
  select user_id, s, min(number), 1, s + 3600000000, 'on_time', s + 3600000000 from o join t on after >= s + 3600000000 group by 1, 2
  union all
  select user_id, s, number, 0, event_id, 'late', before from a where is_late),
v as (
  select f.user_id, f.s, f.number, f.phase, f.place, f.kind, f.fired, count(*) as n, sum(k)::bigint as total
  from f join a on a.user_id = f.user_id and a.s = f.s and (a.number < f.number or (a.number = f.number and (not is_late or a.event_id <= f.place))) group by all)
select user_id, make_timestamp(s) as window_start, make_timestamp(fired) as fired_at, kind,
       row_number() over (partition by user_id, s order by number, phase, place) as pane, n, total from v
"""


PANES = {"size": "1 hour", "delay": "15 minutes", "early": "10 minutes", "lateness": "20 minutes"}


def disordered_values(df):
    delay = F.make_dt_interval(mins=(F.col("event_id") % 7 * 10).cast("int"))
    return df.withColumn("at_ts", F.col("ts") - delay)


@query("trig_early_late_panes", panes_sql("time_bucket(interval 6 hours, ts)"))
def trig_early_late_panes(spark, sf_dir):
    """What the windows fire while rows arrive in micro-batches of six hours."""
    e = disordered_values(events(spark, sf_dir)).withColumn("batch", F.window("ts", "6 hours").start)
    panes = triggers.fired_panes(e, ["user_id"], "batch", "at_ts", "event_id", "item_id", **PANES)
    return panes.withColumn("total", F.col("total").cast("bigint"))


@query("trig_early_late_panes_stream", panes_sql(
    "(epoch_us(ts) - min(epoch_us(ts)) over ()) // ((max(epoch_us(ts)) over () - min(epoch_us(ts)) over ()) // 4 + 1)"))
def trig_early_late_panes_stream(spark, sf_dir):
    """The same from state and timers, over four micro-batches."""
    replay = event_replay(spark, sf_dir)
    e = disordered_values(replayed_events(replay))
    panes = run_append(stateful.fired_panes(e, ["user_id"], "at_ts", "event_id", "item_id", **PANES), "panes", feed=replay)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "fired_at")}
    return panes.withColumns(times).withColumn("total", F.col("total").cast("bigint"))


@query("trig_per_element", WATERMARKED + """
, a as (select * from m where high is null or we - interval 1 millisecond + interval 5 minutes > high - interval 15 minutes)
select event_id, user_id, ws as window_start, count(*) over (partition by user_id, ws order by arrived, event_id) as n from a
""")
def trig_per_element(spark, sf_dir):
    accepted = triggers.accepted_rows(disordered(spark, sf_dir), ["arrived", "event_id"], "at_ts", "1 hour", "15 minutes", "5 minutes")
    return triggers.per_element_counts(accepted, ["user_id"], ["arrived", "event_id"]).select("event_id", "user_id", "window_start", "n")


@query("trig_every_n_or_end", """
with r as (select time_bucket(interval 6 hours, ts) as window_start, row_number() over w as seen, (sum((props::json->>'k')::int) over w)::bigint as total
  from events window w as (partition by time_bucket(interval 6 hours, ts) order by ts, event_id rows unbounded preceding))
select window_start, 'count' as fired_by, seen, total from r where seen % 11 = 0
union all
select time_bucket(interval 6 hours, ts), 'end', count(*), sum((props::json->>'k')::int)::bigint from events group by 1
""")
def trig_every_n_or_end(spark, sf_dir):
    e = events(spark, sf_dir).select(F.window("ts", "6 hours").start.alias("window_start"), "ts", "event_id", "item_id")
    return triggers.every_n_and_end(e, ["window_start"], ["ts", "event_id"], 11, "item_id")


@query("trig_session_first", """
select event_id, user_id, ts from (
  select *, lag(ts) over (partition by user_id order by ts, event_id) as before from events)
where before is null or ts - before > interval 2 hours
""")
def trig_session_first(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return triggers.session_firsts(e, ["user_id"], "ts", "event_id", "2 hours")
