"""Queries of deduplication, timers and state."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirworks.functions.expr import n_rows
from weirworks.operators import analytic, dedup, timers
from weirworks.plans.registry import query
from weirworks.plans.sources import event_folder
from weirworks.session import scratch_dir
from weirworks.streaming import stateful
from weirworks.streaming.runner import run_append, run_to_changes
from weirworks.tables import dated, event_replay, events, load, replayed_events, stream_events


@query("dedup_ttl", """
with recursive r as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events),
w as (
  select user_id, rn, event_id, ts, ts as kept from r where rn = 1
  union all
  select r.user_id, r.rn, r.event_id, r.ts, case when r.ts - w.kept >= interval 24 hours then r.ts else w.kept end
  from w join r on r.user_id = w.user_id and r.rn = w.rn + 1)
select user_id, event_id, ts from w where ts = kept
""")
def dedup_ttl(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return dedup.drop_repeats(e, ["user_id"], "ts", "event_id", "24 hours")


@query("dedup_distinct_per_hour", """
with a as (select *, max(ts) over (order by event_id rows between unbounded preceding and 1 preceding) - interval 10 day as mark, date_trunc('hour', ts) as w from events)
select event_type, w as window_start, w + interval 1 hour as window_end, count(distinct user_id) as devices
from a where mark is null or w + interval 1 hour - interval 1 millisecond > mark group by 1, 2, 3
""")
def dedup_distinct_per_hour(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "ts")
    return dedup.distinct_per_window(e, ["event_type"], "user_id", "ts", "1 hour", "devices", arrival=["event_id"], delay="10 days")


@query("state_offline_alert", """
with n as (select *, lead(ts) over (partition by user_id order by ts, event_id) as nxt, max(ts) over () as top from events),
u as (select user_id, event_id, ts, case when nxt is null then top + interval 1 microsecond else nxt end as until from n where event_type = 'error')
select user_id, event_id, unnest(generate_series(ts + interval 6 hours, until - interval 1 microsecond, interval 6 hours)) as alert_at from u
""")
def state_offline_alert(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return timers.repeated_alerts(e, ["user_id"], "ts", "event_id", F.col("event_type") == "error", "6 hours")


@query("state_count_timeout", """
select user_id, event_id, ts, n, ts + interval 12 hours as emitted_at from (
  select *, row_number() over w as n, lead(ts) over w as nxt from events window w as (partition by user_id order by ts, event_id))
where nxt is null or nxt - ts > interval 12 hours
""")
def state_count_timeout(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return timers.counts_after_silence(e, ["user_id"], "ts", "event_id", "12 hours")


@query("state_regular_emit", """
with t as (select user_id, date_trunc('hour', ts) as tick, count(*) as n, sum(value) as s from events group by 1, 2)
select user_id, date_trunc('day', tick) as day, tick + interval 1 hour as emitted_at, round(sum(s) over w / sum(n) over w, 4) as mean
from t window w as (partition by user_id, date_trunc('day', tick) order by tick rows unbounded preceding)
""")
def state_regular_emit(spark, sf_dir):
    ticks = timers.daily_average_ticks(load(spark, sf_dir, "events"), ["user_id"], "ts", "value", "1 hour")
    return ticks.withColumn("mean", F.round("mean", 4))


@query("state_emit_on_change", """
select user_id, event_id, event_type from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as p from events) where event_type is distinct from p
""")
def state_emit_on_change(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return analytic.changed_rows(e, ["user_id"], ["ts", "event_id"], "event_type").drop("ts")


@query("state_idle_retention", """
with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 12 hours then 0 else 1 end as opens from events),
s as (select *, sum(opens) over (partition by user_id order by ts, event_id) as sid from g)
select user_id, event_id, row_number() over (partition by user_id, sid order by ts, event_id) as n from s
""")
def state_idle_retention(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return timers.counts_with_idle_reset(e, ["user_id"], "ts", "event_id", "12 hours").select("user_id", "event_id", "n")


@query("state_idle_retention_stream", """
with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 12 hours then 0 else 1 end as opens from events where ts is not null),
s as (select *, sum(opens) over (partition by user_id order by ts, event_id) as sid from g)
select user_id, event_id, row_number() over (partition by user_id, sid order by ts, event_id) as n from s
""")
def state_idle_retention_stream(spark, sf_dir):
    """The same on a stream whose timers drop the state of idle users; rows without a time can't be idle and are left out."""
    replay = event_replay(spark, sf_dir)
    timed = replayed_events(replay, "1 hour").filter(dated("ts").isNotNull())
    return run_append(stateful.counts_with_idle_reset(timed, "ts", "event_id", "12 hours"), "idle", feed=replay)


@query("state_latest_view", """
select date_trunc('hour', ts) as window_start, date_trunc('hour', ts) + interval 1 hour as window_end,
       max(value) filter (event_type = 'click') as click, max(value) filter (event_type = 'view') as view, max(value) filter (event_type = 'purchase') as purchase,
       max(value) filter (event_type = 'signup') as signup, max(value) filter (event_type = 'error') as error
from events group by 1, 2
""")
def state_latest_view(spark, sf_dir):
    return timers.latest_view(events(spark, sf_dir), "ts", "1 hour", "event_type", ["click", "view", "purchase", "signup", "error"], F.max("value"))


@query("state_read", "select user_id, count(*) as n, max(value) as top from events group by 1")
def state_read(spark, sf_dir):
    checkpoint = scratch_dir(spark, "checkpoint")
    replay = event_replay(spark, sf_dir)
    per_user = replayed_events(replay).groupBy("user_id").agg(n_rows().alias("n"), F.max("value").alias("top"))
    run_to_changes(per_user, ["user_id"], "state-read", checkpoint, feed=replay)
    state = stateful.read_state(spark, checkpoint)
    return state.select("key.user_id", F.col("value.count").alias("n"), F.col("value.max").alias("top"))


SPLIT_AT = "2024-01-16 00:00:00"


def is_fresh(kind: str):
    """At or after the boundary; rows without a time are history."""
    return F.coalesce(F.col("ts") >= F.lit(SPLIT_AT).cast(kind), F.lit(False))


def account_rows(df):
    return df.select(F.col("user_id").alias("account"), F.col("item_id").cast("bigint").alias("amount"))


@query("state_bootstrap", """
select user_id as account, count(*) as n, sum((props::json->>'k')::int)::bigint as total from events group by 1
""")
def state_bootstrap(spark, sf_dir):
    history = account_rows(events(spark, sf_dir).filter(~is_fresh("timestamp_ntz")))
    seed = history.groupBy("account").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    fresh = account_rows(stream_events(spark, event_folder(sf_dir)).filter(is_fresh("timestamp")))
    added = run_to_changes(stateful.account_totals(fresh, seed), ["account"], "bootstrap")
    # accounts without a new row still hold their seeded state
    return added.unionByName(seed.join(added, "account", "left_anti"))


@query("state_evolve", """
with o as (select user_id, sum((props::json->>'k')::int) as old from events where ts is null or ts < timestamp '2024-01-16 00:00:00' group by 1),
f as (select user_id, count(*) as m, sum((props::json->>'k')::int) as new from events where ts >= timestamp '2024-01-16 00:00:00' group by 1)
select user_id as account, coalesce(m, 0)::bigint as n, (coalesce(old * 12 // 10, 0) + coalesce(new, 0))::bigint as total from o full join f using (user_id)
""")
def state_evolve(spark, sf_dir):
    checkpoint = scratch_dir(spark, "checkpoint")
    old = account_rows(stream_events(spark, event_folder(sf_dir)).filter(~is_fresh("timestamp"))).groupBy("account").agg(F.sum("amount").alias("total"))
    run_to_changes(old, ["account"], "evolve-old", checkpoint)
    state = stateful.read_state(spark, checkpoint)
    raised = state.select("key.account", F.lit(0).cast("bigint").alias("n"), F.floor(F.col("value.sum") * 12 / 10).cast("bigint").alias("total"))
    fresh = account_rows(stream_events(spark, event_folder(sf_dir)).filter(is_fresh("timestamp")))
    added = run_to_changes(stateful.account_totals(fresh, raised), ["account"], "evolve-new")
    return added.unionByName(raised.join(added, "account", "left_anti"))
