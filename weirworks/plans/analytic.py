"""Queries of analytic functions."""

from __future__ import annotations

from weirworks.operators import analytic
from weirworks.plans.registry import query
from weirworks.tables import load


@query("win_row_number", """
select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from orders
""")
def win_row_number(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return analytic.row_numbers(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("win_range_count", """
select event_id, user_id, count(*) over (partition by user_id order by ts range between interval 6 hours preceding and current row) as n from events
""")
def win_range_count(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return analytic.range_count(e, ["user_id"], "ts", "6 hours").drop("ts")


@query("win_flag_expand_sum", """
with m as (select user_id, event_id, ts - interval 1 second as at_ts, 0 as flag from events
  union all select user_id, event_id, ts + interval 1 second, 1 from events union all select user_id, event_id, ts + interval 7201 seconds, 0 from events)
select user_id, event_id, flag::bigint as flag, at_ts, (sum(flag) over (partition by user_id order by at_ts range between interval 2 hours preceding and current row))::bigint as n from m
""")
def win_flag_expand_sum(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return analytic.decaying_count(e, ["user_id"], "ts", 1, "2 hours")


@query("win_trailing_count_expiry", """
with m as (select user_id, event_id, ts as at_ts, 1 as step, 'arrive' as kind from events
  union all select user_id, event_id, ts + interval 12 hours, -1, 'expire' from events)
select user_id, event_id, at_ts, kind, (sum(step) over (partition by user_id order by at_ts, step, event_id))::bigint as live from m
""")
def win_trailing_count_expiry(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return analytic.live_count_changes(e, ["user_id"], "ts", "event_id", "12 hours")


@query("win_delta_alert", """
select event_id, user_id, value, p as previous_value from (
  select *, lag(value) over w as p, lag(ts) over w as pt from events window w as (partition by user_id order by ts, event_id))
where ts - pt <= interval 1 hour and abs(value - p) > 1.5
""")
def win_delta_alert(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return analytic.jump_alerts(e, ["user_id"], "ts", "event_id", "value", 1.5, "1 hour").drop("ts")
