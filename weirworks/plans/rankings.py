"""Queries of top-N and sorting."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirworks.operators import ranking, windows
from weirworks.operators.ordered import Ordered, running_count
from weirworks.plans.registry import query
from weirworks.streaming import stateful
from weirworks.streaming.runner import run_append
from weirworks.tables import event_replay, events, load, replayed_events


@query("topn_sliding_hot_items", """
with v as (select (props::json->>'k')::int as item_id, ts from events where event_type = 'view'),
w as (select item_id, time_bucket(interval 5 minutes, ts) - to_minutes(5 * unnest(generate_series(0, 11))::int) + interval 60 minutes as window_end from v),
c as (select window_end, item_id, count(*) as view_count from w group by 1, 2)
select window_end, item_id, view_count, (row_number() over (partition by window_end order by view_count desc, item_id))::int as rank
from c qualify rank <= 3
""")
def topn_sliding_hot_items(spark, sf_dir):
    return ranking.hot_items(events(spark, sf_dir, "view"), "ts", "item_id", "60 minutes", "5 minutes", 3)


@query("topn_sliding_hot_items_stream", """
with v as (select (props::json->>'k')::int as item_id, ts from events where event_type = 'view'),
w as (select item_id, time_bucket(interval 5 minutes, ts) - to_minutes(5 * unnest(generate_series(0, 11))::int) + interval 60 minutes as window_end from v),
c as (select window_end, item_id, count(*) as view_count from w group by 1, 2)
select window_end, item_id, view_count, (row_number() over (partition by window_end order by view_count desc, item_id))::int as rank
from c where epoch_us(window_end) <= (select epoch_us(max(ts)) // 1000 * 1000 - 600000000 from v) qualify rank <= 3
""")
def topn_sliding_hot_items_stream(spark, sf_dir):
    """The flagship on a stream of several micro-batches: each window once, when the watermark (10 minutes behind) closes it."""
    replay = event_replay(spark, sf_dir)
    views = replayed_events(replay, "10 minutes").filter("event_type = 'view'")
    top = run_append(stateful.hot_items(views, "ts", "item_id", "60 minutes", "5 minutes", 3), "hot-items", feed=replay)
    return top.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


@query("topn_window_by_area", """
with t as (select l_suppkey % 10 as area, l_partkey, time_bucket(interval 1 day, l_shipdate) as window_start, sum(l_quantity) as amount from lineitem group by 1, 2, 3)
select area, l_partkey, window_start, amount, (row_number() over (partition by window_start, area order by amount desc, l_partkey))::int as rank from t qualify rank <= 3
""")
def topn_window_by_area(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").withColumn("area", F.col("l_suppkey") % 10)
    sums = windows.windowed(li, "l_shipdate", "1 day", keys=["area", "l_partkey"], amount=F.sum("l_quantity")).drop("window_end")
    return ranking.top_n(sums, ["window_start", "area"], [F.col("amount").desc(), F.col("l_partkey")], 3)


@query("topn_running", """
with recursive r as (
  select l_suppkey as area, l_partkey as item, l_orderkey, l_linenumber,
         sum(l_quantity) over (partition by l_suppkey, l_partkey order by l_shipdate, l_orderkey, l_linenumber rows unbounded preceding) as t,
         row_number() over (partition by l_suppkey order by l_shipdate, l_orderkey, l_linenumber) as pos from lineitem),
w as (
  select area, pos, l_orderkey, l_linenumber, [{'n': -t, 'item': item}] as top from r where pos = 1
  union all
  select r.area, r.pos, r.l_orderkey, r.l_linenumber, list_sort(list_append(list_filter(w.top, lambda x: x.item <> r.item), {'n': -r.t, 'item': r.item}))[1:3]
  from w join r on r.area = w.area and r.pos = w.pos + 1)
select area, l_orderkey, l_linenumber, array_to_string(list_transform(top, lambda x: x.item || ':' || (-x.n)::bigint), ',') as top from w
""")
def topn_running(spark, sf_dir):
    """The three best-selling parts of a supplier after each order line."""
    li = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("area"), "l_partkey", "l_quantity", "l_shipdate", "l_orderkey", "l_linenumber")
    after = ranking.running_top_n(li, ["area"], ["l_shipdate", "l_orderkey", "l_linenumber"], "l_partkey", "l_quantity", 3)
    shown = F.transform("top", lambda e: F.concat_ws(":", e["item"].cast("string"), e["total"].cast("bigint").cast("string")))
    return after.select("area", "l_orderkey", "l_linenumber", F.array_join(shown, ",").alias("top"))


@query("topn_daily_rank", """
with s as (select date_trunc('second', l_shipdate) as sec, l_partkey, sum(l_quantity) as q from lineitem group by 1, 2),
d as (select date_trunc('day', sec) as day, l_partkey, sum(q) as quantity from s group by 1, 2)
select day, l_partkey, quantity, row_number() over (partition by day order by quantity desc, l_partkey) as rank from d
""")
def topn_daily_rank(spark, sf_dir):
    seconds = windows.windowed(load(spark, sf_dir, "lineitem"), "l_shipdate", "1 second", keys=["l_partkey"], q=F.sum("l_quantity"))
    days = windows.windowed(seconds, "window_start", "1 day", keys=["l_partkey"], quantity=F.sum("q"))
    ranked = Ordered(days.withColumn("less", -F.col("quantity")), ["window_start"], ["less", "l_partkey"]).scan(rank=running_count()).result()
    return ranked.select(F.col("window_start").alias("day"), "l_partkey", "quantity", "rank")


@query("sort_order_by", """
select o_orderstatus, o_orderpriority, o_custkey, o_orderkey from orders order by 1, 2, 3, 4
""")
def sort_order_by(spark, sf_dir):
    columns = ["o_orderstatus", "o_orderpriority", "o_custkey", "o_orderkey"]
    return load(spark, sf_dir, "orders").select(*columns).orderBy(*columns)


@query("sort_within_group", """
with d as (select user_id, ts, event_id, event_type, (row_number() over (partition by user_id order by ts, event_id) - 1) // 1000 as chunk_no from events)
select user_id, chunk_no::bigint as chunk_no, string_agg(event_id::varchar || ':' || event_type, ' ' order by ts, event_id) as path from d group by 1, 2
""")
def sort_within_group(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    step = F.concat_ws(":", F.col("event_id").cast("string"), "event_type")
    lists = ranking.sorted_groups(e, ["user_id"], ["ts", "event_id"], step, "steps")
    return lists.select("user_id", "chunk_no", F.concat_ws(" ", "steps").alias("path"))
