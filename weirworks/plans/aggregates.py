"""Queries of aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirworks.functions.expr import n_rows
from weirworks.operators import aggs, rows, windows
from weirworks.plans.registry import query
from weirworks.session import scratch_dir
from weirworks.streaming.metrics import MetricsLog, observed
from weirworks.streaming.runner import run_to_files
from weirworks.tables import event_replay, events, load, replayed_events


@query("agg_running_sum", """
select event_id, event_type, (sum((props::json->>'k')::int) over (partition by event_type order by ts, event_id))::bigint as total from events
""")
def agg_running_sum(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "event_type", "ts", "item_id")
    return aggs.running_totals(e, ["event_type"], ["ts", "event_id"], total="item_id").select("event_id", "event_type", "total")


@query("agg_running_reduce", """
select l_partkey, l_shipdate, l_suppkey, l_orderkey, l_linenumber, l_quantity, sum(l_quantity) over w as amount
from (select *, row_number() over (partition by l_partkey, l_shipdate, l_orderkey, l_linenumber order by l_suppkey, l_quantity, l_extendedprice) as d from lineitem)
window w as (partition by l_partkey order by l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice rows unbounded preceding)
""")
def agg_running_reduce(spark, sf_dir):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
    li = load(spark, sf_dir, "lineitem").select("l_partkey", *order)
    running = aggs.running_totals(li, ["l_partkey"], order, amount="l_quantity")
    return running.select("l_partkey", "l_shipdate", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "amount")


@query("agg_fold_map_total", """
with t as (select event_type, sum((props::json->>'k')::int)::bigint as total from events group by 1)
select event_type, total, (select sum(total) from t)::bigint as grand_total from t
""")
def agg_fold_map_total(spark, sf_dir):
    per_type = events(spark, sf_dir).groupBy("event_type").agg(F.sum("item_id").alias("total"))
    # one map entry per event type, a fixed small vocabulary
    folded = per_type.agg(F.map_from_entries(F.collect_list(F.struct("event_type", "total"))).alias("totals"), F.sum("total").alias("grand_total"))
    return folded.select(F.explode("totals").alias("event_type", "total"), "grand_total")


@query("agg_group_count", """
select substring(c_name, 1, 1) as initial, c_mktsegment, count(*) as n from customer group by 1, 2
""")
def agg_group_count(spark, sf_dir):
    return load(spark, sf_dir, "customer").groupBy(F.substring("c_name", 1, 1).alias("initial"), "c_mktsegment").agg(n_rows().alias("n"))


@query("agg_cube_grouping", """
select o_orderstatus, o_orderpriority, grouping(o_orderstatus)::int as g_o_orderstatus, grouping(o_orderpriority)::int as g_o_orderpriority,
       count(*) as n, round(sum(o_totalprice), 2) as price
from orders group by cube(o_orderstatus, o_orderpriority) order by 1, 2
""")
def agg_cube_grouping(spark, sf_dir):
    dims = ["o_orderstatus", "o_orderpriority"]
    return aggs.cube_with_flags(load(spark, sf_dir, "orders"), dims, n=n_rows(), price=F.round(F.sum("o_totalprice"), 2)).orderBy(*dims)


@query("agg_rollup_grouping", """
select o_orderstatus, o_orderpriority, grouping(o_orderstatus)::int as g_o_orderstatus, grouping(o_orderpriority)::int as g_o_orderpriority, count(*) as n
from orders group by rollup(o_orderstatus, o_orderpriority)
""")
def agg_rollup_grouping(spark, sf_dir):
    return aggs.rollup_with_flags(load(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], n=n_rows())


@query("agg_grouping_sets", """
select o_orderstatus, o_orderpriority, grouping(o_orderstatus)::int as g_o_orderstatus, grouping(o_orderpriority)::int as g_o_orderpriority, count(*) as n
from orders group by grouping sets ((o_orderstatus), (o_orderpriority), ())
""")
def agg_grouping_sets(spark, sf_dir):
    dims = ["o_orderstatus", "o_orderpriority"]
    return aggs.grouping_sets(load(spark, sf_dir, "orders"), [[dims[0]], [dims[1]], []], dims, n=n_rows())


@query("agg_global", """
select count(*) as n, round(sum(l_quantity), 2) as quantity, round(sum(l_extendedprice), 2) as price from lineitem
""")
def agg_global(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").agg(
        n_rows().alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("agg_count_distinct", """
select strftime(ts, '%Y%m%d%H') as hour_text, count(distinct user_id) as uv from events group by 1
""")
def agg_count_distinct(spark, sf_dir):
    e = load(spark, sf_dir, "events").select(F.date_format("ts", "yyyyMMddHH").alias("hour_text"), "user_id")
    return aggs.exact_distinct(e, ["hour_text"], "user_id", "uv")


@query("agg_bitmap_distinct", """
select event_type, count(distinct user_id) as users from events group by 1
""")
def agg_bitmap_distinct(spark, sf_dir):
    return aggs.bitmap_distinct(load(spark, sf_dir, "events"), ["event_type"], "user_id", "users")


@query("agg_running_distinct", """
select event_id, event_type, (sum(fresh) over (partition by event_type order by ts, event_id))::bigint as users
from (select *, case when row_number() over (partition by event_type, user_id order by ts, event_id) = 1 then 1 else 0 end as fresh from events)
""")
def agg_running_distinct(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "event_type", "ts", "user_id")
    return aggs.running_distinct(e, ["event_type"], ["ts", "event_id"], "user_id", "users").select("event_id", "event_type", "users")


@query("agg_approx_distinct", """
select event_type, count(distinct props::json->>'k' || '/' || user_id) as exact, true as close from events group by 1
""")
def agg_approx_distinct(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("pair", F.concat_ws("/", F.col("item_id").cast("string"), F.col("user_id").cast("string")))
    exact = aggs.exact_distinct(e, ["event_type"], "pair", "exact")
    estimate = aggs.sketch_distinct(e.withColumn("day", F.to_date("ts")), ["event_type"], ["day"], "pair", "estimate", log_size=20)
    close = F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * 0.005
    return exact.join(estimate, "event_type").select("event_type", "exact", close.alias("close"))


@query("agg_weighted_avg", """
select event_type, user_id, (sum((props::json->>'k')::bigint * (event_id % 4)) // nullif(sum(event_id % 4), 0))::bigint as w_avg from events group by 1, 2
""")
def agg_weighted_avg(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.groupBy("event_type", "user_id").agg(aggs.weighted_average("item_id", F.col("event_id") % 4).alias("w_avg"))


@query("agg_site_metrics", """
select l_suppkey as site_id, time_bucket(interval 1 day, l_shipdate, timestamp '1990-01-01 16:00:00') as window_start,
       count(distinct l_orderkey) as orders, count(*) as sub_orders, round(sum(l_quantity), 2) as quantity, round(sum(l_extendedprice), 2) as gmv
from lineitem group by 1, 2
""")
def agg_site_metrics(spark, sf_dir):
    # one row per (site, day, order) first, so the distinct count is a plain count that combines map-side
    per_order = windows.windowed(
        load(spark, sf_dir, "lineitem"), "l_shipdate", "1 day", offset="-8 hours", keys=["l_suppkey", "l_orderkey"],
        sub_orders=n_rows(), quantity=F.sum("l_quantity"), gmv=F.sum("l_extendedprice"))
    return per_order.groupBy(F.col("l_suppkey").alias("site_id"), "window_start").agg(
        n_rows().alias("orders"), F.sum("sub_orders").alias("sub_orders"), F.round(F.sum("quantity"), 2).alias("quantity"), F.round(F.sum("gmv"), 2).alias("gmv"))


@query("agg_item_sales", """
select l_partkey, date_trunc('day', l_shipdate) as window_start, sum(l_quantity)::bigint as quantity from lineitem group by 1, 2
""")
def agg_item_sales(spark, sf_dir):
    sales = windows.windowed(load(spark, sf_dir, "lineitem"), "l_shipdate", "1 day", keys=["l_partkey"], quantity=F.sum("l_quantity").cast("bigint"))
    return sales.drop("window_end")


@query("agg_avg", """
select user_id, date_trunc('day', ts) as day, round(avg(value), 4) as mean from events group by 1, 2
""")
def agg_avg(spark, sf_dir):
    daily = windows.windowed(load(spark, sf_dir, "events"), "ts", "1 day", keys=["user_id"], mean=F.round(F.avg("value"), 4))
    return daily.select("user_id", F.col("window_start").alias("day"), "mean")


@query("agg_window_max", """
select user_id, time_bucket(interval 10 seconds, ts) as window_start, time_bucket(interval 10 seconds, ts) + interval 10 seconds as window_end, max(value) as top
from events group by 1, 2, 3
""")
def agg_window_max(spark, sf_dir):
    return windows.windowed(load(spark, sf_dir, "events"), "ts", "10 seconds", keys=["user_id"], top=F.max("value"))


@query("agg_window_count_sum", """
select user_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as start_text, strftime(date_trunc('hour', ts) + interval 1 hour, '%Y-%m-%d %H:%M:%S') as end_text,
       count(*) as n, sum((props::json->>'k')::int)::bigint as total
from events group by user_id, date_trunc('hour', ts)
""")
def agg_window_count_sum(spark, sf_dir):
    hourly = windows.windowed(events(spark, sf_dir), "ts", "1 hour", keys=["user_id"], n=n_rows(), total=F.sum("item_id"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return hourly.select("user_id", F.date_format("window_start", fmt).alias("start_text"), F.date_format("window_end", fmt).alias("end_text"), "n", "total")


@query("agg_window_reduce_sum", """
select strftime(ts, '%Y-%m-%d %H:%M') || '_' || event_type as biz_key, time_bucket(interval 30 seconds, ts) as window_start, count(*) as cnt, round(sum(value), 4) as amount
from events group by 1, 2
""")
def agg_window_reduce_sum(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("at", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    keyed = rows.minute_key_lines(e, "at", ["event_type"], "value")
    return windows.windowed(keyed, "ts", "30 seconds", keys=["biz_key"], cnt=F.sum("cnt"), amount=F.round(F.sum("amount"), 4)).drop("window_end")


@query("agg_account_summary", """
select o_custkey, o_orderkey, round(sum(o_totalprice) over w, 2) as total, count(*) over w as n
from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding)
""")
def agg_account_summary(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    running = aggs.running_totals(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], count="n", total="o_totalprice")
    return running.select("o_custkey", "o_orderkey", F.round("total", 2).alias("total"), "n")


@query("agg_window_collect", """
with d as (select user_id, date_trunc('day', ts) as day, ts, event_id, event_type,
                  (row_number() over (partition by user_id, date_trunc('day', ts) order by ts, event_id) - 1) // 1000 as chunk_no from events),
w as (select user_id, day, count(*) as n, min(ts) as first_ts, max(ts) as last_ts from d group by 1, 2)
select user_id, day, chunk_no::bigint as chunk_no, any_value(n) as n, any_value(first_ts) as first_ts, any_value(last_ts) as last_ts,
       string_agg(event_type, ',' order by ts, event_id) as joined
from d join w using (user_id, day) group by 1, 2, 3
""")
def agg_window_collect(spark, sf_dir):
    """Count, first and last of each window, next to its list; a very long list takes several rows, each with the window's figures."""
    e = load(spark, sf_dir, "events").select("user_id", F.window("ts", "1 day").start.alias("day"), "ts", "event_id", "event_type")
    figures = e.groupBy("user_id", "day").agg(n_rows().alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    lists = aggs.group_lists(e, ["user_id", "day"], ["ts", "event_id"], F.col("event_type"), "entries")
    return lists.join(figures, ["user_id", "day"]).select("user_id", "day", "chunk_no", "n", "first_ts", "last_ts", F.concat_ws(",", "entries").alias("joined"))


@query("agg_latest_then_count", """
select event_type, count(*) as users from (
  select user_id, event_type, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1 group by 1
""")
def agg_latest_then_count(spark, sf_dir):
    return aggs.latest_then_count(load(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"], "users")


@query("agg_keep_first", """
select user_id, date_trunc('day', ts) as window_start, arg_min(value, ts) as first_value from events group by 1, 2
""")
def agg_keep_first(spark, sf_dir):
    first = F.min_by("value", F.struct("ts", "event_id"))
    return windows.windowed(load(spark, sf_dir, "events"), "ts", "1 day", keys=["user_id"], first_value=first).drop("window_end")


@query("agg_job_metrics", r"""
with s as (select unnest(string_split(text, chr(10))) as line from documents),
w as (select unnest(regexp_split_to_array(line, '\s+')) as word from s where trim(line) <> ''),
l as (select length(word) as len from w where length(word) > 0)
select 'sentences' as metric, -1::bigint as bucket, count(*)::bigint as n from s where trim(line) <> ''
union all select 'words', -1, count(*) from l
union all select 'word_length', len, count(*) from l group by len
union all select 'sentence_words', k, count(*) from (select len(list_filter(regexp_split_to_array(line, '\s+'), lambda x: length(x) > 0)) as k from s where trim(line) <> '') group by k
""")
def agg_job_metrics(spark, sf_dir):
    lines = load(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n", -1)).alias("line")).filter(F.trim("line") != "")
    sentences = lines.agg(n_rows().alias("n")).select(F.lit("sentences").alias("metric"), F.lit(-1).cast("bigint").alias("bucket"), "n")
    lengths = rows.tokens(lines, "line").groupBy(F.length("word").cast("bigint").alias("bucket")).agg(n_rows().alias("n"))
    histogram = lengths.select(F.lit("word_length").alias("metric"), "bucket", "n")
    words = lengths.agg(F.sum("n").alias("n")).select(F.lit("words").alias("metric"), F.lit(-1).cast("bigint").alias("bucket"), "n")
    per_line = F.size(F.filter(F.split("line", r"\s+"), lambda x: F.length(x) > 0)).cast("bigint")
    gauge = lines.groupBy(per_line.alias("bucket")).agg(n_rows().alias("n")).select(F.lit("sentence_words").alias("metric"), "bucket", "n")
    return sentences.union(words).union(histogram).union(gauge)


@query("agg_job_metrics_stream", """
with e as (select *, (epoch_us(ts) - min(epoch_us(ts)) over ()) // ((max(epoch_us(ts)) over () - min(epoch_us(ts)) over ()) // 4 + 1) as span from events),
h as (select span, 'value' as metric, case when value < 20 then 0 when value < 50 then 1 when value < 100 then 2 else 3 end as bucket from e where value is not null)
select span, 'rows' as metric, -1::bigint as bucket, count(*)::bigint as n from e group by 1
union all select span, 'errors', -1, count(*) filter (event_type = 'error') from e group by 1
union all select s.span, 'value', b.bucket::bigint, count(h.span) from (select distinct span from e) s cross join (select unnest(range(4)) as bucket) b
  left join h on h.span = s.span and h.bucket = b.bucket group by 1, 3
""")
def agg_job_metrics_stream(spark, sf_dir):
    """Counters and a histogram of each micro-batch of a running query, as its listener wrote them."""
    replay = event_replay(spark, sf_dir)
    watched = observed(replayed_events(replay), "job", {"rows": F.lit(True), "errors": F.col("event_type") == "error"}, {"value": (F.col("value"), [20, 50, 100])})
    with MetricsLog(spark, "job") as log:
        run_to_files(watched.select("event_id"), scratch_dir(spark, "watched"), feed=replay)
    return log.table().select(F.col("batch_id").alias("span"), "metric", "bucket", "n")
