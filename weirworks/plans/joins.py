"""Queries of joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirworks.functions.expr import micros, n_rows
from weirworks.operators import joins
from weirworks.plans.registry import query
from weirworks.session import scratch_dir
from weirworks.sources.snapshots import Snapshots, refreshed_lookup
from weirworks.sources.upserts import UpsertTable
from weirworks.streaming.runner import run_all, run_batches
from weirworks.tables import event_replay, events, load, replayed_events


def clicks(spark, sf_dir):
    return events(spark, sf_dir, "click").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))


def purchases(spark, sf_dir):
    return events(spark, sf_dir, "purchase").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"), F.col("value").alias("amount"))


def errors(spark, sf_dir):
    return events(spark, sf_dir, "error").select("user_id", F.col("event_id").alias("error_id"), F.col("ts").alias("error_ts"))


SIDES = """
with c as (select user_id, event_id as click_id, ts as click_ts, time_bucket(interval 1 day, ts, timestamp '2024-01-01 00:00:30') as w from events where event_type = 'click'),
p as (select user_id, event_id as purchase_id, ts as purchase_ts, value as amount, time_bucket(interval 1 day, ts, timestamp '2024-01-01 00:00:30') as w from events where event_type = 'purchase'),
e as (select user_id, event_id as error_id, time_bucket(interval 1 day, ts, timestamp '2024-01-01 00:00:30') as w from events where event_type = 'error')
"""


def day_join(spark, sf_dir, how, defaults=None):
    joined = joins.window_join(clicks(spark, sf_dir), purchases(spark, sf_dir), ["user_id"], "click_ts", "purchase_ts", "1 day", "30 seconds", how, defaults)
    return joined.select("user_id", F.col("w.start").alias("w"), "click_id", "purchase_id", "amount")


@query("join_window_inner", SIDES + "select c.user_id, c.w, click_id, purchase_id, amount from c join p on c.user_id = p.user_id and c.w = p.w")
def join_window_inner(spark, sf_dir):
    return day_join(spark, sf_dir, "inner")


@query("join_window_left", SIDES + """
select c.user_id, c.w, click_id, coalesce(purchase_id, -1) as purchase_id, coalesce(amount, 0.0) as amount from c left join p on c.user_id = p.user_id and c.w = p.w
""")
def join_window_left(spark, sf_dir):
    return day_join(spark, sf_dir, "left", {"purchase_id": -1, "amount": 0.0})


@query("join_window_right", SIDES + """
select p.user_id, p.w, coalesce(click_id, -1) as click_id, purchase_id, amount from c right join p on c.user_id = p.user_id and c.w = p.w
""")
def join_window_right(spark, sf_dir):
    return day_join(spark, sf_dir, "right", {"click_id": -1})


@query("join_window_cogroup_inner", SIDES + """
select c.user_id, c.w, count(*) as pairs, round(sum(amount), 4) as amount from c join p on c.user_id = p.user_id and c.w = p.w group by 1, 2
""")
def join_window_cogroup_inner(spark, sf_dir):
    # only totals over the pairs are wanted, so each side is aggregated first and no pairs are made
    a = joins.with_window(clicks(spark, sf_dir), "click_ts", "1 day", "30 seconds").groupBy("user_id", "w").agg(n_rows().alias("n"))
    b = joins.with_window(purchases(spark, sf_dir), "purchase_ts", "1 day", "30 seconds").groupBy("user_id", "w").agg(n_rows().alias("m"), F.sum("amount").alias("s"))
    return a.join(b, ["user_id", "w"]).select(
        "user_id", F.col("w.start").alias("w"), (F.col("n") * F.col("m")).alias("pairs"), F.round(F.col("s") * F.col("n"), 4).alias("amount"))


@query("join_window_three_way", SIDES + """
select c.user_id, c.w, click_id, purchase_id, error_id from c join p on c.user_id = p.user_id and c.w = p.w join e on c.user_id = e.user_id and c.w = e.w
""")
def join_window_three_way(spark, sf_dir):
    two = joins.window_join(clicks(spark, sf_dir), purchases(spark, sf_dir), ["user_id"], "click_ts", "purchase_ts", "1 day", "30 seconds")
    third = joins.with_window(errors(spark, sf_dir), "error_ts", "1 day", "30 seconds")
    return two.join(third, ["user_id", "w"]).select("user_id", F.col("w.start").alias("w"), "click_id", "purchase_id", "error_id")


@query("cogroup_lists", """
with e as (select *, date_trunc('day', ts) as w, ((row_number() over (partition by user_id, event_type, date_trunc('day', ts) order by ts, event_id) - 1) // 1000)::bigint as chunk_no from events),
c as (select user_id, w, chunk_no, string_agg(event_id::varchar, ',' order by ts, event_id) as clicks from e where event_type = 'click' group by all),
p as (select user_id, w, chunk_no, string_agg(event_id::varchar, ',' order by ts, event_id) as purchases from e where event_type = 'purchase' group by all)
select user_id, w, chunk_no, clicks, purchases from c full join p using (user_id, w, chunk_no)
""")
def cogroup_lists(spark, sf_dir):
    lists = joins.cogroup_lists(
        clicks(spark, sf_dir), purchases(spark, sf_dir), ["user_id"], ["click_ts", "click_id"], ["purchase_ts", "purchase_id"],
        F.col("click_id").cast("string"), F.col("purchase_id").cast("string"), "1 day")
    joined = {name: F.when(F.col(c).isNotNull(), F.concat_ws(",", c)).alias(name) for name, c in (("clicks", "left_list"), ("purchases", "right_list"))}
    return lists.select("user_id", "w", "chunk_no", joined["clicks"], joined["purchases"])


def order_sides(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderdate", "o_totalprice")
    li = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"), "l_shipdate", "l_linenumber", "l_quantity")
    return o, li


@query("join_interval_inclusive", """
select o_orderkey as order_key, o_orderdate, l_shipdate, l_linenumber, l_quantity from orders join lineitem
on l_orderkey = o_orderkey and l_shipdate between o_orderdate and o_orderdate + interval 90 days
""")
def join_interval_inclusive(spark, sf_dir):
    o, li = order_sides(spark, sf_dir)
    return joins.interval_join(o, li, ["order_key"], "o_orderdate", "l_shipdate", "0 days", "90 days").drop("o_totalprice")


@query("join_interval_exclusive", """
with c as (select user_id, event_id as click_id, ts as click_ts from events where event_type = 'click'),
p as (select user_id, event_id as purchase_id, ts as purchase_ts from events where event_type = 'purchase')
select c.user_id, click_id, click_ts, purchase_id, purchase_ts from c join p on c.user_id = p.user_id
and purchase_ts > click_ts - interval 1 hour and purchase_ts < click_ts + interval 1 hour
""")
def join_interval_exclusive(spark, sf_dir):
    return joins.interval_join(
        clicks(spark, sf_dir), purchases(spark, sf_dir).drop("amount"), ["user_id"], "click_ts", "purchase_ts", "-1 hour", "1 hour", inclusive=False, bucketed=True)


@query("join_interval_self_theta", """
select a.user_id, a.event_id as first_id, b.event_id as second_id, epoch_us(b.ts) - epoch_us(a.ts) as apart_us,
       round(abs(b.value - a.value) * 3600000000 / (epoch_us(b.ts) - epoch_us(a.ts)), 2) as per_hour
from events a join events b on a.user_id = b.user_id and b.ts > a.ts and b.ts <= a.ts + interval 1 hour and a.event_type <> b.event_type
""")
def join_interval_self_theta(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    a = e.select("user_id", F.col("event_id").alias("first_id"), F.col("ts").alias("ts1"), F.col("event_type").alias("type1"), F.col("value").alias("v1"))
    b = e.select("user_id", F.col("event_id").alias("second_id"), F.col("ts").alias("ts2"), F.col("event_type").alias("type2"), F.col("value").alias("v2"))
    pairs = joins.interval_join(a, b, ["user_id"], "ts1", "ts2", "0 hours", "1 hour", bucketed=True)
    apart = micros("ts2") - micros("ts1")
    return pairs.filter((F.col("ts2") > F.col("ts1")) & (F.col("type1") != F.col("type2"))).select(
        "user_id", "first_id", "second_id", apart.alias("apart_us"),
        F.round(F.try_divide(F.abs(F.col("v2") - F.col("v1")) * F.lit(3_600_000_000), apart), 2).alias("per_hour"))


def rates(spark, sf_dir):
    return events(spark, sf_dir, "signup").select("user_id", F.col("ts").alias("rate_ts"), F.col("event_id").alias("rate_id"), F.col("value").alias("rate"))


@query("join_asof", """
select p.user_id, p.event_id as purchase_id, p.ts as purchase_ts, p.value as amount, r.value as rate, round(p.value * r.value, 4) as converted
from (select * from events where event_type = 'purchase') p asof join (select * from events where event_type = 'signup') r
on p.user_id = r.user_id and p.ts >= r.ts
""")
def join_asof(spark, sf_dir):
    joined = joins.asof_join(purchases(spark, sf_dir), rates(spark, sf_dir), ["user_id"], "purchase_ts", "purchase_id", "rate_ts", "rate_id", ["rate"])
    return joined.withColumn("converted", F.round(F.col("amount") * F.col("rate"), 4))


@query("join_asof_left", """
select p.user_id, p.event_id as purchase_id, p.ts as purchase_ts, p.value as amount, r.value as rate
from (select * from events where event_type = 'purchase') p asof left join (select * from events where event_type = 'signup') r
on p.user_id = r.user_id and p.ts >= r.ts
""")
def join_asof_left(spark, sf_dir):
    return joins.asof_join(purchases(spark, sf_dir), rates(spark, sf_dir), ["user_id"], "purchase_ts", "purchase_id", "rate_ts", "rate_id", ["rate"], how="left")


@query("join_asof_subquery", """
select user_id, ts, value from events r where event_type = 'signup'
and ts = (select max(ts) from events x where x.event_type = 'signup' and x.user_id = r.user_id and x.ts <= timestamp '2024-01-15 10:58:00')
""")
def join_asof_subquery(spark, sf_dir):
    return spark.sql("""
        select user_id, ts, value from {rates} r
        where ts = (select max(ts) from {rates} x where x.user_id = r.user_id and x.ts <= timestamp_ntz '2024-01-15 10:58:00')""", rates=events(spark, sf_dir, "signup"))


@query("join_max_per_group", """
with m as (select user_id, max(ts) as ts from events group by 1)
select event_type, count(*) as users from events join m using (user_id, ts) group by 1
""")
def join_max_per_group(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    newest = e.groupBy("user_id").agg(F.max("ts").alias("ts"))
    return e.join(newest, ["user_id", "ts"]).groupBy("event_type").agg(n_rows().alias("users"))


@query("lookup_full_refresh", """
select c_custkey, c_nationkey, suppliers, suppliers is null as lookup_failed
from customer left join (select s_nationkey, count(*) as suppliers from supplier group by 1) s on c_nationkey = s_nationkey
""")
def lookup_full_refresh(spark, sf_dir):
    nations = load(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(n_rows().alias("suppliers"))
    return joins.lookup(load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), nations, ["c_nationkey"], "flag")


SPAN = "(epoch_us(ts) - min(epoch_us(ts)) over ()) // ((max(epoch_us(ts)) over () - min(epoch_us(ts)) over ()) // 4 + 1)"


def segments(spark, sf_dir, version: int):
    """A version of the users' segments: each lacks other users and names itself; version 2 has every user twice."""
    users = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.concat_ws(":", "c_mktsegment", F.lit(version)).alias("segment"))
    users = users.filter(F.col("user_id") % 7 != version)
    return users.unionByName(users) if version == 2 else users


@query("lookup_refreshed_stream", f"""
with e as (select event_id, user_id, {SPAN} as b from events), v as (select *, case when b = 2 then 1 else b end as version from e)
select event_id, user_id, case when c_custkey is not null then c_mktsegment || ':' || version end as segment, c_custkey is null as lookup_failed, version::bigint as version
from v left join customer on c_custkey = user_id and c_custkey % 7 <> version
""")
def lookup_refreshed_stream(spark, sf_dir):
    """A dimension published anew before each micro-batch; version 2 is broken, so version 1 stays in force."""
    replay = event_replay(spark, sf_dir)
    snapshots = Snapshots(spark, scratch_dir(spark, "segments"), segments(spark, sf_dir, 0).schema, ["user_id"])
    path = scratch_dir(spark, "refreshed")

    def feed():
        for i in replay:
            snapshots.publish(segments(spark, sf_dir, i), i)
            yield i

    run_batches(replayed_events(replay).select("event_id", "user_id"), refreshed_lookup(snapshots, path), feed=feed())
    return spark.read.parquet(path).select("event_id", "user_id", "segment", "lookup_failed", "version")


@query("lookup_versioned", """
with v as (select event_id, user_id, case when ts >= timestamp '2024-01-28' then 3 when ts >= timestamp '2024-01-20' then 2 when ts >= timestamp '2024-01-10' then 1
  when ts >= timestamp '2024-01-02' then 0 end as version from events)
select event_id, user_id, case when c_custkey is not null then c_mktsegment || ':' || version end as segment, c_custkey is null as lookup_failed
from v left join customer on c_custkey = user_id and c_custkey % 7 <> version where version is not null
""")
def lookup_versioned(spark, sf_dir):
    """The same over stored history: four versions, each in force from its time on."""
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    versions = spark.sql("select cast(since as timestamp_ntz) as since, version from values ('2024-01-02', 0), ('2024-01-10', 1), ('2024-01-20', 2), ('2024-01-28', 3) as v(since, version)")
    users = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("version"))
    users = users.filter("user_id % 7 <> version").select("version", "user_id", F.concat_ws(":", "c_mktsegment", "version").alias("segment"))
    return joins.version_lookup(e, "ts", "event_id", versions, users, ["user_id"]).select("event_id", "user_id", "segment", "lookup_failed")


@query("lookup_inner", """
select o_orderkey, o_custkey, c_name from orders join customer on o_custkey = c_custkey
""")
def lookup_inner(spark, sf_dir):
    names = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.lookup(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), names, ["o_custkey"])


@query("lookup_left_default", """
select c_custkey, c_name, coalesce(urgent, 0)::bigint as urgent
from customer left join (select o_custkey, count(*) as urgent from orders where o_orderpriority = '1-URGENT' group by 1) o on o_custkey = c_custkey
""")
def lookup_left_default(spark, sf_dir):
    urgent = load(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    known = urgent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(n_rows().alias("urgent"))
    return joins.lookup(load(spark, sf_dir, "customer").select("c_custkey", "c_name"), known, ["c_custkey"], "left", {"urgent": 0})


@query("broadcast_rule_semi", """
with r as (select event_type, min(ts) as since from events where value > 150 group by 1)
select e.event_id, e.event_type, e.ts from events e where exists (select 1 from r where r.event_type = e.event_type and r.since <= e.ts)
""")
def broadcast_rule_semi(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    rules = e.filter("value > 150").select("event_type", F.col("ts").alias("rule_ts"))
    return joins.rule_semi_join(e.select("event_id", "event_type", "ts"), rules, "event_type", "ts", "rule_ts")


@query("broadcast_rule_semi_stream", """
with r as (select event_type, min(ts) as since from events where value > 150 group by 1)
select e.event_id, e.event_type from events e where exists (select 1 from r where r.event_type = e.event_type and r.since <= e.ts)
""")
def broadcast_rule_semi_stream(spark, sf_dir):
    """The same with two streams: a table of rules, kept by a query of its own, that the events of each micro-batch are joined with."""
    replay, out = event_replay(spark, sf_dir), scratch_dir(spark, "allowed")
    timed = replayed_events(replay).filter("ts is not null")
    rules = timed.filter("value > 150").groupBy("event_type").agg(F.min("ts").alias("since"))
    table, checkpoint = UpsertTable(spark, scratch_dir(spark, "rules"), rules.schema, ["event_type"]), scratch_dir(spark, "rules-checkpoint")

    def feed():
        for i in replay:
            run_all(rules.writeStream.outputMode("update").foreachBatch(table.write), checkpoint)
            yield i

    def allowed(batch, batch_id):
        known = batch.join(table.read(), "event_type").filter("since <= ts")
        known.select("event_id", "event_type").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    run_batches(timed.select("event_id", "event_type", "ts"), allowed, feed=feed())
    return spark.read.schema("event_id BIGINT, event_type STRING").parquet(out).drop("batch_id")


@query("broadcast_config_path", """
with s as (select *, sum(case when event_type = 'purchase' then 1 else 0 end) over (partition by user_id order by ts, event_id) - (event_type = 'purchase')::int as path_no from events),
p as (select user_id, path_no::bigint as path_no, count(*) as path_length, count(*) filter (event_type = 'click') as n_click, count(*) filter (event_type = 'view') as n_view,
      count(*) filter (event_type = 'signup') as n_signup, count(*) filter (event_type = 'error') as n_error, count(*) filter (event_type = 'purchase') as n_purchase,
      max(ts) filter (event_type = 'purchase') as end_ts from s group by 1, 2),
c as (select ts, arg_max(floor(value / 50)::int + 1, event_id) as announced from events where event_type = 'signup' group by 1),
f as (select p.*, coalesce(c.announced, 1)::int as max_length from (select * from p where n_purchase > 0) p asof left join c on p.end_ts >= c.ts)
select * from f where path_length > max_length and path_no < 10
""")
def broadcast_config_path(spark, sf_dir):
    """Paths longer than the limit in force at their end, for users with fewer than ten purchases before; signups announce the limits."""
    e = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    paths = joins.paths_to_event(e, ["user_id"], ["ts", "event_id"], "event_type", "purchase", ["click", "view", "signup", "error", "purchase"])
    limits = e.filter("event_type = 'signup'").select(F.col("ts").alias("since"), F.col("event_id").alias("config_id"), (F.floor(F.col("value") / 50).cast("int") + 1).alias("max_length"))
    limited = joins.asof_join(paths, limits, [], "end_ts", "user_id", "since", "config_id", ["max_length"], how="left")
    return limited.withColumn("max_length", F.coalesce("max_length", F.lit(1))).filter("path_length > max_length and path_no < 10")


@query("convert_with_buffer", """
with p as (select * from events where event_type = 'purchase'), r as (select * from events where event_type = 'signup'),
b as (select p.user_id, p.event_id, p.ts, p.value,
  (select arg_max({'v': r.value, 't': r.ts}, r.ts) from r where r.user_id = p.user_id and r.ts <= p.ts) as back,
  (select arg_min({'v': r.value, 't': r.ts}, r.ts) from r where r.user_id = p.user_id and r.ts > p.ts) as ahead from p)
select user_id, event_id as purchase_id, ts as purchase_ts, value as amount, coalesce(back, ahead).v as rate, greatest(ts, coalesce(back, ahead).t) as emitted_at
from b where coalesce(back, ahead) is not null
""")
def convert_with_buffer(spark, sf_dir):
    return joins.buffered_asof_join(purchases(spark, sf_dir), rates(spark, sf_dir), ["user_id"], "purchase_ts", "purchase_id", "rate_ts", "rate_id", ["rate"])


@query("match_or_timeout", """
with o as (select o_orderkey, o_orderdate, o_orderdate + to_days((1 + o_orderkey % 90)::int) as deadline from orders),
m as (select o_orderkey, o_orderdate, deadline, min(l_shipdate) as s from o left join lineitem on l_orderkey = o_orderkey and l_shipdate between o_orderdate and deadline group by 1, 2, 3)
select o_orderkey, o_orderdate, deadline, case when s is null then 'timeout' else 'on_time' end as status, coalesce(s, deadline) as event_at from m
""")
def match_or_timeout(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    li = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    return joins.match_or_timeout(o, li, ["o_orderkey"], "o_orderdate", "l_shipdate", 1 + F.col("o_orderkey") % 90)
