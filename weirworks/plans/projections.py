"""Queries of projections, filters and row functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weirworks.functions import expr as X
from weirworks.functions.sql import register
from weirworks.operators import rows
from weirworks.plans.registry import query
from weirworks.tables import events, load


@query("proj_parse_csv_line", """
select user_id, event_type, case when event_id % 3 = 0 then 1 else (props::json->>'k')::int end as minutes from events
""")
def proj_parse_csv_line(spark, sf_dir):
    e = events(spark, sf_dir)
    line = F.when(F.col("event_id") % 3 == 0, rows.delimited_line("user_id", "event_type")).otherwise(
        rows.delimited_line("user_id", "event_type", "item_id"))
    schema = {"user_id": "bigint", "event_type": "string", "minutes": "int"}
    return rows.parse_delimited(e.select(line.alias("line")), "line", schema, defaults={"minutes": 1})


@query("proj_tokenize", r"""
select word, count(*) as n from (select unnest(regexp_split_to_array(text, '\s+')) as word from documents)
where length(word) > 0 group by 1
""")
def proj_tokenize(spark, sf_dir):
    words = rows.tokens(load(spark, sf_dir, "documents").select("text"), "text")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("proj_biz_line", """
select strftime(ts, '%Y-%m-%d %H:%M') || '_' || user_id || '_' || event_type as biz_key, count(*) as cnt, round(sum(value), 4) as amount
from events group by 1
""")
def proj_biz_line(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("at", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    keyed = rows.minute_key_lines(e, "at", ["user_id", "event_type"], "value")
    return keyed.groupBy("biz_key").agg(F.sum("cnt").alias("cnt"), F.round(F.sum("amount"), 4).alias("amount"))


@query("filter_predicate", """
select event_id, value from events where event_type = 'view' and value < 150 and trim(props) <> ''
""")
def filter_predicate(spark, sf_dir):
    keep = (F.col("event_type") == "view") & (F.col("value") < 150) & (F.trim("props") != "")
    return load(spark, sf_dir, "events").filter(keep).select("event_id", "value")


@query("split_side_output", """
select event_id, value, 'main' as output from events
union all select event_id, value, 'side' from events where value < 18
""")
def split_side_output(spark, sf_dir):
    return rows.tagged_fan_out(load(spark, sf_dir, "events").select("event_id", "value"), F.col("value") < 18)


@query("proj_unit_convert", """
select user_id, date_trunc('hour', ts) as hour, round(max((value - 32) * (5.0::double / 9.0::double)), 4) as max_c from events group by 1, 2
""")
def proj_unit_convert(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("celsius", rows.to_celsius("value"))
    return e.groupBy("user_id", F.window("ts", "1 hour").start.alias("hour")).agg(F.round(F.max("celsius"), 4).alias("max_c"))


@query("filter_map_condition", """
select event_id, props from events where (props::json->>'k')::double > 15 and props::json->>'k' <> '42'
""")
def filter_map_condition(spark, sf_dir):
    high = rows.matches_map_condition("props", number_above={"k": 15})
    answer = rows.matches_map_condition("props", text_equals={"k": "42"})
    absent = rows.matches_map_condition("props", text_equals={"no_such_key": "1"})
    return load(spark, sf_dir, "events").filter(high & ~answer & ~absent).select("event_id", "props")


@query("lateral_split", """
select split_part(s, '#', 1) as name, split_part(s, '#', 2)::bigint as num
from (select case when event_id % 4 = 0 then event_type else event_type || '#' || user_id end as s from events) where contains(s, '#')
""")
def lateral_split(spark, sf_dir):
    data = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise(F.concat_ws("#", "event_type", F.col("user_id").cast("string")))
    pairs = rows.split_pair(load(spark, sf_dir, "events").select(data.alias("data")), "data", "#", "name", "num")
    return pairs.withColumn("num", F.col("num").cast("bigint"))


@query("lateral_unnest", """
select conv_id, turn, unnest(string_split(text, ' ')) as piece from conversations
""")
def lateral_unnest(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").select("conv_id", "turn", F.split("text", " ", -1).alias("pieces"))
    return rows.unnest(c, "pieces", "piece")


@query("fn_scalars", """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as at_text, upper(o_orderpriority) as upper_text,
       o_orderdate + interval 30 seconds as later, least(o_custkey, o_orderkey) as low,
       (date_diff('second', o_orderdate, timestamp '1996-01-01 00:00:00'))::bigint as seconds_off,
       o_orderkey + o_custkey as plus_long, round(o_totalprice + o_custkey, 4) as plus_double,
       substring(o_orderpriority, 1, 1) as initial
from orders
""")
def fn_scalars(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    fixed = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    return o.select(
        "o_orderkey", X.time_text("o_orderdate").alias("at_text"), X.strict_upper("o_orderpriority").alias("upper_text"),
        X.seconds_after("o_orderdate", 30).alias("later"), F.least("o_custkey", "o_orderkey").alias("low"),
        X.seconds_between("o_orderdate", fixed).alias("seconds_off"),
        (F.col("o_orderkey") + F.col("o_custkey")).alias("plus_long"),
        F.round(F.col("o_totalprice") + F.col("o_custkey"), 4).alias("plus_double"),
        F.substring("o_orderpriority", 1, 1).alias("initial"),
    )


@query("fn_great_circle", """
with p as (select s_suppkey, s_nationkey, (s_suppkey * 37 % 180 - 90)::double as lat, (s_suppkey * 91 % 360 - 180)::double as lon from supplier)
select s_suppkey, round(round(2 * 6378.137 * asin(sqrt(pow(sin((radians(lat) - radians(10.5)) / 2), 2)
       + cos(radians(lat)) * cos(radians(10.5)) * pow(sin((radians(lon) - radians(20.25)) / 2), 2))), 4) * 1000, 0)::bigint as metres
from p
""")
def fn_great_circle(spark, sf_dir):
    s = load(spark, sf_dir, "supplier")
    lat = (F.col("s_suppkey") * 37 % 180 - 90).cast("double")
    lon = (F.col("s_suppkey") * 91 % 360 - 180).cast("double")
    return s.select("s_suppkey", F.round(X.great_circle_m(lat, lon, F.lit(10.5), F.lit(20.25)), 0).cast("bigint").alias("metres"))


@query("fn_sql_fraud", """
with a as (select user_id as account_id, event_id as transaction_id, ts, (event_id * 37 % 180 - 90)::double as lat, (event_id * 91 % 360 - 180)::double as lon from events),
p as (
  select x.account_id, x.transaction_id as first_id, y.transaction_id as second_id, strftime(x.ts, '%Y-%m-%d %H:%M:%S') as first_at, (epoch_us(y.ts) - epoch_us(x.ts)) // 1000000 as seconds,
         round(2 * 6378.137 * asin(sqrt(pow(sin((radians(x.lat) - radians(y.lat)) / 2), 2) + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin((radians(x.lon) - radians(y.lon)) / 2), 2))), 4) as km
  from a x join a y on x.account_id = y.account_id and x.ts between y.ts - interval 10 minutes and y.ts and x.transaction_id <> y.transaction_id and (x.lat <> y.lat or x.lon <> y.lon) and x.ts <> y.ts)
select account_id, first_id, second_id, first_at, round(km, 0)::bigint as km, seconds::bigint as seconds, case when seconds <> 0 then round(km * 3600 / seconds, 0)::bigint end as kmh from p
""")
def fn_sql_fraud(spark, sf_dir):
    """Withdrawals of one account too far apart for the time between them, as SQL text with named functions. Slots of ten minutes are join keys beside the account."""
    register(spark)
    e = load(spark, sf_dir, "events")
    name = f"atm_{uuid.uuid4().hex}"  # concurrent queries don't share it
    e.select(F.col("user_id").alias("account_id"), F.col("event_id").alias("transaction_id"), "ts", (F.col("event_id") * 37 % 180 - 90).cast("double").alias("lat"),
             (F.col("event_id") * 91 % 360 - 180).cast("double").alias("lon"), F.floor(X.micros("ts") / 600_000_000).alias("slot")).createOrReplaceTempView(name)
    pairs = spark.sql(f"""
        SELECT T1.account_id, T1.transaction_id AS first_id, T2.transaction_id AS second_id, date_text(unix_millis(CAST(T1.ts AS TIMESTAMP)), 'yyyy-MM-dd HH:mm:ss') AS first_at,
               geo_distance(T1.lat, T1.lon, T2.lat, T2.lon) / 1000 AS distance_km, seconds_between(T1.ts, T2.ts) AS seconds
        FROM {name} T1 JOIN (SELECT *, explode(array(slot, slot - 1)) AS near FROM {name}) T2 ON T1.account_id = T2.account_id AND T1.slot = T2.near
        WHERE T1.ts BETWEEN T2.ts - INTERVAL '10' MINUTE AND T2.ts AND T1.transaction_id <> T2.transaction_id AND (T1.lat <> T2.lat OR T1.lon <> T2.lon) AND T1.ts <> T2.ts""")
    kmh = F.try_divide(F.col("distance_km") * 3600, F.col("seconds"))
    return pairs.select("account_id", "first_id", "second_id", "first_at", F.round("distance_km", 0).cast("bigint").alias("km"), "seconds", F.round(kmh, 0).cast("bigint").alias("kmh"))


@query("fn_sql_lateral", """
select user_id || '#' || event_id as data, user_id::varchar as name, event_id::int as num from events where event_id % 3 <> 0
""")
def fn_sql_lateral(spark, sf_dir):
    """A table function in LATERAL; text without the separator gives no row."""
    register(spark)
    sep = F.when(F.col("event_id") % 3 == 0, "-").otherwise("#")
    name = f"users_{uuid.uuid4().hex}"
    load(spark, sf_dir, "events").select(F.concat(F.col("user_id").cast("string"), sep, F.col("event_id").cast("string")).alias("data")).createOrReplaceTempView(name)
    return spark.sql(f"SELECT data, T.name, T.num FROM {name}, LATERAL split_pair(data) AS T(name, num)")


@query("set_union_streams", """
select ts, user_id, value from events where event_type = 'view' union all select ts, user_id, value from events where event_type = 'click'
""")
def set_union_streams(spark, sf_dir):
    views = events(spark, sf_dir, "view").select("ts", "user_id", "value")
    clicks = events(spark, sf_dir, "click").select("value", "user_id", "ts")
    return views.unionByName(clicks)


@query("set_tagged_union", """
select 'order' as src, o_orderkey as order_key, o_orderdate as at, o_totalprice as amount, null::int as line from orders
union all select 'shipment', l_orderkey, l_shipdate, null, l_linenumber from lineitem
""")
def set_tagged_union(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("at"), F.col("o_totalprice").alias("amount"))
    li = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"), F.col("l_shipdate").alias("at"), F.col("l_linenumber").alias("line"))
    return rows.tagged_union(order=o, shipment=li)
