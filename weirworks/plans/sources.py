"""Queries of sources and sinks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from weirworks.functions.expr import item_at
from weirworks.operators import rows
from weirworks.operators.ordered import task_count
from weirworks.plans.registry import query
from weirworks.session import scratch_dir
from weirworks.sources import readers, writers
from weirworks.streaming.runner import run_batches, run_to_changes, run_to_files
from weirworks.tables import dated, event_replay, events, load, replayed_events

MICROS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
EVENT_JSON = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def event_texts(spark, sf_dir):
    """The event table as JSON texts, as a topic would hold them."""
    df = load(spark, sf_dir, "events")
    return df.select("event_id", F.to_json(F.struct(*df.columns), {"timestampNTZFormat": MICROS_TEXT}).alias("value"))


@query("src_json_stream", """
select event_id, ts, user_id, event_type, value, props from events
""")
def src_json_stream(spark, sf_dir):
    return rows.json_records(event_texts(spark, sf_dir).select("value"), "value", EVENT_JSON)


@query("src_start_position", """
select 'earliest' as position, count(*) as n from events
union all select 'timestamp', count(*) from events where ts >= timestamp '2024-01-10 00:00:00'
union all select 'committed', count(*) from events where event_id > 500
union all select 'latest', 0
""")
def src_start_position(spark, sf_dir):
    """Rows that each start position still gives, in one scan; ``latest`` gives none of the stored ones."""
    df = load(spark, sf_dir, "events")
    starts = {"earliest": F.lit(True), "timestamp": F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), "committed": F.col("event_id") > 500, "latest": F.lit(False)}
    counted = df.agg(*[F.count_if(c).alias(p) for p, c in starts.items()])
    return counted.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, starts)), F.array(*starts))).alias("position", "n"))


@query("src_declared_table", """
select strftime(ts, '%Y%m%d%H') as hour_text, event_type, count(*) as n, min(value) as low
from events group by 1, 2
""")
def src_declared_table(spark, sf_dir):
    typed = rows.json_records(event_texts(spark, sf_dir).select("value"), "value", EVENT_JSON + ", not_there STRING")
    name = f"declared_events_{uuid.uuid4().hex}"  # concurrent queries don't share it
    readers.declare_table(typed, name, "ts", "2 seconds")
    return spark.sql(f"""
        select date_format(ts, 'yyyyMMddHH') as hour_text, event_type, count(*) as n, min(value) as low
        from {name} where not_there is null group by 1, 2""")


ORDER_DDL = (
    "order_key BIGINT, priority_chars INT, customer STRUCT<key: STRING>,"
    " body STRUCT<key: STRING, notes: ARRAY<STRUCT<key: STRING, text: STRING>>, tags: ARRAY<STRUCT<key: STRING, label: STRING>>>"
)


def order_texts(spark, sf_dir):
    """Orders as nested JSON texts: one or two notes per order, two tags."""
    o = load(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    note = F.struct(key.alias("key"), F.col("o_orderpriority").alias("text"))
    second = F.struct(cust.alias("key"), F.col("o_orderstatus").alias("text"))
    notes = F.when(F.col("o_orderkey") % 2 == 0, F.array(note, second)).otherwise(F.array(note))
    tag = lambda k: F.struct(k.alias("key"), F.concat(F.lit("m"), k).alias("label"))
    body = F.struct(key.alias("key"), notes.alias("notes"), F.array(tag(cust), tag(key)).alias("tags"))
    record = F.struct(F.col("o_orderkey").alias("order_key"), F.length("o_orderpriority").alias("priority_chars"), F.struct(cust.alias("key")).alias("customer"), body.alias("body"))
    return o.select(F.to_json(record).alias("value"))


@query("src_ddl_nested", """
select o_orderkey as order_key, length(o_orderpriority)::int as priority_chars, o_orderkey::varchar as body_key,
       o_custkey::varchar as customer_key, case when o_orderkey % 2 = 0 then 2 else 1 end as notes
from orders
""")
def src_ddl_nested(spark, sf_dir):
    typed = rows.json_records(order_texts(spark, sf_dir), "value", ORDER_DDL)
    return typed.select("order_key", "priority_chars", F.col("body.key").alias("body_key"), F.col("customer.key").alias("customer_key"), F.size("body.notes").alias("notes"))


@query("proj_nested_json", """
select o_orderkey as order_key, length(o_orderpriority)::int as priority_chars, o_custkey::varchar as customer_key,
       o_orderkey::varchar as body_key, o_orderpriority as note_1_text,
       case when o_orderkey % 2 = 0 then o_custkey::varchar end as note_2_key,
       'm' || o_custkey::varchar as tag_1_label, o_orderkey::varchar as tag_2_key
from orders
""")
def proj_nested_json(spark, sf_dir):
    typed = rows.json_records(order_texts(spark, sf_dir), "value", ORDER_DDL)
    return typed.select(
        "order_key", "priority_chars", F.col("customer.key").alias("customer_key"), F.col("body.key").alias("body_key"),
        item_at("body.notes", 1)["text"].alias("note_1_text"), item_at("body.notes", 2)["key"].alias("note_2_key"),
        item_at("body.tags", 1)["label"].alias("tag_1_label"), item_at("body.tags", 2)["key"].alias("tag_2_key"),
    )


@query("src_csv", "select event_id, ts, user_id, event_type, value, props from events")
def src_csv(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    df = load(spark, sf_dir, "events")
    dialect = {"sep": "#", "lineSep": "$", "quote": "`", "header": "true", "timestampNTZFormat": MICROS_TEXT}
    df.write.options(**dialect).csv(path)
    return (
        spark.read.schema(df.schema)
        .options(**readers.csv_reader_options(sep="#", line_sep="$", quote="`", comment="%"))
        .option("timestampNTZFormat", MICROS_TEXT).csv(path)
    )


@query("src_parquet_projected", """
select l_returnflag, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem group by 1
""")
def src_parquet_projected(spark, sf_dir):
    narrow = readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet", "l_returnflag STRING, l_quantity DOUBLE")
    return narrow.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("src_values", """
select v.grp, e.event_type, count(*) as n
from events e join (values ('view', 'browse'), ('click', 'browse'), ('purchase', 'money')) v(event_type, grp)
  on e.event_type = v.event_type
group by 1, 2
""")
def src_values(spark, sf_dir):
    groups = spark.sql("select * from values ('view', 'browse'), ('click', 'browse'), ('purchase', 'money') as v(event_type, grp)")
    joined = load(spark, sf_dir, "events").join(F.broadcast(groups), "event_type")  # three literal rows
    return joined.groupBy("grp", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("src_text_lines", r"""
select length(line) as line_chars, count(*) as n
from (select unnest(string_split(text, chr(10))) as line from documents) group by 1
""")
def src_text_lines(spark, sf_dir):
    path = scratch_dir(spark, "lines")
    load(spark, sf_dir, "documents").select("text").write.option("lineSep", "\n").text(path)
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.groupBy(F.length("value").cast("bigint").alias("line_chars")).agg(F.count(F.lit(1)).alias("n"))


@query("src_catalog_table", """
select 'events' as source, count(*) as n from events union all select 'orders', count(*) from orders
""")
def src_catalog_table(spark, sf_dir):
    path = scratch_dir(spark, "catalog")
    name = "counts_" + path[-32:]
    spark.sql(f"create table {name} (source string, n bigint) using parquet location '{path}'")
    for table in ("events", "orders"):
        load(spark, sf_dir, table).createOrReplaceTempView(f"{name}_{table}")
        spark.sql(f"insert into {name} select '{table}', count(*) from {name}_{table}")
    rows = spark.read.schema(spark.table(name).schema).parquet(path)
    spark.sql(f"drop table {name}")  # external: its files stay for the result
    for table in ("events", "orders"):
        spark.catalog.dropTempView(f"{name}_{table}")
    return rows


@query("src_dirty_split", """
select event_id % 10 = 0 as is_dirty, count(*) as n, sum(case when event_id % 10 = 0 then 0 else user_id end)::bigint as users
from events group by 1
""")
def src_dirty_split(spark, sf_dir):
    texts = event_texts(spark, sf_dir)
    damaged = texts.withColumn("value", F.when(F.col("event_id") % 10 == 0, F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value")))
    parsed = rows.json_good_and_bad(damaged.select("value"), "value", EVENT_JSON)
    users = F.when(F.col("is_dirty"), 0).otherwise(F.col("user_id"))
    return parsed.groupBy("is_dirty").agg(F.count(F.lit(1)).alias("n"), F.sum(users).alias("users"))


@query("snk_delimited_encode", """
select event_id::varchar || ',' || user_id::varchar || ',' || event_type || ',' || (props::json->>'k') as value from events
""")
def snk_delimited_encode(spark, sf_dir):
    return events(spark, sf_dir).select(rows.delimited_line("event_id", "user_id", "event_type", "item_id").alias("value"))


@query("snk_upsert_changes", """
select strftime(ts, '%Y-%m-%d') as day_text, event_type, count(*) as pv from events group by 1, 2
""")
def snk_upsert_changes(spark, sf_dir):
    replay = event_replay(spark, sf_dir)
    counted = (  # refreshed by each micro-batch; days that the watermark has passed leave the state
        replayed_events(replay, "1 day").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("pv"))
        .select("w.start", "event_type", "pv").select(F.date_format(dated("start"), "yyyy-MM-dd").alias("day_text"), "event_type", "pv")
    )
    return run_to_changes(counted, ["day_text", "event_type"], "upsert", feed=replay)


def event_folder(sf_dir: str) -> str:
    """The event file as a glob, which a file stream accepts as its folder."""
    return f"{sf_dir}/events.parque[t]"


@query("snk_multi", """
select 'by_user' as target, user_id::varchar as k, count(*) as n from events group by 2
union all select 'by_item', props::json->>'k', count(*) from events group by 2
""")
def snk_multi(spark, sf_dir):
    path = scratch_dir(spark, "multi")
    def target(name, key):
        def write(batch, batch_id):
            out = batch.groupBy(F.col(key).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n"))
            out.withColumn("target", F.lit(name)).write.mode("overwrite").parquet(f"{path}/{name}")
        return write
    writers.write_targets(target("by_user", "user_id"), target("by_item", "item_id"))(events(spark, sf_dir), 0)
    return spark.read.schema("k STRING, n BIGINT, target STRING").parquet(f"{path}/by_user", f"{path}/by_item")


@query("snk_rolling_files", """
select event_id, ts, user_id, strftime(ts, '%Y-%m-%d-%H') as bucket from events
""")
def snk_rolling_files(spark, sf_dir):
    path = scratch_dir(spark, "rolling")
    writers.write_time_buckets(load(spark, sf_dir, "events").select("event_id", "ts", "user_id"), "ts", path, "json", timestampNTZFormat=MICROS_TEXT)
    return spark.read.schema("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, bucket STRING").json(path)


@query("snk_parquet_bucketed", """
select event_id, ts, event_type, value, strftime(ts, '%Y-%m-%d') as bucket from events
""")
def snk_parquet_bucketed(spark, sf_dir):
    path = scratch_dir(spark, "buckets")
    replay = event_replay(spark, sf_dir)
    source = replayed_events(replay).select("event_id", "ts", "event_type", "value").withColumn("bucket", F.date_format("ts", "yyyy-MM-dd"))
    parts = F.pmod(F.xxhash64("event_id"), F.lit(4))  # at most four files per bucket and micro-batch, no bucket in one task
    run_to_files(source.repartition("bucket", parts), path, partition="bucket", feed=replay)
    back = spark.read.schema("event_id BIGINT, ts TIMESTAMP, event_type STRING, value DOUBLE, bucket STRING").parquet(path)
    return back.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("snk_csv", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders")
def snk_csv(spark, sf_dir):
    path = scratch_dir(spark, "csv-out")
    orders = load(spark, sf_dir, "orders")
    orders.write.option("timestampNTZFormat", MICROS_TEXT).csv(path)
    return spark.read.schema(orders.schema).option("timestampNTZFormat", MICROS_TEXT).csv(path)


@query("snk_batch_or_interval", """
select chunk_id, count(*) as n, min(event_id) as first_id, max(event_id) as last_id
from (select event_id, ((row_number() over (order by ts, event_id) - 1) // 10)::bigint as chunk_id from events)
group by 1
""")
def snk_batch_or_interval(spark, sf_dir):
    chunks = writers.flush_chunks(load(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 10)
    return chunks.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("snk_latest_kv", """
with v as (select strftime(l_shipdate, '%Y%m%d') as day, l_suppkey, count(*) as n, sum(l_quantity)::bigint as q from lineitem group by 1, 2, l_orderkey % 5),
s as (select *, row_number() over (partition by day, l_suppkey order by n, q) as version, sum(n) over w as sub_orders, (sum(q) over w)::bigint as quantity
      from v window w as (partition by day, l_suppkey order by n, q rows unbounded preceding))
select day || ':SITES' as hash, l_suppkey::varchar as field, '{"site_id":' || l_suppkey || ',"sub_orders":' || sub_orders || ',"quantity":' || quantity || '}' as value
from s qualify row_number() over (partition by day, l_suppkey order by version desc) = 1
""")
def snk_latest_kv(spark, sf_dir):
    """Each key is written several times with growing totals; the last version wins.

    Lines are added up in shares of a key first, so a frequent key is in no single task, then by key. Both shuffles have a task per
    ``TASK_ROWS`` lines; versions and the last one are found where the second put the key's pieces, and its text is made last.
    """
    lines = load(spark, sf_dir, "lineitem")
    tasks, key = task_count(lines), ["day", "l_suppkey"]
    share = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_quantity"), F.lit(8 * tasks)).alias("share")
    li = lines.select(F.date_format("l_shipdate", "yyyyMMdd").alias("day"), "l_suppkey", (F.col("l_orderkey") % 5).alias("piece"), share, "l_quantity")
    shares = li.repartition(tasks, *key, "piece", "share").groupBy(*key, "piece", "share").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    pieces = shares.repartition(tasks, *key).groupBy(*key, "piece").agg(F.sum("n").alias("n"), F.sum("q").cast("bigint").alias("q"))
    sofar = Window.partitionBy(*key).orderBy("n", "q").rowsBetween(Window.unboundedPreceding, 0)  # few pieces
    versions = pieces.select(*key, F.sum("n").over(sofar).alias("sub_orders"), F.sum("q").over(sofar).alias("quantity"))
    last = writers.latest_per_key(versions, key, ["sub_orders"], ["sub_orders", "quantity"])
    value = writers.json_value(F.col("l_suppkey").alias("site_id"), "sub_orders", "quantity")
    return last.select(F.concat("day", F.lit(":SITES")).alias("hash"), F.col("l_suppkey").cast("string").alias("field"), value.alias("value"))


@query("snk_rolling_parts", """
select event_id, ts, user_id, strftime(ts, '%Y-%m-%d') as bucket from events
""")
def snk_rolling_parts(spark, sf_dir):
    """Files rolled at 8 kB, 12 hours of age or 3 hours without a row, read back."""
    path = scratch_dir(spark, "rolling-parts")
    writers.write_rolling(load(spark, sf_dir, "events").select("event_id", "ts", "user_id"), "ts", "event_id", path, 8_000, "12 hours", "3 hours", "yyyy-MM-dd",
                          timestampNTZFormat=MICROS_TEXT)
    back = writers.read_rolling(spark, path, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, bucket STRING")
    return back.withColumn("bucket", F.nullif("bucket", F.lit("none")))


SPAN = "(epoch_us(ts) - min(epoch_us(ts)) over ()) // ((max(epoch_us(ts)) over () - min(epoch_us(ts)) over ()) // 4 + 1)"


@query("src_start_position_stream", f"""
with e as (select *, {SPAN} as b from events)
select 'earliest' as position, count(*) as n from e union all select 'timestamp', count(*) from e where ts >= timestamp '2024-01-10 00:00:00'
union all select 'committed', count(*) from e where b >= 2 union all select 'latest', count(*) from e where b >= 2
""")
def src_start_position_stream(spark, sf_dir):
    """Four streams over one folder that grows by four parts: from its start, from a time, from a committed position (the checkpoint of a run that
    saw two parts), and from what comes after the start (two parts are there)."""
    replay = event_replay(spark, sf_dir)
    out = {p: scratch_dir(spark, f"from-{p}") for p in ("earliest", "timestamp", "committed", "latest")}
    marks = {p: scratch_dir(spark, f"mark-{p}") for p in out}

    def run(position, path, start=None):
        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{path}/batch-{batch_id}")

        stream = readers.from_start(replay.stream(), position, replay.folder, marks[position], ts="ts", start=start)
        run_batches(stream.select("event_id"), write, marks[position])

    for i in replay:
        if i == 1:
            run("committed", scratch_dir(spark, "before-commit"))
            readers.mark_start(spark, replay.folder, marks["latest"])
    run("earliest", out["earliest"])
    run("timestamp", out["timestamp"], "2024-01-10 00:00:00")
    run("committed", out["committed"])
    run("latest", out["latest"])
    counts = [spark.read.schema("event_id BIGINT").option("recursiveFileLookup", "true").parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(p).alias("position"), "n") for p, path in out.items()]
    return reduce(DataFrame.unionByName, counts)
