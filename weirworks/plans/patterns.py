"""Queries of event patterns and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirworks.operators import patterns
from weirworks.operators.joins import asof_join
from weirworks.operators.ordered import Ordered, previous
from weirworks.operators.patterns import Rule
from weirworks.plans.registry import query
from weirworks.session import scratch_dir
from weirworks.streaming.rules import with_rules
from weirworks.streaming.runner import run_batches, run_to_files
from weirworks.tables import event_replay, events, load, replayed_events


@query("cep_single", """
select event_id, event_type, value from events where event_type = 'error' and (props::json->>'k')::double > 15
""")
def cep_single(spark, sf_dir):
    condition = patterns.holds("event_type = 'error' and item_id > 15")
    return events(spark, sf_dir).filter(condition).select("event_id", "event_type", "value")


@query("cep_followed_by", """
select user_id, event_id as view_id, p.id as purchase_id, p.v as amount from (
  select *, (select arg_min({'id': b.event_id, 'v': b.value}, b.ts) from events b where b.user_id = a.user_id and b.event_type = 'purchase' and b.ts > a.ts) as p
  from events a where event_type = 'view') where p is not null
""")
def cep_followed_by(spark, sf_dir):
    e = events(spark, sf_dir, "view", "purchase").select("user_id", "event_id", "ts", "event_type", "value")
    purchase = F.struct(F.col("event_id").alias("id"), F.col("value").alias("v"))
    pairs = patterns.followed_by(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "view", F.col("event_type") == "purchase", purchase, "p")
    return pairs.select("user_id", F.col("event_id").alias("view_id"), F.col("p.id").alias("purchase_id"), F.col("p.v").alias("amount"))


@query("cep_dynamic_pattern", """
with l as (select *, lag(event_type) over w as p1, lag(event_type, 2) over w as p2, lag(value) over w as v1 from events window w as (partition by user_id order by ts, event_id))
select user_id, event_id, 'browse_buy' as pattern from l where p2 = 'view' and p1 = 'click' and event_type = 'purchase'
union all select user_id, event_id, 'double_error' from l where p1 = 'error' and event_type = 'error'
union all select user_id, event_id, 'rising' from l where v1 > 50 and value > 100
""")
def cep_dynamic_pattern(spark, sf_dir):
    table = spark.sql("""select * from values
        ('browse_buy', 1, "event_type = 'view'"), ('browse_buy', 2, "event_type = 'click'"), ('browse_buy', 3, "event_type = 'purchase'"),
        ('double_error', 1, "event_type = 'error'"), ('double_error', 2, "event_type = 'error'"),
        ('rising', 1, 'value > 50'), ('rising', 2, 'value > 100') as p(name, step, predicate)""")
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return patterns.match_patterns(e, ["user_id"], ["ts", "event_id"], patterns.read_patterns(table)).select("user_id", "event_id", "pattern")


@query("broadcast_pattern_pair", """
with l as (select *, lag(event_type) over (partition by user_id order by ts, event_id) as p from events),
a as (select ts, arg_max(case when value < 60 then 'view,purchase' else 'click,error' end, event_id) as pair from events where event_type = 'signup' group by 1)
select user_id, event_id, p as first_action, event_type as second_action from l asof join a on l.ts >= a.ts where p || ',' || event_type = pair
""")
def broadcast_pattern_pair(spark, sf_dir):
    """Pairs of actions that match the pattern in force; signups announce the patterns."""
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    pair = F.when(F.col("value") < 60, "view,purchase").otherwise("click,error")
    announced = e.filter("event_type = 'signup'").select(F.col("ts").alias("since"), F.col("event_id").alias("pattern_id"), pair.alias("pair"))
    scanned = Ordered(e, ["user_id"], ["ts", "event_id"]).scan(first_action=previous("event_type")).result()
    known = asof_join(scanned, announced, [], "ts", "event_id", "since", "pattern_id", ["pair"])
    found = known.filter(F.concat(F.col("first_action"), F.lit(","), F.col("event_type")) == F.col("pair"))
    return found.select("user_id", "event_id", "first_action", F.col("event_type").alias("second_action"))


RULE_ROWS = """select * from values
    ('low', 'c_acctbal < 2000', "concat(c_custkey, ' is under 2000')"),
    ('high', 'c_acctbal >= 2000', "concat(c_custkey, ' is above 2000')"),
    ('building', "c_mktsegment = 'BUILDING'", "upper(c_name)") as r(rule_id, predicate, result)"""


@query("rules_apply", """
select c_custkey, 'low' as rule_id, c_custkey || ' is under 2000' as result from customer where c_acctbal < 2000
union all select c_custkey, 'high', c_custkey || ' is above 2000' from customer where c_acctbal >= 2000
union all select c_custkey, 'building', upper(c_name) from customer where c_mktsegment = 'BUILDING'
""")
def rules_apply(spark, sf_dir):
    rules = patterns.read_rules(spark.sql(RULE_ROWS))
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return patterns.apply_rules(customers, rules).select("c_custkey", "rule_id", "result")


SWAP_SQL = """
with e as (select event_id, ts, (props::json->>'k')::int as k from events),
a as (select ts, arg_max(floor(value)::bigint, event_id) as lim from events where event_type = 'signup' group by 1),
f as (select e.*, coalesce(a.lim, 18) as lim from e asof left join a on e.ts >= a.ts)
select event_id, case when k >= lim then 'above' else 'under' end as rule_id, k || ' is ' || case when k >= lim then 'above ' else 'under ' end || lim as result from f
"""


@query("rules_broadcast_swap", SWAP_SQL)
def rules_broadcast_swap(spark, sf_dir):
    """Two rules whose limit is the one in force at the row's time; signups announce new limits, 18 holds before the first."""
    e = events(spark, sf_dir).select("event_id", "ts", "item_id", "event_type", "value")
    announced = e.filter("event_type = 'signup'").select(F.col("ts").alias("since"), F.col("event_id").alias("rule_set"), F.floor("value").alias("lim"))
    known = asof_join(e, announced, [], "ts", "event_id", "since", "rule_set", ["lim"], how="left").withColumn("lim", F.coalesce("lim", F.lit(18)))
    return limited_rules(known)


def limited_rules(known):
    """Two rules of the limit ``lim``."""
    rules = [Rule("above", "item_id >= lim", "concat(item_id, ' is above ', lim)"), Rule("under", "item_id < lim", "concat(item_id, ' is under ', lim)")]
    return patterns.apply_rules(known, rules).select("event_id", "rule_id", "result")


@query("rules_broadcast_swap_stream", SWAP_SQL + " where ts is not null")
def rules_broadcast_swap_stream(spark, sf_dir):
    """The same with two streams: signups announce limits, and events meet the limit in force at their time, swaps inside a micro-batch included."""
    replay, log, out = event_replay(spark, sf_dir), scratch_dir(spark, "limits"), scratch_dir(spark, "limited")
    timed = replayed_events(replay).filter("ts is not null")
    limits = timed.filter("event_type = 'signup'").select(F.col("ts").alias("since"), F.col("event_id").alias("rule_set"), F.floor("value").alias("lim"))
    checkpoint = scratch_dir(spark, "limits-checkpoint")

    def feed():
        for i in replay:
            run_to_files(limits, log, checkpoint)
            yield i

    write = with_rules(log, limits.schema, [], "ts", "event_id", "since", "rule_set", ["lim"], lambda df: limited_rules(df.withColumn("lim", F.coalesce("lim", F.lit(18)))), out)
    run_batches(timed.select("event_id", "ts", "item_id"), write, feed=feed())
    return spark.read.schema("event_id BIGINT, rule_id STRING, result STRING").parquet(out).drop("batch_id")
