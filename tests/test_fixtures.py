"""Small exact cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import rows
from weirworks.functions import expr as X
from weirworks.operators import aggs, analytic, dedup, greedy, joins, patterns, ranking, rows as R, timers, triggers, windows
from weirworks.operators.patterns import Rule
from weirworks.sources import readers


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def ms(n: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=n)


def numbered(spark, values):
    return spark.createDataFrame([(i, ms(i), v, "all") for i, v in enumerate(values)], "id BIGINT, ts TIMESTAMP_NTZ, value INT, k STRING")


@pytest.mark.parametrize("values,side", [([17, 18, 19, 16], [16, 17]), (list(range(15, 21)), [15, 16, 17])])
def test_side_output(spark, values, side):
    out = R.tagged_fan_out(spark.createDataFrame([(v,) for v in values], "value INT"), F.col("value") < 18)
    assert [v for v, o in rows(out) if o == "main"] == sorted(values)
    assert [v for v, o in rows(out) if o == "side"] == side


@pytest.mark.parametrize("values,want", [
    ([*range(1, 11), 9, 10], [*range(1, 11), 10, 10]),
    ([121, 122, 123, 122, 131, 121], [1, 2, 3, 3, 4, 4]),
    ([1, 2, 3, 4, 5, 4, 5], [1, 2, 3, 4, 5, 5, 5]),
])
def test_running_distinct(spark, values, want):
    df = numbered(spark, values)
    assert [n for _, n in rows(aggs.running_distinct(df, ["k"], ["ts", "id"], "value", "n"), "id", "n")] == want
    assert rows(aggs.bitmap_distinct(df, ["k"], "value", "n")) == [("all", want[-1])]
    assert rows(aggs.exact_distinct(df, ["k"], "value", "n")) == [("all", want[-1])]


def test_upper(spark):
    df = spark.createDataFrame([("abc",), ("Azd",), ("baT",)], "s STRING")
    assert rows(df.select(X.strict_upper("s"))) == [("ABC",), ("AZD",), ("BAT",)]
    with pytest.raises(Exception, match="blank"):
        spark.createDataFrame([("  ",)], "s STRING").select(X.strict_upper("s")).collect()


@pytest.mark.parametrize("bucketed", [False, True])
def test_interval_join(spark, bucketed):
    order_s = [10, 15, 20, 20, 20, 20, 30, 30, 40, 50]
    ship = ["16:00:10", "17:00:15", "18:00:20", "19:00:21", "15:00:20", "16:00:20", "17:00:30", "18:00:30", "14:00:41", "11:00:49"]
    orders = spark.createDataFrame([(str(10000 + i), at(f"2017-12-18 15:00:{s:02d}")) for i, s in enumerate(order_s)], "id STRING, order_ts TIMESTAMP_NTZ")
    ships = spark.createDataFrame([(str(10000 + i), at(f"2017-12-18 {t}")) for i, t in enumerate(ship)], "id STRING, ship_ts TIMESTAMP_NTZ")
    out = joins.interval_join(ships, orders, ["id"], "ship_ts", "order_ts", "-4 hours", "0 hours", bucketed=bucketed)
    assert [r[0] for r in rows(out, "id")] == ["10000", "10001", "10002", "10004", "10005", "10006", "10007"]


def test_interval_join_payments(spark):
    orders = spark.createDataFrame([("001", ms(1545800002000)), ("002", ms(1545800003000)), ("003", ms(1545800004000)), ("004", ms(1545800018000))], "id STRING, ots TIMESTAMP_NTZ")
    paid = spark.createDataFrame([("001", ms(1545803501000)), ("002", ms(1545803602000)), ("003", ms(1545803610000)), ("004", ms(1545803611000))], "id STRING, pts TIMESTAMP_NTZ")
    assert [r[0] for r in rows(joins.interval_join(orders, paid, ["id"], "ots", "pts", "0 hours", "1 hour"), "id")] == ["001", "002", "004"]


def test_asof(spark):
    orders = spark.createDataFrame([(2, "Euro", ms(2), 1), (1, "US Dollar", ms(3), 2), (50, "Yen", ms(4), 3), (3, "Euro", ms(5), 4)], "amount BIGINT, currency STRING, ots TIMESTAMP_NTZ, oid BIGINT")
    history = spark.createDataFrame([("US Dollar", 102, ms(1), 1), ("Euro", 114, ms(1), 2), ("Yen", 1, ms(1), 3), ("Euro", 116, ms(5), 4), ("Euro", 119, ms(7), 5)], "currency STRING, rate BIGINT, rts TIMESTAMP_NTZ, rid BIGINT")
    for limit in (None, 1):
        out = joins.asof_join(orders, history, ["currency"], "ots", "oid", "rts", "rid", ["rate"], slices=limit)
        assert rows(out, "currency", "amount", "rate") == [("Euro", 2, 114), ("Euro", 3, 116), ("US Dollar", 1, 102), ("Yen", 50, 1)]


def test_asof_by_subquery(spark, tmp_path):
    (tmp_path / "r.csv").write_text("rowtime ,currency   ,rate\n09:00:00   ,US Dollar  , 102\n09:00:00   ,Euro       , 114\n09:00:00  ,Yen        ,   1\n10:45:00   ,Euro       , 116\n11:15:00   ,Euro       , 119\n11:49:00   ,Pounds     , 108\n")
    readers.read_csv(spark, str(tmp_path), "rowtime STRING, currency STRING, rate STRING").selectExpr("trim(rowtime) rowtime", "trim(currency) currency", "trim(rate) rate").createOrReplaceTempView("RatesHistory")
    out = spark.sql("select * from RatesHistory as r where r.rowtime = (select max(rowtime) from RatesHistory as r2 where r2.currency = r.currency and r2.rowtime <= '10:58:00')")
    assert rows(out) == [("09:00:00", "US Dollar", "102"), ("09:00:00", "Yen", "1"), ("10:45:00", "Euro", "116")]


def test_cube(spark):
    s = [("springy", "3C", "phone", p) for p in (4000, 3000, 4000)] + [("springy", "3C", "computer", p) for p in (10000, 8000)]
    s += [("springy", "clothes", "shoes", 300), ("springy", "clothes", "shoes", 400), ("springy", "clothes", "pants", 500)]
    s += [("stephenson", "clothes", i, p) for i, p in (("shoes", 200), ("shoes", 300), ("skirt", 300), ("skirt", 400))]
    out = aggs.cube_with_flags(spark.createDataFrame(s, "name STRING, class STRING, item STRING, price INT"), ["name", "class", "item"], total=F.sum("price"))
    assert out.count() == 30
    assert rows(out.filter("g_name = 1 and g_class = 1 and g_item = 1"), "total") == [(31400,)]
    assert rows(out.filter("g_name = 0 and g_class = 1 and g_item = 1"), "name", "total") == [("springy", 30200), ("stephenson", 1200)]


@pytest.mark.parametrize("limit", [None, 2])
def test_bounded_session(spark, limit):
    data = [("sensor_1", ms(s * 1000), i, t) for i, (s, t) in enumerate([(10, 78.0), (14, 78.0), (18, 78.0), (22, 88.0), (26, 88.0), (30, 88.0)])]
    df = spark.createDataFrame(data, "id STRING, ts TIMESTAMP_NTZ, n BIGINT, f DOUBLE").withColumn("c", R.to_celsius("f"))
    out = greedy.bounded_sessions(df, ["id"], "ts", "n", "5 seconds", "10 seconds", limit)
    got = out.groupBy("anchor_ts").agg((F.max(X.micros("ts")) / 1000 + 5000).cast("int").alias("end"), F.round(F.max("c"), 4).alias("max"))
    assert rows(got.select((X.micros("anchor_ts") / 1000).cast("int"), "end", "max")) == [(10000, 19000, 25.5556), (18000, 27000, 31.1111), (26000, 35000, 31.1111)]


def test_far_apart_transactions(spark):
    d = "2018-10-05 "
    t = [("ac_01", "01", 20, 38.6956033, -121.5922283, "16:56:08"), ("ac_02", "02", 400, 37.766319, -122.417422, "16:56:08"), ("ac_03", "04", 50, 37.5522855, -121.9797997, "16:56:08"),
         ("ac_02", "03", 40, 37.766319, -122.417422, "17:01:59"), ("ac_03", "X05", 500, 33.5522855, -120.9797997, "17:01:59")]
    df = spark.createDataFrame([(a, i, m, la, lo, at(d + c)) for a, i, m, la, lo, c in t], "account STRING, id STRING, amount INT, lat DOUBLE, lon DOUBLE, ts TIMESTAMP_NTZ")
    a, b = (df.select("account", *[F.col(c).alias(f"{c}{n}") for c in ("id", "lat", "lon", "ts")]) for n in (1, 2))
    pairs = joins.interval_join(a, b, ["account"], "ts1", "ts2", "0 minutes", "10 minutes", bucketed=True)
    moved = (F.col("id1") != F.col("id2")) & ((F.col("lat1") != F.col("lat2")) | (F.col("lon1") != F.col("lon2")))
    out = pairs.filter(moved & (F.col("ts1") != F.col("ts2"))).select(
        "account", "id1", "id2", X.seconds_between("ts1", "ts2").alias("s"), (X.great_circle_m("lat1", "lon1", "lat2", "lon2") / 1000).alias("km"))
    (r,) = out.collect()
    assert (r.account, r.id1, r.id2, r.s) == ("ac_03", "04", "X05", 351)
    assert r.km == pytest.approx(454.3858) and r.km * 3600 / r.s == pytest.approx(4660.37, abs=0.01)
    (near,) = spark.range(1).select(X.great_circle_m(F.lit(34.267556), F.lit(108.953475), F.lit(34.246432), F.lit(108.953475)).alias("m")).collect()
    assert near.m == pytest.approx(2351.5)


def test_row_number(spark):
    df = spark.createDataFrame([("A", s, ms(i + 1)) for i, s in enumerate([70.0, 80.0, 60.0, 90.0, 80.0, 70.0])], "name STRING, score FLOAT, ts TIMESTAMP_NTZ")
    assert [r for _, r in rows(analytic.row_numbers(df, ["name"], ["ts"]), "ts", "rn")] == [1, 2, 3, 4, 5, 6]


def test_favourite_colour(spark):
    df = spark.createDataFrame([("Jack", "red", 1), ("Rose", "green", 2), ("Jack", "yellow", 3), ("Bob", "red", 4), ("Rose", "yellow", 5), ("Bob", "green", 6)], "name STRING, colour STRING, ts BIGINT")
    assert rows(aggs.latest_then_count(df, "name", "colour", ["ts"], "n")) == [("green", 1), ("yellow", 2)]


def test_top_per_area(spark):
    t = [("gdsId01", 500.0, 1573483405000), ("gdsId02", 200.0, 1573483408000), ("gdsId03", 300.0, 1573483408000), ("gdsId04", 400.0, 1573483408000), ("gdsId01", 600.0, 1573483600000)]
    df = spark.createDataFrame([("beijing", g, a, ms(m)) for g, a, m in t], "area STRING, item STRING, amount DOUBLE, ts TIMESTAMP_NTZ")
    sums = windows.windowed(df, "ts", "10 minutes", keys=["area", "item"], total=F.sum("amount"))
    top = ranking.top_n(sums, ["window_start", "area"], [F.col("total").desc(), F.col("item")], 3)
    assert rows(top, "rank", "item", "total") == [(1, "gdsId01", 1100.0), (2, "gdsId04", 400.0), (3, "gdsId03", 300.0)]


def test_total_top(spark):
    t = [("gdsId03", 300.0), ("gdsId01", 100.0), ("gdsId04", 200.0), ("gdsId02", 500.0), ("gdsId01", 300.0), ("gdsId02", 1500.0), ("gdsId03", 2000.0)]
    df = spark.createDataFrame([("beijing", g, a) for g, a in t], "area STRING, item STRING, amount DOUBLE")
    assert rows(ranking.total_top_n(df, "area", "item", "amount", 3), "rank", "item", "total") == [(1, "gdsId03", 2300.0), (2, "gdsId02", 2000.0), (3, "gdsId01", 400.0)]


def test_continuous(spark):
    lines = spark.createDataFrame([("orderId03,1573963096000,gdsId03,300,beijing",), ("orderId03,1573963156000,gdsId03,200,hangzhou",)], "line STRING")
    df = R.parse_delimited(lines, "line", {"id": "string", "ms": "bigint", "item": "string", "amount": "bigint", "area": "string"})
    df = df.withColumn("ts", F.timestamp_millis("ms").cast("timestamp_ntz"))
    out = triggers.continuous_results(df, ["area"], "ts", "1 hour", "1 minute", total=F.sum("amount"))
    assert rows(out, "area", "total") == [("beijing", 300), ("hangzhou", 200)]


@pytest.mark.parametrize("limit", [None, 2])
def test_per_element_with_lateness(spark, limit):
    t = [("aa", 80), ("aa", 85), ("bb", 90), ("bb", 89), ("aa", 96), ("bb", 97), ("aa", 80), ("bb", 80), ("bb", 98), ("aa", 80)]
    df = spark.createDataFrame([(i, w, ms(1562419000000 + s * 1000)) for i, (w, s) in enumerate(t)], "id BIGINT, word STRING, ts TIMESTAMP_NTZ")
    ok = triggers.accepted_rows(df, ["id"], "ts", "10 seconds", "6 seconds", "2 seconds", limit)
    out = triggers.per_element_counts(ok, ["word"], ["id"], slices=limit)
    base = 1562419000
    final = out.groupBy("word", (X.micros("window_start") / 10**6 - base).cast("int").alias("s")).agg(F.max("n").alias("n"))
    assert out.count() == 9
    assert rows(final) == [("aa", 80, 3), ("aa", 90, 1), ("bb", 80, 2), ("bb", 90, 3)]


def test_lateral(spark):
    data = spark.createDataFrame([("Sunny#8",), ("Kevin#36",), ("Panpan#36",), ("none",)], "data STRING")
    assert rows(R.split_pair(data, "data", "#", "name", "age")) == [("Kevin", "36"), ("Panpan", "36"), ("Sunny", "8")]
    held = spark.createDataFrame([("Alice", ["a", "b"]), ("Bob", ["c", "d", "e"]), ("Charlie", ["f"])], "name STRING, positions ARRAY<STRING>")
    assert R.unnest(held, "positions", "position").count() == 6


def test_nested_json(spark):
    layout = (
        "search_time BIGINT, code INT, results STRUCT<id: STRING, items: ARRAY<STRUCT<id: STRING, name: STRING, title: STRING,"
        " url: STRING, publish_time: BIGINT, score: FLOAT>>, metas: ARRAY<STRUCT<id: STRING, name: STRING>>>, requests STRUCT<id: STRING>"
    )

    text = '{"search_time":1,"code":200,"results":{"id":"r","items":[{"id":"i1","name":"n1"}],"metas":[{"id":"m1","name":"a"},{"id":"m2","name":"b"}]},"requests":{"id":"q"}}'
    t = R.json_records(spark.createDataFrame([(text,)], "value STRING"), "value", layout)
    out = t.select("search_time", "code", "requests.id", "results.id", X.item_at("results.items", 1)["name"], X.item_at("results.items", 2)["id"], X.item_at("results.metas", 2)["id"])
    assert rows(out) == [(1, 200, "q", "r", "n1", None, "m2")]


def test_rules(spark):
    people = spark.createDataFrame([("p1", 8), ("p2", 10), ("p3", 18), ("p4", 15), ("p5", 25)], "name STRING, age INT")
    rules = [Rule("1", "age >= 18", "concat(age, ' is above 18 age')"), Rule("2", "age < 18", "concat(age, ' is under 18 age')")]
    assert rows(patterns.apply_rules(people, rules), "name", "result") == [
        ("p1", "8 is under 18 age"), ("p2", "10 is under 18 age"), ("p3", "18 is above 18 age"), ("p4", "15 is under 18 age"), ("p5", "25 is above 18 age")]


def test_too_many_rules_are_refused(spark):
    many = spark.range(patterns.MAX_RULES + 1).selectExpr("cast(id as string) rule_id", "'true' predicate", "'1' result")
    with pytest.raises(ValueError, match="more than"):
        patterns.read_rules(many)


def test_stock_filter(spark):
    df = spark.createDataFrame([("IBM", 700.0, 100), ("WSO2", 60.5, 200), ("GOOG", 50.0, 30), ("IBM", 76.6, 400), ("WSO2", 45.6, 50)], "symbol STRING, price DOUBLE, volume BIGINT")
    assert rows(df.filter("volume < 150").select("symbol", "price")) == [("GOOG", 50.0), ("IBM", 700.0), ("WSO2", 45.6)]


def test_csv_dialect(spark, tmp_path):
    (tmp_path / "rates.csv").write_text("ts#currency#rate$`t1`#Euro#114$% a comment$t2#Yen#x$t3#US Dollar#102$")
    out = readers.read_csv(spark, str(tmp_path), "ts STRING, currency STRING, rate INT", sep="#", line_sep="$", quote="`", comment="%")
    assert rows(out) == [("t1", "Euro", 114), ("t3", "US Dollar", 102)]


def test_count_after_silence(spark):
    keys = ["aaa"] * 5 + ["bbb"] + ["ccc"] * 3
    df = spark.createDataFrame([(i, k, ms(i * 100)) for i, k in enumerate(keys)], "id BIGINT, k STRING, ts TIMESTAMP_NTZ")
    assert rows(timers.counts_after_silence(df, ["k"], "ts", "id", "60 seconds"), "k", "n") == [("aaa", 5), ("bbb", 1), ("ccc", 3)]


def test_dedup_ttl_boundary(spark):
    df = spark.createDataFrame([(i, "a", ms(s * 1000)) for i, s in enumerate([0, 4, 5, 9, 10, 16])], "id BIGINT, k STRING, ts TIMESTAMP_NTZ")
    kept = rows(dedup.drop_repeats(df, ["k"], "ts", "id", "5 seconds"), "id")
    assert kept == [(0,), (2,), (4,), (5,)]


def test_weighted_average_truncates(spark):
    df = spark.createDataFrame([("a", -7, 1), ("a", 0, 1), ("b", 5, 0)], "k STRING, v BIGINT, w BIGINT")
    assert rows(df.groupBy("k").agg(aggs.weighted_average("v", "w"))) == [("a", -3), ("b", None)]


def test_lookup_modes(spark):
    left = spark.createDataFrame([(1,), (2,)], "k BIGINT")
    dim = spark.createDataFrame([(1, 10)], "k BIGINT, a BIGINT")
    assert rows(joins.lookup(left, dim, ["k"])) == [(1, 10)]
    assert rows(joins.lookup(left, dim, ["k"], "left", {"a": 0})) == [(1, 10), (2, 0)]
    assert rows(joins.lookup(left, dim, ["k"], "flag"), "k", "lookup_failed") == [(1, False), (2, True)]


def test_kafka_options():
    assert readers.kafka_options("h:1", "t", "timestamp", 5)["startingTimestamp"] == "5"
    assert "startingOffsets" not in readers.kafka_options("h:1", "t", "committed")
    with pytest.raises(ValueError):
        readers.kafka_options("h:1", "t", "middle")
