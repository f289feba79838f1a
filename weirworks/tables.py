"""Loaders for the input tables, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weirworks.functions.expr import json_int
from weirworks.session import pin_utc
from weirworks.streaming.replay import Replay

SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
              " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
                " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING,"
                " l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    """The event table, optionally only the given event types, with ``item_id`` from ``props``."""
    df = load(spark, sf_dir, "events")
    if types:
        df = df.filter(F.col("event_type").isin(*types))
    return df.withColumn("item_id", json_int("props", "$.k"))


SPANS = 4
#: Event time of rows without one, on streams with a watermark: before all others, but not before the epoch, where watermarks start.
#: ``dated`` gives NULL back for it, so such streams take times from 1972 on.
UNDATED = "1970-06-01 00:00:00"


def event_spans(spark: SparkSession, sf_dir: str, spans: int = SPANS) -> list[DataFrame]:
    """The event table cut into equal time spans; rows without a time are in the first."""
    e = load(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = e.agg(F.min(us), F.max(us)).first()
    width = max(1, ((hi or 0) - (lo or 0)) // spans + 1)
    span = F.coalesce(F.floor((us - F.lit(lo or 0)) / F.lit(width)), F.lit(0))
    return [e.filter(span == i) for i in range(spans)]


def event_replay(spark: SparkSession, sf_dir: str, spans: int = SPANS) -> Replay:
    """The event table as a stream in time order, one micro-batch per time span."""
    return Replay(event_spans(spark, sf_dir, spans), "event-replay")


def replayed_events(replay: Replay, delay: str | None = None) -> DataFrame:
    """Streamed events; with ``delay`` there is a watermark, and rows without a time get UNDATED."""
    df = replay.stream().withColumn("ts", F.col("ts").cast("timestamp")).withColumn("item_id", json_int("props", "$.k"))
    return df.withColumn("ts", F.coalesce("ts", F.lit(UNDATED).cast("timestamp"))).withWatermark("ts", delay) if delay else df


def dated(time: str) -> Column:
    """NULL for times that windows make of UNDATED."""
    return F.when(F.col(time) > F.lit(UNDATED).cast("timestamp") + F.expr("interval 1 year"), F.col(time))


def stream_events(spark: SparkSession, folder: str, delay: str | None = None, files_per_batch: int = 1) -> DataFrame:
    """The event table as a stream: a folder of parquet files, ``ts`` cast to TIMESTAMP for watermarks."""
    pin_utc(spark)
    df = (
        spark.readStream.schema(SCHEMAS["events"])
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", "*.parquet")
        .parquet(folder)
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .withColumn("item_id", json_int("props", "$.k"))
    )
    return df.withWatermark("ts", delay) if delay else df
