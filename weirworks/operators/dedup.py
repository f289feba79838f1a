"""Deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from weirworks.operators.greedy import first_per_ttl
from weirworks.operators.triggers import accepted_rows
from weirworks.streaming import stateful


def drop_repeats(df: DataFrame, keys: Sequence[str], ts: str, tie: str, ttl: str, slices: int | None = None) -> DataFrame:
    """Drops repeats of a key within ``ttl`` after the last row that was kept: the same rows on a stream (rows later than ``ttl`` aside)."""
    if df.isStreaming:
        return stateful.first_per_ttl(df.withWatermark(ts, ttl), keys, ts, tie, ttl)
    return first_per_ttl(df, keys, ts, tie, ttl, slices)


def distinct_per_window(df: DataFrame, keys: Sequence[str], member: str, ts: str, size: str, out: str,
                        arrival: Sequence[str] | None = None, delay: str = "0 seconds", lateness: str = "0 seconds") -> DataFrame:
    """Distinct members per key and window. On streams each member is passed on once and counted downstream, and the watermark
    drops late rows; over stored rows ``arrival`` gives their order of arrival, and rows of windows that the watermark has passed are dropped."""
    if arrival and not df.isStreaming:
        df = accepted_rows(df, arrival, ts, size, delay, lateness)
    once = df.withColumn("w", F.window(ts, size)).select(*keys, "w", member, ts).dropDuplicates([*keys, "w", member])
    return (
        once.groupBy(*keys, "w").agg(F.count(F.lit(1)).alias(out))
        .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), out)
    )
