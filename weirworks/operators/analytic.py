"""Analytic functions over a key's ordered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirworks.functions.expr import from_micros, interval_us, micros
from weirworks.operators.ordered import Ordered, previous, running_count, total, trailing_sum


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn", slices: int | None = None) -> DataFrame:
    return Ordered(df, keys, order, slices).scan(**{out: running_count()}).result()


def range_count(df: DataFrame, keys: Sequence[str], ts: str, span: str, out: str = "n", slices: int | None = None) -> DataFrame:
    """Rows of the key in the trailing time span, current row and its ties included."""
    return trailing_sum(df, keys, ts, F.lit(1), interval_us(span), out, slices)


def decaying_count(df: DataFrame, keys: Sequence[str], ts: str, lead_s: int, span: str, out: str = "n", slices: int | None = None) -> DataFrame:
    """Each event becomes (t-lead, 0), (t+lead, 1), (t+lead+span, 0); the trailing sum of the flags also
    reports the fall to zero when no new event comes."""
    us, lead, width = micros(ts), lead_s * 10**6, interval_us(span)
    marks = F.array(
        F.struct((us - F.lit(lead)).alias("us"), F.lit(0).cast("bigint").alias("flag")),
        F.struct((us + F.lit(lead)).alias("us"), F.lit(1).cast("bigint").alias("flag")),
        F.struct((us + F.lit(lead + width)).alias("us"), F.lit(0).cast("bigint").alias("flag")),
    )
    expanded = df.withColumn("__m", F.explode(marks)).withColumn("at_us", F.col("__m.us")).withColumn("flag", F.col("__m.flag")).drop("__m", ts)
    summed = trailing_sum(expanded, keys, "at_us", F.col("flag"), width, out, slices)
    return summed.withColumn("at_ts", from_micros("at_us")).drop("at_us")


def live_count_changes(df: DataFrame, keys: Sequence[str], ts: str, tie: str, ttl: str, slices: int | None = None) -> DataFrame:
    """Count of a key's rows of the last ``ttl``, emitted at each arrival and at each expiry.

    At equal times expiries come before arrivals.
    """
    us = micros(ts)
    changes = F.array(
        F.struct(us.alias("us"), F.lit(1).alias("step"), F.lit("arrive").alias("kind")),
        F.struct((us + F.lit(interval_us(ttl))).alias("us"), F.lit(-1).alias("step"), F.lit("expire").alias("kind")),
    )
    marks = df.select(*keys, tie, F.explode(changes).alias("__m")).select(*keys, tie, "__m.us", "__m.step", "__m.kind")
    live = Ordered(marks, keys, ["us", "step", tie], slices).scan(live=total(F.col("step").cast("bigint"))).result()
    return live.select(*keys, tie, from_micros("us").alias("at_ts"), "kind", "live")


def jump_alerts(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, threshold: float, forget: str, slices: int | None = None) -> DataFrame:
    """Rows that differ from the row before by more than ``threshold``; the row before is forgotten after ``forget``."""
    fresh = micros(ts) - micros(F.col("__prev.t")) <= interval_us(forget)
    scanned = Ordered(df, keys, [ts, tie], slices).scan(__prev=previous(F.struct(F.col(ts).alias("t"), F.col(value).alias("v")))).result()
    return (
        scanned.filter(fresh & (F.abs(F.col(value) - F.col("__prev.v")) > threshold))
        .withColumn("previous_value", F.col("__prev.v")).drop("__prev")
    )


def changed_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, slices: int | None = None) -> DataFrame:
    """Rows whose value differs from the key's row before (the first row counts as a change)."""
    tracked = value if isinstance(value, Column) else F.col(value)
    scanned = Ordered(df, keys, order, slices).scan(__prev=previous(tracked)).result()
    return scanned.filter(~tracked.eqNullSafe(F.col("__prev"))).drop("__prev")
