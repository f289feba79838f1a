"""Timer-driven results over stored history: what per-key state with timers would have emitted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirworks.functions.expr import floor_to, from_micros, interval_us, micros
from weirworks.operators.ordered import Ordered, following, latest, previous, running_count


ALERTS = 1_000  # alerts of a span that one cell holds on the way


def repeated_alerts(df: DataFrame, keys: Sequence[str], ts: str, tie: str, offline: Column, period: str, slices: int | None = None) -> DataFrame:
    """Alerts each ``period`` after an offline message until the key's next message, which re-arms or stops them.

    A key without a next message is watched up to the last time in the table.
    """
    step = interval_us(period)
    horizon = df.agg(F.max(micros(ts)) + 1).scalar()
    until = F.coalesce(micros("__next"), horizon)
    first = micros(ts) + F.lit(step)
    last = F.floor((F.col("__until") - F.lit(1) - first) / F.lit(step))  # number of the last alert, from 0
    block = F.col("__block") * ALERTS
    watched = Ordered(df, keys, [ts, tie], slices).scan(__next=following(ts)).result()
    return (
        watched.filter(offline).withColumn("__until", until).filter(first < F.col("__until"))
        .select(*keys, tie, first.alias("__first"), last.alias("__last"))
        .withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("__last") / ALERTS))))
        .withColumn("__i", F.explode(F.sequence(block, F.least(block + (ALERTS - 1), F.col("__last")))))
        .select(*keys, tie, from_micros(F.col("__first") + F.col("__i") * step).alias("alert_at"))
    )


def counts_after_silence(df: DataFrame, keys: Sequence[str], ts: str, tie: str, silence: str, slices: int | None = None) -> DataFrame:
    """The key's count so far, emitted ``silence`` after a row that no other row of the key followed by then."""
    quiet = micros("__next") - micros(ts) > interval_us(silence)
    scanned = Ordered(df, keys, [ts, tie], slices).scan(n=running_count(), __next=following(ts)).result()
    return (
        scanned.filter(F.coalesce(quiet, F.lit(True)))
        .withColumn("emitted_at", from_micros(micros(ts) + F.lit(interval_us(silence)))).drop("__next")
    )


def daily_average_ticks(df: DataFrame, keys: Sequence[str], ts: str, value: str, every: str, size: str = "1 day") -> DataFrame:
    """Average of the running day on a fixed grid, at ticks with new data. Rows are added up per tick first."""
    every_us, size_us = interval_us(every), interval_us(size)
    ticks = df.groupBy(*keys, floor_to(micros(ts), every_us).alias("__t")).agg(F.count(value).alias("__n"), F.sum(value).alias("__s"))
    sofar = Window.partitionBy(*keys, "__d").orderBy("__t").rowsBetween(Window.unboundedPreceding, 0)
    return ticks.withColumn("__d", floor_to("__t", size_us)).select(
        *keys, from_micros("__d").alias("day"), from_micros(F.col("__t") + F.lit(every_us)).alias("emitted_at"),
        (F.sum("__s").over(sofar) / F.sum("__n").over(sofar)).alias("mean"))


def counts_with_idle_reset(df: DataFrame, keys: Sequence[str], ts: str, tie: str, idle: str, slices: int | None = None) -> DataFrame:
    """Running count whose state is dropped when the key is idle for longer than ``idle``."""
    revived = F.coalesce(micros(ts) - micros("__prev") > interval_us(idle), F.lit(True))
    return (
        Ordered(df, keys, [ts, tie], slices)
        .scan(__prev=previous(ts), __n=running_count())
        .with_column("__reset", F.when(revived, F.col("__n") - 1))
        .scan(__base=latest("__reset"))
        .with_column("n", F.col("__n") - F.col("__base"))
        .result().drop("__prev", "__n", "__reset", "__base")
    )


def latest_view(df: DataFrame, ts: str, size: str, pivot_on: str, values: Sequence[str], agg: Column) -> DataFrame:
    """One row per window with a column per listed value of ``pivot_on``: a dashboard table."""
    return (
        df.groupBy(F.window(ts, size).alias("__w")).pivot(pivot_on, list(values)).agg(agg)
        .select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *values)
    )
