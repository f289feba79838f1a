"""Window assignment: fixed, shifted, per-key, per-record, multiple, session and count windows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirworks.functions.expr import floor_to, from_micros, interval_us, micros
from weirworks.operators.ordered import Ordered, latest, previous, running_count, scanned_by_key, total


def windowed(df: DataFrame, ts: str, size: str, slide: str | None = None, offset: str | None = None, keys: Sequence[str] = (), **aggs: Column) -> DataFrame:
    """Aggregates per key and tumbling or sliding window, with ``window_start`` and ``window_end``.

    Works on batch and streaming tables; aggregation is partial before the shuffle.
    """
    w = F.window(ts, size, slide, offset) if (slide or offset) else F.window(ts, size)
    if slide is None and offset:
        w = F.window(ts, size, size, offset)
    return (
        df.groupBy(w.alias("__w"), *keys).agg(*[a.alias(n) for n, a in aggs.items()])
        .select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *keys, *aggs)
    )


def session_windows(df: DataFrame, ts: str, gap: str | Column, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Built-in gap sessions; the form that also runs on streams. ``gap`` may be a string column.

    The bounds are aggregates, not the grouping key: a later filter on the key is
    pushed below the merging of sessions by the optimizer and would cut sessions apart.
    """
    pause = F.expr(f"INTERVAL '{gap}'") if isinstance(gap, str) else gap.cast("interval")
    return (
        df.groupBy(F.session_window(F.col(ts), gap).alias("__w"), *keys)
        .agg(F.min(ts).alias("window_start"), F.max(F.col(ts) + pause).alias("window_end"), *[a.alias(n) for n, a in aggs.items()])
        .select("window_start", "window_end", *keys, *aggs)
    )


def assign_sessions(df: DataFrame, keys: Sequence[str], ts: str, tie: str, gap: str, slices: int | None = None) -> DataFrame:
    """Adds ``session_start``: a row joins the running session if it comes at most ``gap`` after the row before.

    Batch form without a per-key task: the session of a hot key may span many slices.
    """
    opens = F.coalesce(micros(ts) - micros("__prev") > interval_us(gap), F.lit(True))
    steps = lambda seq: seq.scan(__prev=previous(ts)).with_column("__open", F.when(opens, F.col(ts))).scan(session_start=latest("__open"))
    return scanned_by_key(df, keys, [ts, tie], steps, slices).drop("__prev", "__open")


def unaligned_windows(df: DataFrame, ts: str, size_us: int, offset_us: Column) -> DataFrame:
    """Windows of one size whose phase depends on the key, so they do not all end together."""
    start = floor_to(micros(ts), size_us, offset_us)
    return df.withColumn("window_start", from_micros(start)).withColumn("window_end", from_micros(start + F.lit(size_us)))


def per_record_windows(df: DataFrame, ts: str, size_us: Column) -> DataFrame:
    """Window size taken from the record."""
    start = floor_to(micros(ts), size_us)
    return df.withColumn("window_start", from_micros(start)).withColumn("window_end", from_micros(start + size_us))


def shifted_windows(df: DataFrame, ts: str, size: str, slide: str) -> DataFrame:
    """Each record to ``size/slide`` windows starting one to ``size/slide`` slides before its slide, and to its own slide.

    With size 5 minutes and slide 1 minute: starts at minute-1 .. minute-5, and the minute itself.
    """
    size_us, slide_us = interval_us(size), interval_us(slide)
    own = floor_to(micros(ts), slide_us)
    shifted = [
        F.struct((own - F.lit(i * slide_us)).alias("s"), (own - F.lit(i * slide_us - size_us)).alias("e"))
        for i in range(1, size_us // slide_us + 1)
    ]
    single = F.struct(own.alias("s"), (own + F.lit(slide_us)).alias("e"))
    return (
        df.withColumn("__w", F.explode(F.array(*shifted, single)))
        .withColumn("window_start", from_micros("__w.s")).withColumn("window_end", from_micros("__w.e")).drop("__w")
    )


def concurrent_window_sums(df: DataFrame, ts: str, value: str, keys: Sequence[str], tumbling: str, sampled: tuple[str, str], session_gap: str, tie: str) -> DataFrame:
    """Sums over tumbling, sampled (size, slide with gaps between) and session windows of one input.

    The tumbling and sampled windows roll up one shared pre-aggregate per slice of
    the common width instead of reading the rows again.
    """
    tumbling_us = interval_us(tumbling)
    size_us, slide_us = (interval_us(x) for x in sampled)
    grain = math.gcd(tumbling_us, size_us, slide_us)
    grains = df.groupBy(*keys, floor_to(micros(ts), grain).alias("__g")).agg(F.sum(value).alias("__v"))
    fixed = [
        ("tumbling", floor_to("__g", tumbling_us), tumbling_us, F.lit(True)),
        ("sampled", floor_to("__g", slide_us), size_us, F.pmod(F.col("__g"), F.lit(slide_us)) < size_us),
    ]
    assigned = F.array(*[
        F.when(inside, F.struct(F.lit(kind).alias("kind"), start.alias("s"), (start + F.lit(width)).alias("e")))
        for kind, start, width, inside in fixed
    ])
    rolled = (
        grains.withColumn("__w", F.explode(assigned)).filter(F.col("__w").isNotNull())
        .groupBy("__w.kind", *keys, "__w.s", "__w.e").agg(F.sum("__v").alias("total"))
        .select("kind", *keys, from_micros("s").alias("window_start"), from_micros("e").alias("window_end"), "total")
    )
    sessions = (
        assign_sessions(df.select(*keys, ts, tie, value), keys, ts, tie, session_gap)
        .groupBy(*keys, "session_start").agg(F.sum(value).alias("total"), F.max(micros(ts)).alias("__last"))
        .select(F.lit("session").alias("kind"), *keys, F.col("session_start").alias("window_start"),
                from_micros(F.col("__last") + F.lit(interval_us(session_gap))).alias("window_end"), "total")
    )
    return rolled.unionByName(sessions)


def count_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, slices: int | None = None, **aggs: Column) -> DataFrame:
    """Every ``size``-th element of a key emits its group and clears it; an incomplete last group emits nothing."""
    numbered = Ordered(df, keys, order, slices).scan(__n=running_count()).result()
    return (
        numbered.withColumn("batch", F.floor((F.col("__n") - 1) / F.lit(size)).cast("bigint"))
        .groupBy(*keys, "batch").agg(F.count(F.lit(1)).alias("__c"), *[a.alias(n) for n, a in aggs.items()])
        .filter(F.col("__c") == size).drop("__c")
    )


def count_accumulate(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, value: str, out: str, slices: int | None = None) -> DataFrame:
    """Running total emitted at every ``size``-th element of a key, never cleared."""
    return (
        Ordered(df, keys, order, slices).scan(seen=running_count(), **{out: total(value)}).result()
        .filter(F.col("seen") % size == 0)
    )
