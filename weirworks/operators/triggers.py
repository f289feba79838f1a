"""Early, repeated and late window results as ordinary queries.

A stream fires per micro-batch; these functions give the full sequence of results
that a trigger defines over the stored history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirworks.functions.expr import floor_to, from_micros, interval_us, micros
from weirworks.operators.ordered import Ordered, latest, max_before, next_known, previous, running_count, running_max, scanned_by_key, total
from weirworks.session import stored


def continuous_results(df: DataFrame, keys: Sequence[str], ts: str, size: str, every: str, **sums: Column) -> DataFrame:
    """Window totals so far at each ``every`` tick that has data, until the window ends.

    Rows are added up per tick first, so the running sum covers at most size/every rows per window.
    """
    size_us, every_us = interval_us(size), interval_us(every)
    ticks = df.groupBy(*keys, floor_to(micros(ts), every_us).alias("__t")).agg(*[c.alias(f"__{n}") for n, c in sums.items()])
    sofar = Window.partitionBy(*keys, "__w").orderBy("__t").rowsBetween(Window.unboundedPreceding, 0)
    return ticks.withColumn("__w", floor_to("__t", size_us)).select(
        *keys, from_micros("__w").alias("window_start"), from_micros(F.col("__t") + F.lit(every_us)).alias("fired_at"),
        *[F.sum(f"__{n}").over(sofar).alias(n) for n in sums])


def with_watermark_before(df: DataFrame, arrival: Sequence[str], event_ts: str, delay: str, slices: int | None = None) -> DataFrame:
    """Adds ``watermark_us``: highest event time among rows that arrived earlier, minus ``delay``."""
    return (
        Ordered(df, [], arrival, slices).scan(__before=max_before(micros(event_ts))).result()
        .withColumn("watermark_us", F.col("__before") - F.lit(interval_us(delay))).drop("__before")
    )


def label_firings(df: DataFrame, arrival: Sequence[str], event_ts: str, size: str, delay: str, early: str, lateness: str, slices: int | None = None) -> DataFrame:
    """Which firing of its window first shows a row: an ``early`` one (every ``early`` of watermark), the ``on_time``
    one at the window's end, a ``late`` one of its own, or none (``dropped``)."""
    size_us, early_us, late_us = (interval_us(x) for x in (size, early, lateness))
    marked = with_watermark_before(df, arrival, event_ts, delay, slices)
    end = floor_to(micros(event_ts), size_us) + F.lit(size_us)
    mark = F.coalesce(F.col("watermark_us"), F.lit(0))
    next_tick = floor_to(mark, early_us) + F.lit(early_us)
    label = (
        F.when(next_tick < end, "early").when(mark < end, "on_time").when(mark < end + F.lit(late_us), "late").otherwise("dropped")
    )
    return marked.withColumn("window_end", from_micros(end)).withColumn("label", label).drop("watermark_us")


def accepted_rows(df: DataFrame, arrival: Sequence[str], event_ts: str, size: str, delay: str, lateness: str, slices: int | None = None) -> DataFrame:
    """Rows whose window, ``lateness`` included, has not been passed by the watermark (the window's last millisecond counts)."""
    size_us = interval_us(size)
    marked = with_watermark_before(df, arrival, event_ts, delay, slices)
    start = floor_to(micros(event_ts), size_us)
    passed = start + F.lit(size_us - 1000 + interval_us(lateness)) <= F.col("watermark_us")
    return marked.withColumn("window_start", from_micros(start)).filter(~F.coalesce(passed, F.lit(False))).drop("watermark_us")


def per_element_counts(df: DataFrame, keys: Sequence[str], arrival: Sequence[str], out: str = "n", slices: int | None = None) -> DataFrame:
    """The window's count after each of its rows (rows carry ``window_start``)."""
    return scanned_by_key(df, [*keys, "window_start"], arrival, lambda seq: seq.scan(**{out: running_count()}), slices)


def every_n_and_end(df: DataFrame, window: Sequence[str], order: Sequence[str], n: int, value: str, slices: int | None = None) -> DataFrame:
    """Window total after every ``n``-th element and once more at the window's end."""
    counted = Ordered(df, window, order, slices).scan(seen=running_count(), total=total(value)).result()
    at_n = counted.filter(F.col("seen") % n == 0).select(*window, F.lit("count").alias("fired_by"), "seen", "total")
    at_end = df.groupBy(*window).agg(F.count(F.lit(1)).alias("seen"), F.sum(value).alias("total")).select(*window, F.lit("end").alias("fired_by"), "seen", "total")
    return at_n.unionByName(at_end)


def session_firsts(df: DataFrame, keys: Sequence[str], ts: str, tie: str, gap: str, slices: int | None = None) -> DataFrame:
    """Only the first row of each gap session: one row, also where several share its time."""
    opens = F.coalesce(micros(ts) - micros("__prev") > interval_us(gap), F.lit(True))
    return Ordered(df, keys, [ts, tie], slices).scan(__prev=previous(ts)).result().filter(opens).drop("__prev")


def micro_batch_marks(df: DataFrame, batch: str, event_ts: str, delay: str, early: str, slices: int | None = None) -> DataFrame:
    """One row per micro-batch: its number, the watermark ``before`` and ``after`` it (whole milliseconds, never back), whether a tick of
    ``early`` lies between (``crossed``), and the number of the first such crossing in it or after it (``next_crossing``)."""
    early_us = interval_us(early)
    tops = df.groupBy(F.col(batch).alias("__batch")).agg(F.max(micros(event_ts)).alias("__top"))
    seq = Ordered(tops, [], ["__batch"], slices).scan(__high=running_max("__top"), number=running_count())
    seq = seq.with_column("after", F.greatest(F.floor(F.col("__high") / 1000) * 1000 - F.lit(interval_us(delay)), F.lit(0)).cast("bigint"))
    seq = seq.scan(before=previous("after")).with_column("before", F.coalesce("before", F.lit(0)))
    seq = seq.with_column("crossed", (F.col("before") > 0) & (floor_to("after", early_us) > floor_to("before", early_us)))
    seq = seq.scan(__crossings=total(F.col("crossed").cast("bigint")))
    marks = seq.result().withColumn("next_crossing", F.col("__crossings") - F.col("crossed").cast("bigint") + 1)
    return stored(marks.select("__batch", "number", "before", "after", "crossed", "next_crossing"), "micro-batches")


def fired_panes(df: DataFrame, keys: Sequence[str], batch: str, event_ts: str, tie: str, value: str, size: str, delay: str, early: str,
                lateness: str, slices: int | None = None) -> DataFrame:
    """Every result that windows fire while rows arrive in micro-batches (column ``batch``): window_start, fired_at, kind, pane, n, total.

    * ``early``: after a micro-batch whose watermark passed ticks of ``early`` since the one before, at the first of them, while it is before the end
      (ticks count from the first watermark on);
    * ``on_time``: after the micro-batch whose watermark reached the window's end;
    * ``late``: each row (in the order of ``tie``) that comes while the watermark is past the end by less than ``lateness``;
      later rows are dropped. A window whose first row is late has late results only.

    ``n`` and ``total`` cover all rows so far, ``pane`` numbers the results of a window from 1. Nothing loops over micro-batches: crossings are
    numbered, each window asks for its first and last one, and only results become rows.
    """
    size_us, early_us, late_us = (interval_us(x) for x in (size, early, lateness))
    marks = micro_batch_marks(df, batch, event_ts, delay, early, slices)
    rows = df.join(marks.select(F.col("__batch").alias(batch), "number", "before"), batch)
    rows = rows.withColumn("__start", floor_to(micros(event_ts), size_us)).withColumn("__late", F.col("before") >= F.col("__start") + F.lit(size_us))
    rows = rows.filter(F.col("before") < F.col("__start") + F.lit(size_us + late_us)).withColumn("__value", F.col(value).cast("double"))
    window = [*keys, "__start"]

    in_time = rows.filter(~F.col("__late")).groupBy(*window, "number").agg(F.count(F.lit(1)).alias("n"), F.sum("__value").alias("total"))
    in_time = stored(in_time, "panes-in-time")
    late = rows.filter("__late").select(
        *window, "number", F.lit(0).alias("phase"), F.col(tie).cast("bigint").alias("at"), F.lit(1).cast("bigint").alias("n"), F.col("__value").alias("total"),
        F.lit("late").alias("kind"), F.col("before").alias("fired"))
    opened = in_time.groupBy(*window).agg(F.min("number").alias("number")).withColumn("end", F.col("__start") + F.lit(size_us))

    # one order over time: window ends, watermarks, crossings (in this order where they are equal)
    first_reach = marks.groupBy(F.col("after").alias("time")).agg(F.min("number").alias("reached"))
    crossings = marks.filter("crossed").select(
        F.col("next_crossing").alias("crossing"), F.col("number").alias("at_number"), (floor_to("before", early_us) + F.lit(early_us)).alias("time"))
    axis = (
        opened.select(F.col("end").alias("time")).distinct().withColumn("__kind", F.lit(0))
        .unionByName(first_reach.withColumn("__kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(crossings.drop("at_number").withColumn("__kind", F.lit(2)), allowMissingColumns=True))
    ends = Ordered(axis, [], ["time", "__kind"], slices).scan(reached=next_known("reached"), crossing=latest("crossing")).result().filter("__kind = 0")
    windows = opened.join(ends.select(F.col("time").alias("end"), "reached", F.col("crossing").alias("last")), "end")
    windows = windows.join(marks.select("number", "next_crossing"), "number")

    on_time = windows.filter("reached is not null").select(
        *window, F.col("reached").alias("number"), F.lit(1).alias("phase"), F.col("end").alias("at"), F.lit("on_time").alias("kind"), F.col("end").alias("fired"))
    ticks = windows.filter(F.col("next_crossing") <= F.col("last")).select(*window, F.explode(F.sequence("next_crossing", "last")).alias("crossing"))
    early_ones = ticks.join(crossings, "crossing").select(
        *window, F.col("at_number").alias("number"), F.lit(1).alias("phase"), F.col("time").alias("at"), F.lit("early").alias("kind"), F.col("time").alias("fired"))

    changes = in_time.select("*", F.lit(0).alias("phase"), F.lit(-1).cast("bigint").alias("at"))
    steps = changes.unionByName(late, allowMissingColumns=True)
    for fired in (on_time, early_ones):
        steps = steps.unionByName(fired, allowMissingColumns=True)
    seen = Ordered(steps, window, ["number", "phase", "at"], slices).scan(
        n=total("n"), total=total("total"), pane=total(F.when(F.col("kind").isNotNull(), F.lit(1).cast("bigint")))).result()
    return seen.filter("kind is not null").select(
        *keys, from_micros("__start").alias("window_start"), from_micros("fired").alias("fired_at"), "kind", "pane", "n", "total")
