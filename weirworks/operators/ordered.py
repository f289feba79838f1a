"""Ordered per-key scans over a range layout: no key, burst or tie group is too large for a task.

``PARTITION BY key ORDER BY time`` puts a key's rows into one task. Here

1. the rows are range-partitioned by (keys, all order columns), which cuts a frequent key, a burst at one time and a run of
   one tie-break alike, and written once with the partition's number as the slice. NULL keys are keys like any other;
2. the window functions run per (key, slice): one shuffle, groups of one slice at most;
3. a range holds whole keys except at its ends, so only the first and the last key of a slice can go on in another one. The
   slices of these keys are summarised (two rows per slice at most, whatever the data), the summaries are scanned in slice
   order and the value carried into each slice is joined back. Two rows per partition is also the bound of that broadcast.

``scanned_by_key`` keeps this for the keys that are too large for a task, and scans all others where a shuffle by key puts them.

Every scan of an ``Ordered`` uses the same stored layout, so what comes before it runs once, plus the sampling of range bounds.
The order columns together should tell rows of a key apart: rows that agree in all of them stay in one slice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType, TimestampNTZType, TimestampType

from weirworks.functions.expr import col, micros
from weirworks.session import stored

SLICE, KEY = "__slice", "__key"


def order_us(df: DataFrame, name: str) -> Column:
    """An order column as an integer (microseconds for times)."""
    kind = df.schema[name].dataType
    return micros(name) if isinstance(kind, (TimestampType, TimestampNTZType)) else F.col(name).cast("bigint")


def key_struct(keys: Sequence[str]) -> Column:
    """All keys as one value that is never NULL and equal where the keys are, NULLs included."""
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))


@dataclass(frozen=True)
class Scan:
    """One scanned value: how it is computed in a slice, summarised per slice, carried and combined."""

    kind: str
    value: Column


def total(value: Column | str) -> Scan:
    """Running sum, current row included."""
    return Scan("total", F.coalesce(col(value), F.lit(0)))


def running_count() -> Scan:
    return Scan("total", F.lit(1).cast("bigint"))


def running_max(value: Column | str) -> Scan:
    return Scan("max", col(value))


def max_before(value: Column | str) -> Scan:
    """Running maximum of the rows before; NULL for the first row."""
    return Scan("max_before", col(value))


def previous(value: Column | str) -> Scan:
    """Value of the row before; NULL for the first row."""
    return Scan("previous", col(value))


def following(value: Column | str) -> Scan:
    """Value of the row after; NULL for the last row."""
    return Scan("following", col(value))


def latest(value: Column | str) -> Scan:
    """Most recent non-NULL value, current row included."""
    return Scan("latest", col(value))


def next_known(value: Column | str) -> Scan:
    """First non-NULL value among later rows, current row excluded."""
    return Scan("next_known", col(value))


def slice_ends(laid_out: DataFrame) -> DataFrame:
    """(key, slice) for the first and the last key of every slice: at most two rows per slice."""
    ends = laid_out.groupBy(SLICE).agg(F.min(KEY).alias("lo"), F.max(KEY).alias("hi"))
    return ends.select(SLICE, F.explode(F.array_distinct(F.array("lo", "hi"))).alias(KEY))


class Ordered:
    """A table laid out for ordered scans per key. ``keys`` may be empty (one global order).

    ``slices`` is the number of ranges; by default Spark's number of shuffle partitions, merged where they are small.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None):
        if df.isStreaming:
            raise ValueError("ordered scans run on stored tables; streams use the processors in weirworks.streaming")
        self.order, self.keys = list(order), list(keys)
        keyed = df.withColumn(KEY, key_struct(self.keys))
        by = [F.col(c) for c in (KEY, *self.order)]
        ranged = keyed.repartitionByRange(slices, *by) if slices else keyed.repartitionByRange(*by)
        self.df = stored(ranged.withColumn(SLICE, F.spark_partition_id()), "ordered")
        self.ends = slice_ends(self.df)

    def with_column(self, name: str, value: Column) -> "Ordered":
        self.df = self.df.withColumn(name, value)
        return self

    def filter(self, condition: Column) -> "Ordered":
        self.df = self.df.filter(condition)
        return self

    def result(self) -> DataFrame:
        return self.df.drop(SLICE, KEY)

    def keys_in_several_slices(self) -> DataFrame:
        """Keys that a range bound cuts: fewer than slices."""
        return self.ends.groupBy(KEY).agg(F.count(SLICE).alias("n")).filter("n > 1").select(KEY)

    def scan(self, **scans: Scan) -> "Ordered":
        part = [KEY, SLICE]
        base = Window.partitionBy(*part)
        forward = base.orderBy(*self.order)
        backward = base.orderBy(*[F.col(c).desc() for c in self.order])
        position = F.struct(*self.order)
        sofar = (Window.unboundedPreceding, Window.currentRow)
        before = (Window.unboundedPreceding, -1)

        by_slice = Window.partitionBy(KEY).orderBy(SLICE)
        by_slice_back = Window.partitionBy(KEY).orderBy(F.col(SLICE).desc())

        local, summary, carry, combined = {}, {}, {}, {}
        for name, s in scans.items():
            lc, sm, cy = f"__l_{name}", f"__s_{name}", f"__c_{name}"
            boxed = F.struct(s.value.alias("v"))
            known = F.when(s.value.isNotNull(), position)
            if s.kind == "total":
                local[lc] = F.sum(s.value).over(forward.rowsBetween(*sofar))
                summary[sm] = F.sum(s.value)
                carry[cy] = F.sum(sm).over(by_slice.rowsBetween(*before))
                combined[name] = F.col(lc) + F.coalesce(F.col(cy), F.lit(0))
            elif s.kind == "max":
                local[lc] = F.max(s.value).over(forward.rowsBetween(*sofar))
                summary[sm] = F.max(s.value)
                carry[cy] = F.max(sm).over(by_slice.rowsBetween(*before))
                combined[name] = F.greatest(F.col(lc), F.col(cy))
            elif s.kind == "max_before":
                local[lc] = F.max(s.value).over(forward.rowsBetween(*before))
                summary[sm] = F.max(s.value)
                carry[cy] = F.max(sm).over(by_slice.rowsBetween(*before))
                combined[name] = F.greatest(F.col(lc), F.col(cy))
            elif s.kind == "previous":
                local[lc] = F.lag(boxed).over(forward)
                summary[sm] = F.max_by(boxed, position)
                carry[cy] = F.lag(sm).over(by_slice)
                combined[name] = F.coalesce(F.col(lc), F.col(cy))["v"]
            elif s.kind == "following":
                local[lc] = F.lead(boxed).over(forward)
                summary[sm] = F.min_by(boxed, position)
                carry[cy] = F.lead(sm).over(by_slice)
                combined[name] = F.coalesce(F.col(lc), F.col(cy))["v"]
            elif s.kind == "latest":
                local[lc] = F.last(s.value, ignorenulls=True).over(forward.rowsBetween(*sofar))
                summary[sm] = F.max_by(s.value, known)
                carry[cy] = F.last(sm, ignorenulls=True).over(by_slice.rowsBetween(*before))
                combined[name] = F.coalesce(F.col(lc), F.col(cy))
            elif s.kind == "next_known":
                local[lc] = F.last(s.value, ignorenulls=True).over(backward.rowsBetween(*before))
                summary[sm] = F.min_by(s.value, known)
                carry[cy] = F.last(sm, ignorenulls=True).over(by_slice_back.rowsBetween(*before))
                combined[name] = F.coalesce(F.col(lc), F.col(cy))
            else:
                raise ValueError(s.kind)

        kept = [c for c in self.df.columns if c not in scans]
        cut = self.keys_in_several_slices()
        carried = (
            self.df.join(F.broadcast(cut), KEY, "left_semi").groupBy(*part).agg(*[c.alias(n) for n, c in summary.items()])
            .select(*part, *[c.alias(n) for n, c in carry.items()])
        )
        self.df = (
            self.df.select("*", *[c.alias(n) for n, c in local.items()]).join(F.broadcast(carried), part, "left")
            .select(*kept, *[c.alias(n) for n, c in combined.items()])
        )
        return self


class Grouped:
    """The scans of ``Ordered`` by plain window functions: each key's rows in one task, without a stored layout."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str]):
        self.df, self.keys, self.order = df, list(keys), list(order)

    def with_column(self, name: str, value: Column) -> "Grouped":
        self.df = self.df.withColumn(name, value)
        return self

    def filter(self, condition: Column) -> "Grouped":
        self.df = self.df.filter(condition)
        return self

    def result(self) -> DataFrame:
        return self.df

    def scan(self, **scans: Scan) -> "Grouped":
        forward = Window.partitionBy(*self.keys).orderBy(*self.order)
        sofar = forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before, after = forward.rowsBetween(Window.unboundedPreceding, -1), forward.rowsBetween(1, Window.unboundedFollowing)
        made = {
            "total": lambda v: F.sum(v).over(sofar), "max": lambda v: F.max(v).over(sofar), "max_before": lambda v: F.max(v).over(before),
            "previous": lambda v: F.lag(v).over(forward), "following": lambda v: F.lead(v).over(forward),
            "latest": lambda v: F.last(v, ignorenulls=True).over(sofar), "next_known": lambda v: F.first(v, ignorenulls=True).over(after),
        }
        kept = [c for c in self.df.columns if c not in scans]
        self.df = self.df.select(*kept, *[made[s.kind](s.value).alias(name) for name, s in scans.items()])
        return self


NEVER_HOT = 1 << 18  # rows of a key that any task may hold
TASK_ROWS = 1 << 19


def task_count(df: DataFrame) -> int:
    """Tasks for a shuffle of ``df``'s rows by keys: what one of them groups or sorts does not grow with the table.

    Spark's number of shuffle partitions is the same for all sizes, so the rows of a task grow with the table. For stored tables, whose rows
    are counted without being read.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


def hot_keys(keyed: DataFrame, key: str, slices: int | None = None) -> DataFrame | None:
    """Values of ``key`` with more than twice a task's share of the rows, so fewer than half as many as there are tasks; None if there are none.

    One counting pass, combined before the shuffle. With ``slices`` the share is that of so many tasks, however few rows there are.
    """
    sizes = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    rows, most = sizes.agg(F.sum("n"), F.max("n")).first()
    parts = slices or int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = 2 * (rows or 0) / parts
    limit = share if slices else max(share, NEVER_HOT)
    if (most or 0) <= limit:
        return None
    return stored(sizes.filter(F.col("n") > limit).select(key), "hot-keys")


def scanned_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], steps: Callable, slices: int | None = None) -> DataFrame:
    """``steps`` (a chain of ``scan``, ``with_column`` and ``filter``) over the ordered rows of each key.

    Ordinary keys are scanned where a shuffle by key puts them; keys too large for a task go through ``Ordered``. Both give the same rows.
    """
    keyed = df.withColumn(KEY, key_struct(keys))
    hot = hot_keys(keyed, KEY, slices)
    if hot is None:
        return steps(Grouped(df, keys, order)).result()
    ordinary, large = (keyed.join(F.broadcast(hot), KEY, how).drop(KEY) for how in ("left_anti", "left_semi"))
    return steps(Grouped(ordinary, keys, order)).result().unionByName(steps(Ordered(large, keys, order, slices)).result())


def trailing_sum(df: DataFrame, keys: Sequence[str], order: str, value: Column, range_us: int, out: str, slices: int | None = None) -> DataFrame:
    """``sum(value) over (partition by keys order by time range between R preceding and current row)`` for integers.

    The values are added up per (key, time), each sum enters a running total at its time and leaves it just after the
    range, and the total is joined back. Taking values out again is exact for integers only: other types are refused.
    """
    timed = df.withColumn("__us", order_us(df, order)).withColumn("__v", value).withColumn(KEY, key_struct(keys))
    if not isinstance(timed.schema["__v"].dataType, IntegralType):
        raise TypeError("trailing sums are exact for integers only")
    sums = timed.groupBy(KEY, "__us").agg(F.sum("__v").alias("__v"))
    leaving = sums.select(KEY, (F.col("__us") + F.lit(range_us + 1)).alias("__us"), F.lit(0).alias("__kind"), (-F.col("__v")).alias("__v"))
    marks = sums.select(KEY, "__us", F.lit(1).alias("__kind"), "__v").unionByName(leaving).withColumnRenamed(KEY, "__of")
    totals = Ordered(marks, ["__of"], ["__us", "__kind"], slices).scan(**{out: total("__v")}).result().filter(F.col("__kind") == 1)
    return timed.drop("__v").join(totals.select(F.col("__of").alias(KEY), "__us", out), [KEY, "__us"]).drop("__us", KEY)
