"""Top-N and sorting."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegralType

from weirworks.operators.aggs import group_lists
from weirworks.operators.greedy import differs
from weirworks.operators.ordered import KEY, SLICE, Ordered, hot_keys, key_struct, scanned_by_key, total


def top_n(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group. The limit is applied before the shuffle too (WindowGroupLimit),
    so at most ``n`` rows per group and map task reach the ranking task."""
    ranked = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(out, F.row_number().over(ranked)).filter(F.col(out) <= n)


def hot_items(df: DataFrame, ts: str, item: str, size: str, slide: str, n: int) -> DataFrame:
    """Most frequent items of each sliding window.

    Rows are counted per (slide step, item) first; the ``size/slide`` windows are
    made from these counts, so rows are not multiplied by the number of windows.
    """
    step = df.groupBy(F.window(ts, slide).start.alias("__step"), item).agg(F.count(F.lit(1)).alias("__n"))
    w = F.window("__step", size, slide)
    counts = (
        step.groupBy(w.alias("__w"), item).agg(F.sum("__n").alias("view_count"))
        .select(F.col("__w.end").alias("window_end"), item, "view_count")
    )
    return top_n(counts, ["window_end"], [F.col("view_count").desc(), F.col(item).asc_nulls_last()], n)


def total_top_n(df: DataFrame, area: str, item: str, value: str, n: int) -> DataFrame:
    """The top ``n`` items of each area by total: what a running top-N shows after all rows."""
    totals = df.groupBy(area, item).agg(F.sum(value).alias("total"))
    return top_n(totals, [area], [F.col("total").desc(), F.col(item)], n)


def sorted_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str) -> DataFrame:
    """Each group's values in order, in chunks (see ``group_lists``)."""
    return group_lists(df, keys, order, value, out)


Top = list[tuple[float, object]]  # (total, item), best first


def _with(top: Top, item, amount: float, n: int) -> Top:
    """The best ``n`` after an item's total rose to ``amount``; equal totals go by item."""
    if len(top) == n and amount < top[-1][0] and all(i != item for _, i in top):
        return top
    return sorted([(t, i) for t, i in top if i != item] + [(amount, item)], key=lambda x: (-x[0], x[1]))[:n]


def _fold_tops(item: str, n: int, out: str, arrow: pa.Schema, value: str | None = None):
    """Batch function over rows sorted by (key, slice, order): the top after every row, from ``__start`` at the first row of a (key, slice).

    Totals come with the rows (``__total``), or ``value`` is added up here per item of a key. A top is written out once for the run of rows
    that leave it as it is.
    """
    kind = arrow.field(out).type

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, top, held = None, [], {}
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.ones(batch.num_rows, bool)
            new[1:] = differs(batch.column(KEY)) | differs(batch.column(SLICE))
            last = batch.num_rows - 1
            new[0] = group != (batch.column(KEY)[0].as_py(), batch.column(SLICE)[0].as_py())
            group = batch.column(KEY)[last].as_py(), batch.column(SLICE)[last].as_py()
            starts = {i: () if value else batch.column("__start")[i].as_py() or () for i in np.flatnonzero(new).tolist()}
            made, which = [top], []
            for i, (what, amount) in enumerate(zip(batch.column(item).to_pylist(), batch.column(value or "__total").to_pylist())):
                if i in starts:
                    top, held = [(e["total"], e["item"]) for e in starts[i]], {}
                if value:
                    held[what] = amount = held.get(what, 0) + (amount or 0)
                after = _with(top, what, float(amount), n)
                if after is not made[-1]:
                    made.append(after)
                top = after
                which.append(len(made) - 1)
            flat = [e for t in made for e in t]
            entries = pa.StructArray.from_arrays([pa.array([x for _, x in flat], kind.value_type.field("item").type), pa.array([t for t, _ in flat], pa.float64())], fields=list(kind.value_type))
            tops = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, made)]), pa.int32()), entries).cast(kind)
            named = {c: batch.column(c) for c in batch.schema.names} | {out: tops.take(pa.array(which))}
            yield pa.RecordBatch.from_arrays([named[f.name] for f in arrow], schema=arrow)

    return fold


def running_top_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: str, value: str, n: int, out: str = "top", slices: int | None = None) -> DataFrame:
    """The key's ``n`` best items by total so far, after each row (``out``: array of item and total). Values are not negative.

    Ordinary keys are added up and folded where one shuffle by key puts them. Keys too large for a task are laid out in slices: totals only rise, so
    the best of a prefix are among the best of its parts, and each slice is folded with ``n`` items in hand, from the merged
    bests of the slices before it (``n`` items per slice of a cut key, two keys per slice at most).
    """
    entry = f"array<struct<item: {df.schema[item].dataType.simpleString()}, total: double>>"
    schema = df.withColumn(out, F.array().cast(entry)).schema
    fold = _fold_tops(item, n, out, to_arrow_schema(schema))
    def folded(rows: DataFrame, by=fold) -> DataFrame:
        return rows.repartition(KEY, SLICE).sortWithinPartitions(KEY, SLICE, *order).mapInArrow(by, schema)

    keyed = df.withColumn(KEY, key_struct(keys))
    hot = hot_keys(keyed, KEY, slices)
    plain = keyed if hot is None else keyed.join(F.broadcast(hot), KEY, "left_anti")
    if isinstance(df.schema[value].dataType, (IntegralType, DoubleType)):
        done = folded(plain.withColumn(SLICE, F.lit(0)), _fold_tops(item, n, out, to_arrow_schema(schema), value))
    else:  # added up by Spark's arithmetic
        summed = scanned_by_key(plain.drop(KEY), [*keys, item], order, lambda seq: seq.scan(__total=total(value)), slices)
        done = folded(summed.withColumns({KEY: key_struct(keys), SLICE: F.lit(0), "__start": F.lit(None).cast(entry)}))
    if hot is None:
        return done

    summed = scanned_by_key(keyed.join(F.broadcast(hot), KEY, "left_semi").drop(KEY), [*keys, item], order, lambda seq: seq.scan(__total=total(value)), slices)
    laid = Ordered(summed, keys, order, slices)
    ids = laid.keys_in_several_slices().withColumn("__id", F.monotonically_increasing_id())
    best = laid.df.join(F.broadcast(ids), KEY).groupBy("__id", SLICE, item).agg(F.max("__total").cast("double").alias("__total"))
    best = top_n(best, ["__id", SLICE], [F.col("__total").desc(), F.col(item)], n).select("__id", SLICE, F.col(item).alias("item"), "__total")

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        top: Top = []
        made = []
        for number, rows in part.sort_values(SLICE).groupby(SLICE):
            made.append((part["__id"].iloc[0], number, [{"item": i, "total": t} for t, i in top]))
            for i, t in zip(rows["item"].tolist(), rows["__total"].tolist()):
                top = _with(top, i, t, n)
        return pd.DataFrame(made, columns=["__id", SLICE, "__start"])

    starts = best.groupBy("__id").applyInPandas(merged, f"__id bigint, {SLICE} int, __start {entry}")
    starts = starts.join(ids, "__id").select(KEY, SLICE, "__start")
    return done.unionByName(folded(laid.df.join(F.broadcast(starts), [KEY, SLICE], "left")))
