"""Greedy chains: each row either belongs to the current anchor row or becomes the next anchor.

Length-bounded sessions, time-to-live deduplication and count-or-delay batches
all cut a key's ordered rows into runs. A run starts at an anchor, and the next
anchor is the first later row that

* comes ``max_span`` or more after the anchor,
* is ``max_count`` rows after the anchor, or
* comes more than ``gap`` after the row just before it.

Keys of at most twice a task's share of the rows (``ordered.hot_keys``) are labelled by one pass over sorted partitions.
The others, fewer than half as many as there are tasks, may be of any size and never enter one task:

1. ordered scans number its rows and give each row the number of the next anchor;
2. blocks of 65,536 rows are contracted: for each row the first row of its chain
   beyond the block, stored as runs, of which chains that meet leave only a few;
3. the entry rows reached from the key's first row are found by pointer doubling,
   ``log2(number of blocks)`` joins of this small table;
4. each block is followed from its entry row, and an ordered scan spreads the anchors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from weirworks.functions.expr import from_micros, interval_us, micros
from weirworks.operators.ordered import Ordered, hot_keys, key_struct, latest, next_known, previous, running_count
from weirworks.session import stored

US, ANCHOR_US, ANCHOR_ID = "__us", "__anchor_us", "anchor_id"
_ONE, _REST = "__one", "__rest"  # all keys, all other columns
BLOCK = 1 << 16  # rows per block of a hot key
NO_ROW = 1 << 62
MAX_ROUNDS = 62  # doubling passes any 64-bit row number


def differs(c: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; NULL equals NULL."""
    if pa.types.is_struct(c.type):
        return np.logical_or.reduce([differs(field) for field in c.flatten()])
    mine, before = c.slice(1), c.slice(0, len(c) - 1)
    apart = pc.fill_null(pc.not_equal(mine, before), False)
    return pc.or_(apart, pc.xor(pc.is_null(mine), pc.is_null(before))).to_numpy(zero_copy_only=False)


def _label_sorted(keys: list[str], tie: str, span: int, max_count: int | None, gap: int | None):
    """Batch function over partitions sorted by (keys, time, tie): the anchor of every row. The tie keeps its type."""
    limit = max_count or 2**62

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_us, anchor_us, anchor_id, taken = None, 0, 0, None, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            us = batch.column(US).to_numpy(zero_copy_only=False)
            breaks = np.zeros(n, dtype=bool)
            for k in keys:
                breaks[1:] |= differs(batch.column(k))
            first_key = [batch.column(k)[0].as_py() for k in keys]
            breaks[0] = first_key != last_key
            if gap is not None:
                breaks[1:] |= (us[1:] - us[:-1]) > gap
                breaks[0] |= us[0] - last_us > gap
            out_us, at_row = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)  # row 0: the anchor of an earlier batch
            anchor_row = 0
            starts = np.flatnonzero(breaks)
            edges = np.unique(np.concatenate([[0], starts, [n]]))
            for lo, hi in zip(edges[:-1], edges[1:]):
                i = lo
                if breaks[lo]:
                    taken = limit  # forces a new anchor
                while i < hi:
                    if taken >= limit or us[i] - anchor_us >= span:
                        anchor_us, anchor_row, taken = int(us[i]), i + 1, 0
                    end = lo + int(np.searchsorted(us[lo:hi], anchor_us + span, side="left"))
                    end = max(min(hi, end, i + limit - taken), i + 1)
                    out_us[i:end], at_row[i:end] = anchor_us, anchor_row
                    taken += end - i
                    i = end
            ties = batch.column(tie)
            known = pa.concat_arrays([pa.array([anchor_id], ties.type), ties])
            anchor_id = known[anchor_row].as_py()
            last_key, last_us = [batch.column(k)[n - 1].as_py() for k in keys], int(us[n - 1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out_us), known.take(pa.array(at_row))], names=[*batch.schema.names, ANCHOR_US, ANCHOR_ID]
            )

    return label


def _chain_ordinary(df: DataFrame, keys: list[str], tie: str, span: int, max_count: int | None, gap: int | None) -> DataFrame:
    schema = StructType([*df.schema.fields, StructField(ANCHOR_US, LongType()), StructField(ANCHOR_ID, df.schema[tie].dataType)])
    return (
        df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, US, tie)
        .mapInArrow(_label_sorted(keys, tie, span, max_count, gap), schema)
    )


def _contract(keys: list[str]):
    """Per block of consecutive rows: for every row the first row of its chain beyond the block, as runs of equal exits."""

    def contract(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__rn")
        rn, out = pdf["__rn"].to_numpy(), pdf["__to"].to_numpy().copy()
        inside = out <= rn[-1]
        while inside.any():
            out[inside] = out[out[inside] - rn[0]]
            inside = out <= rn[-1]
        first = np.flatnonzero(np.concatenate([[True], out[1:] != out[:-1]]))
        runs = pdf[keys].iloc[: len(first)].copy()  # the keys are the same in the whole block
        runs["__rn"], runs["__exit"] = rn[first], out[first]
        return runs

    return contract


def _anchors_from_entry(keys: list[str]):
    """Per block: the rows of the chain from the block's entry row on."""

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__rn")
        rn, to = pdf["__rn"].to_numpy(), pdf["__to"].to_numpy()
        at, found = int(pdf["__entry"].iloc[0]), []
        while at <= rn[-1]:
            found.append(at)
            at = int(to[at - rn[0]])
        anchors = pdf[keys].iloc[: len(found)].copy()
        anchors["__rn"] = found
        return anchors

    return follow


def _next_anchors(df: DataFrame, keys: list[str], tie: str, span: int, max_count: int | None, gap: int | None, slices: int | None) -> DataFrame:
    """Rows with their number in the key (``__rn``), the number of the next anchor if they are one (``__to``) and their block."""
    numbered = Ordered(df, keys, [US, tie], slices).scan(__rn=running_count(), __prev=previous(US))
    if gap is not None:
        numbered = numbered.with_column("__break", F.when(F.col(US) - F.col("__prev") > gap, F.col("__rn"))).scan(
            __next_break=next_known("__break")
        )
    rows = stored(numbered.result(), "chain-rows")

    # first row at or after the row's time + span: probes sort before rows of the same time
    marks = rows.select(*keys, US, F.lit(1).alias("__kind"), "__rn").unionByName(
        rows.select(*keys, (F.col(US) + F.lit(span)).alias(US), F.lit(0).alias("__kind"), "__rn", F.struct(*rows.columns).alias("__row")),
        allowMissingColumns=True,
    )
    is_row = F.col("__kind") == 1
    probed = (
        Ordered(marks, keys, [US, "__kind", "__rn"], slices)
        .scan(__next=next_known(F.when(is_row, F.col("__rn")))).result().filter(~is_row).select("__row.*", "__next")
    )
    candidates = [F.col("__next"), F.lit(NO_ROW)]
    if max_count is not None:
        last = rows.groupBy(*keys).agg(F.max("__rn").alias("__last"))  # one row per hot key
        probed = probed.join(F.broadcast(last), keys)
        full = F.col("__rn") + F.lit(max_count)
        candidates.append(F.when(full <= F.col("__last"), full))
    if gap is not None:
        candidates.append(F.col("__next_break"))
    pointed = probed.select(*df.columns, "__rn", F.least(*candidates).alias("__to"), _block("__rn").alias("__block"))
    return stored(pointed, "chain-pointers")


def _block(rn: str) -> Column:
    return F.floor((F.col(rn) - 1) / F.lit(BLOCK)).cast("bigint")


def _chain_hot(df: DataFrame, keys: list[str], tie: str, span: int, max_count: int | None, gap: int | None, slices: int | None) -> DataFrame:
    rows = _next_anchors(df, keys, tie, span, max_count, gap, slices)
    key_fields = [df.schema[k] for k in keys]
    number = StructField("__rn", LongType())

    # chains shortened to one step per block; only rows where a chain may enter a block stay
    blocks = rows.select(*keys, "__block", "__rn", "__to").groupBy(*keys, "__block")
    runs = stored(blocks.applyInPandas(_contract(keys), StructType([*key_fields, number, StructField("__exit", LongType())])), "chain-runs")
    entries = (
        runs.filter(F.col("__exit") < NO_ROW).select(*keys, F.col("__exit").alias("__rn"))
        .unionByName(rows.filter(F.col("__rn") == 1).select(*keys, "__rn")).distinct()
    )
    both = runs.withColumn("__kind", F.lit(0)).unionByName(entries.withColumn("__kind", F.lit(1)), allowMissingColumns=True)
    steps = (
        Ordered(both, keys, ["__rn", "__kind"], slices).scan(__to=latest("__exit")).result()
        .filter(F.col("__kind") == 1).select(*keys, "__rn", "__to")
    )
    jump = stored(steps, "chain-jump")

    reached = stored(jump.filter(F.col("__rn") == 1).select(*keys, "__rn"), "chain-reached")
    for _ in range(MAX_ROUNDS):
        found = stored(reached.join(jump.filter(F.col("__to") < NO_ROW), [*keys, "__rn"]).select(*keys, F.col("__to").alias("__rn")), "chain-found")
        if found.isEmpty():
            break
        reached = reached.unionByName(found)
        onward = jump.select(*keys, F.col("__rn").alias("__to"), F.col("__to").alias("__beyond"))
        jump = stored(jump.join(onward, [*keys, "__to"]).select(*keys, "__rn", F.col("__beyond").alias("__to")), "chain-jump")
    else:
        raise RuntimeError("next-anchor pointers do not move forward")

    entry = reached.select(*keys, _block("__rn").alias("__block"), F.col("__rn").alias("__entry"))
    anchors = (
        rows.select(*keys, "__block", "__rn", "__to").join(entry, [*keys, "__block"]).groupBy(*keys, "__block")
        .applyInPandas(_anchors_from_entry(keys), StructType([*key_fields, number])).withColumn("__is_anchor", F.lit(True))
    )
    anchor = F.when(F.col("__is_anchor"), F.struct(F.col(US).alias("us"), F.col(tie).alias("id")))
    return (
        Ordered(rows.join(anchors, [*keys, "__rn"], "left"), keys, [US, tie], slices).scan(__anchor=latest(anchor)).result()
        .withColumn(ANCHOR_US, F.col("__anchor.us")).withColumn(ANCHOR_ID, F.col("__anchor.id"))
        .select(*df.columns, ANCHOR_US, ANCHOR_ID)
    )


def chain(df: DataFrame, keys: Sequence[str], ts: str, tie: str, max_span_us: int, max_count: int | None = None,
          gap_us: int | None = None, slices: int | None = None) -> DataFrame:
    """Adds ``anchor_ts`` and ``anchor_id`` (the tie-break value of the anchor row, of its own type). NULL keys are keys like any other."""
    kind = df.schema[ts].dataType
    rest = [c for c in df.columns if c not in (ts, tie)]
    timed = df.select(key_struct(keys).alias(_ONE), micros(ts).alias(US), tie, F.struct(*rest).alias(_REST))
    hot = hot_keys(timed, _ONE, slices)
    if hot is None:
        labelled = _chain_ordinary(timed, [_ONE], tie, max_span_us, max_count, gap_us)
    else:
        whole, parted = (timed.join(F.broadcast(hot), _ONE, how) for how in ("left_anti", "left_semi"))
        labelled = _chain_ordinary(whole, [_ONE], tie, max_span_us, max_count, gap_us).unionByName(
            _chain_hot(parted, [_ONE], tie, max_span_us, max_count, gap_us, slices))
    return (
        labelled.select(f"{_REST}.*", tie, from_micros(US).cast(kind).alias(ts), from_micros(ANCHOR_US).cast(kind).alias("anchor_ts"), ANCHOR_ID)
        .select(*df.columns, "anchor_ts", ANCHOR_ID)
    )


def bounded_sessions(df: DataFrame, keys: Sequence[str], ts: str, tie: str, gap: str, bound: str, slices: int | None = None) -> DataFrame:
    """Gap sessions whose span (gap included) stays strictly below ``bound``; the session starts at ``anchor_ts``."""
    gap_us = interval_us(gap)
    return chain(df, keys, ts, tie, interval_us(bound) - gap_us, gap_us=gap_us, slices=slices)


def first_per_ttl(df: DataFrame, keys: Sequence[str], ts: str, tie: str, ttl: str, slices: int | None = None) -> DataFrame:
    """Rows kept when repeats of a key within ``ttl`` of the last kept row are dropped."""
    chained = chain(df, keys, ts, tie, interval_us(ttl), slices=slices)
    kept = (F.col(ts) == F.col("anchor_ts")) & (F.col(tie) == F.col(ANCHOR_ID))
    return chained.filter(kept).drop("anchor_ts", ANCHOR_ID)


def count_or_delay(df: DataFrame, keys: Sequence[str], ts: str, tie: str, max_count: int, delay: str, slices: int | None = None) -> DataFrame:
    """Batches closed at ``max_count`` rows or ``delay`` after their first row."""
    return chain(df, keys, ts, tie, interval_us(delay), max_count=max_count, slices=slices)
