"""Joins: window, interval, as-of, lookup, rule, configuration and timeout joins.

No side is force-broadcast here except literal rule tables: dimension tables may
grow with the data, so the choice is left to the size check of Catalyst
(``autoBroadcastJoinThreshold``) and adaptive execution, which otherwise use a
sort-merge join and split skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weirworks.functions.expr import interval_us, micros
from weirworks.operators.aggs import group_lists
from weirworks.operators.ordered import Ordered, latest, next_known, scanned_by_key, total


def with_window(df: DataFrame, ts: str, size: str, offset: str = "0 seconds", out: str = "w") -> DataFrame:
    return df.withColumn(out, F.window(ts, size, size, offset))


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, size: str,
                offset: str = "0 seconds", how: str = "inner", defaults: dict | None = None) -> DataFrame:
    """Equi-join of rows that fall in the same tumbling window. Other columns of the sides must not share names."""
    a, b = with_window(left, left_ts, size, offset), with_window(right, right_ts, size, offset)
    if not defaults:
        return a.join(b, [*keys, "w"], how)
    joined = a.withColumn("__in_left", F.lit(True)).join(b.withColumn("__in_right", F.lit(True)), [*keys, "w"], how)
    missing = {c: "__in_left" if c in left.columns else "__in_right" for c in defaults}
    return _default_where_missing(joined, defaults, missing).drop("__in_left", "__in_right")


def _default_where_missing(df: DataFrame, defaults: dict, flags: dict[str, str]) -> DataFrame:
    """Defaults for columns of rows without a match (``flags`` names the hit flag); a stored NULL of a match stays NULL."""
    return df.withColumns({c: F.when(F.col(flags[c]).isNull(), F.lit(v).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in defaults.items()})


def cogroup_lists(left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence[str], right_order: Sequence[str],
                  left_value: Column, right_value: Column, size: str, chunk: int = 1000) -> DataFrame:
    """Both sides' value lists per key and window, also where one side is empty; long groups take several rows."""
    groups = [*keys, "w"]
    a = group_lists(with_window(left, left_order[0], size).withColumn("w", F.col("w.start")), groups, left_order, left_value, "left_list", chunk)
    b = group_lists(with_window(right, right_order[0], size).withColumn("w", F.col("w.start")), groups, right_order, right_value, "right_list", chunk)
    return a.join(b, [*groups, "chunk_no"], "full")


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, lower: str, upper: str,
                  inclusive: bool = True, how: str = "inner", bucketed: bool = False) -> DataFrame:
    """Rows of equal key with ``right_ts - left_ts`` between the bounds (durations such as ``'-4 hours'``).

    ``bucketed`` adds a time bucket of the band's width to the join key (each left
    row goes to the two buckets its band touches): a key with very many rows is
    then compared per bucket and spread over tasks. For keys with few rows each
    (an order number) the plain form moves less data. Batch inner joins only.
    """
    lo, hi = interval_us(lower), interval_us(upper)
    if not bucketed:  # times compared as columns, so that streams find the watermarks
        start, stop = (F.expr(f"{left_ts} + make_dt_interval(0, 0, 0, {x / 10**6:.6f})") for x in (lo, hi))
        r = F.col(right_ts)
        inside = (r >= start) & (r <= stop) if inclusive else (r > start) & (r < stop)
        same = [left[k] == right[k] for k in keys]
        joined = left.join(right, reduce(lambda a, b: a & b, [*same, inside]), how)
        return reduce(lambda d, k: d.drop(right[k]), keys, joined) if how != "right" else joined
    if how != "inner":
        raise ValueError("the bucketed form is an inner join")
    width = max(hi - lo, 1)
    at = micros(left_ts)
    first, last_ = F.floor((at + F.lit(lo)) / F.lit(width)), F.floor((at + F.lit(hi)) / F.lit(width))
    a = left.withColumn("__b", F.explode(F.sequence(first.cast("bigint"), last_.cast("bigint"))))
    c = right.withColumn("__b", F.floor(micros(right_ts) / F.lit(width)).cast("bigint"))
    apart = micros(right_ts) - micros(left_ts)
    inside = (apart >= lo) & (apart <= hi) if inclusive else (apart > lo) & (apart < hi)
    return a.join(c, [*keys, "__b"]).filter(inside).drop("__b")


def _versions_union(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, left_tie: str, right_ts: str, right_tie: str, values: Sequence[str]) -> DataFrame:
    version = F.struct(*[F.col(v) for v in values], F.col(right_ts).alias("__version_ts"))
    rights = right.select(*keys, F.col(right_ts).alias("__at"), F.lit(0).alias("__kind"), F.col(right_tie).alias("__tie"), version.alias("__right"))
    lefts = left.select(*keys, F.col(left_ts).alias("__at"), F.lit(1).alias("__kind"), F.col(left_tie).alias("__tie"), F.struct(*left.columns).alias("__left"))
    return lefts.unionByName(rights, allowMissingColumns=True)


ASOF_ORDER = ["__at", "__kind", "__tie"]  # versions sort before rows of the same time


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, left_tie: str, right_ts: str, right_tie: str,
              values: Sequence[str], how: str = "inner", slices: int | None = None) -> DataFrame:
    """Each left row with the right row of its key in force at its time (the latest not after it)."""
    both = _versions_union(left, right, keys, left_ts, left_tie, right_ts, right_tie, values)
    scanned = Ordered(both, keys, ASOF_ORDER, slices).scan(__r=latest("__right")).result().filter(F.col("__kind") == 1)
    if how == "inner":
        scanned = scanned.filter(F.col("__r").isNotNull())
    return scanned.select("__left.*", *[F.col(f"__r.{v}").alias(v) for v in values])


def buffered_asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, left_tie: str, right_ts: str, right_tie: str,
                       values: Sequence[str], slices: int | None = None) -> DataFrame:
    """As ``asof_join``; a row with no version yet waits for the key's first one. ``emitted_at`` is when it is complete."""
    both = _versions_union(left, right, keys, left_ts, left_tie, right_ts, right_tie, values)
    scanned = (
        Ordered(both, keys, ASOF_ORDER, slices).scan(__back=latest("__right"), __ahead=next_known("__right")).result()
        .filter(F.col("__kind") == 1).withColumn("__r", F.coalesce("__back", "__ahead")).filter(F.col("__r").isNotNull())
    )
    return scanned.select(
        "__left.*", *[F.col(f"__r.{v}").alias(v) for v in values],
        F.greatest(F.col("__at"), F.col("__r.__version_ts")).alias("emitted_at"))


def lookup(df: DataFrame, dimension: DataFrame, on: Sequence[str], mode: str = "inner", defaults: dict | None = None) -> DataFrame:
    """Enrich rows from a dimension table. What happens to a row without match:

    ``inner`` drops it, ``left`` keeps it with ``defaults``, ``flag`` keeps it with ``lookup_failed`` true.
    """
    if mode == "inner":
        return df.join(dimension, list(on))
    if mode == "flag":
        found = dimension.withColumn("__hit", F.lit(True))
        return df.join(found, list(on), "left").withColumn("lookup_failed", F.col("__hit").isNull()).drop("__hit")
    if mode == "left":
        out = df.join(dimension.withColumn("__hit", F.lit(True)), list(on), "left")
        return _default_where_missing(out, defaults or {}, dict.fromkeys(defaults or {}, "__hit")).drop("__hit")
    raise ValueError(mode)


def rule_semi_join(df: DataFrame, rules: DataFrame, on: str, ts: str, rule_ts: str, active: str | None = None) -> DataFrame:
    """Rows for whose type a rule was announced earlier: the first announcement per type decides."""
    if active:
        rules = rules.filter(F.col(active))
    first = rules.groupBy(on).agg(F.min(rule_ts).alias("__since"))
    return df.join(first, on).filter(F.col("__since") <= F.col(ts)).drop("__since")


def in_force(ts: Column | str, versions: Sequence[tuple[str, object]], default: object = None) -> Column:
    """Value of the last version announced at or before the row's time, from a literal, time-ordered version list."""
    at = F.col(ts) if isinstance(ts, str) else ts
    chosen = F.lit(default)
    for since, value in versions:
        chosen = F.when(at >= F.lit(since).cast("timestamp_ntz"), F.lit(value)).otherwise(chosen)
    return chosen


def paths_to_event(df: DataFrame, keys: Sequence[str], order: Sequence[str], kind: str, end_kind: str, kinds: Sequence[str], slices: int | None = None) -> DataFrame:
    """One row per closed path: the events since the previous ``end_kind`` event up to and including the next one,
    with the path's length and the number of events of each kind."""
    ends = F.when(F.col(kind) == end_kind, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    numbered = scanned_by_key(df, keys, order, lambda seq: seq.with_column("__end", ends).scan(__ends=total("__end")), slices)
    counts = [F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in kinds]
    return (
        numbered.withColumn("path_no", F.col("__ends") - F.col("__end"))
        .groupBy(*keys, "path_no")
        .agg(F.count(F.lit(1)).alias("path_length"), *counts, F.max("__end").alias("__closed"), F.max_by(order[0], "__end").alias("end_ts"))
        .filter(F.col("__closed") == 1).drop("__closed")
    )


def match_or_timeout(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, wait_days: Column,
                     slices: int | None = None) -> DataFrame:
    """Each left row with the first right row of its key at or after its time: ``on_time`` then, if that is within the
    row's own waiting time, else ``timeout`` at the deadline.

    An ordered scan over both sides finds the first right row without pairing a left row with all right rows of its key.
    """
    waiting = left.withColumn("deadline", F.col(left_ts) + F.make_dt_interval(days=wait_days.cast("int")))
    rights = right.select(*keys, F.col(right_ts).alias("__at"), F.lit(1).alias("__kind"))
    lefts = waiting.select(*keys, F.col(left_ts).alias("__at"), F.lit(0).alias("__kind"), F.struct(*waiting.columns).alias("__left"))
    both = lefts.unionByName(rights, allowMissingColumns=True).withColumn("__tie", F.monotonically_increasing_id())  # cuts bursts
    arrived = F.when(F.col("__kind") == 1, F.col("__at"))
    in_time = F.coalesce(F.col("__first") <= F.col("deadline"), F.lit(False))
    return (
        Ordered(both, keys, ["__at", "__kind", "__tie"], slices).scan(__first=next_known(arrived)).result()
        .filter(F.col("__kind") == 0).select("__left.*", "__first")
        .withColumn("status", F.when(in_time, "on_time").otherwise("timeout"))
        .withColumn("event_at", F.when(in_time, F.col("__first")).otherwise(F.col("deadline"))).drop("__first")
    )


def version_lookup(df: DataFrame, ts: str, tie: str, versions: DataFrame, dimension: DataFrame, on: Sequence[str], mode: str = "flag",
                   defaults: dict | None = None, slices: int | None = None) -> DataFrame:
    """Enrich rows from the dimension version in force at their time: the latest of ``versions`` (since, version) not after it.

    Versions replace one another as a whole: a key that the version in force lacks has no match, whatever older versions hold.
    Rows before the first version are dropped.
    """
    known = asof_join(df, versions.withColumn("__order", F.col("version")), [], ts, tie, "since", "__order", ["version"], slices=slices)
    return lookup(known, dimension, ["version", *on], mode, defaults)
