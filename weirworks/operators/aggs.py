"""Keyed and global aggregates. Grouped forms combine map-side; running forms use ordered scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirworks.functions.expr import col
from weirworks.operators.ordered import Ordered, running_count, total

LIST_CHUNK = 1000


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None, count: str | None = None, **sums: Column | str) -> DataFrame:
    """The new totals of a key after each of its rows."""
    scans = {name: total(value) for name, value in sums.items()}
    if count:
        scans[count] = running_count()
    return Ordered(df, keys, order, slices).scan(**scans).result()


def cube_with_flags(df: DataFrame, dims: Sequence[str], **aggs: Column) -> DataFrame:
    """All grouping combinations of ``dims`` with a ``g_<dim>`` flag (1 where the dimension is rolled up)."""
    flags = [F.grouping(d).cast("int").alias(f"g_{d}") for d in dims]
    return df.cube(*dims).agg(*flags, *[a.alias(n) for n, a in aggs.items()])


def rollup_with_flags(df: DataFrame, dims: Sequence[str], **aggs: Column) -> DataFrame:
    flags = [F.grouping(d).cast("int").alias(f"g_{d}") for d in dims]
    return df.rollup(*dims).agg(*flags, *[a.alias(n) for n, a in aggs.items()])


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], dims: Sequence[str], **aggs: Column) -> DataFrame:
    flags = [F.grouping(d).cast("int").alias(f"g_{d}") for d in dims]
    groups = [[F.col(c) for c in s] for s in sets]
    return df.groupingSets(groups, *dims).agg(*flags, *[a.alias(n) for n, a in aggs.items()])


def exact_distinct(df: DataFrame, keys: Sequence[Column | str], value: str, out: str) -> DataFrame:
    """Distinct values per group in two aggregations: distinct (group, value) pairs spread over all
    tasks first, then a map-side combined count. No group is ever held as one set."""
    names = [f"k{i}" if not isinstance(k, str) else k for i, k in enumerate(keys)]
    pairs = df.select(*[col(k).alias(n) for k, n in zip(keys, names)], value).filter(F.col(value).isNotNull()).distinct()
    return pairs.groupBy(*names).agg(F.count(F.lit(1)).alias(out))


def bitmap_distinct(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact distinct count of non-negative integers by bitmaps of 32768 values each; the bitmaps merge."""
    bitmaps = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.bitmap_bucket_number(value).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("__bits")
    )
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("__bits")).cast("bigint").alias(out))


def running_distinct(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, slices: int | None = None) -> DataFrame:
    """Number of distinct known values so far, after each row of a key. NULL keys are a key; NULL values don't count, their rows stay."""
    seen = Ordered(df, [*keys, value], order, slices).scan(__seen=running_count()).result()
    is_new = ((F.col("__seen") == 1) & F.col(value).isNotNull()).cast("bigint")
    return Ordered(seen.withColumn("__new", is_new).drop("__seen"), keys, order, slices).scan(**{out: total("__new")}).result().drop("__new")


def sketch_distinct(df: DataFrame, keys: Sequence[str], part: Sequence[str], value: str, out: str, log_size: int = 20) -> DataFrame:
    """Approximate distinct count: one mergeable sketch per (key, part), then the union per key.

    2^20 registers keep the relative error near 0.001.
    """
    sketches = df.groupBy(*keys, *part).agg(F.hll_sketch_agg(value, log_size).alias("__sketch"))
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("__sketch")).alias(out))


def weighted_average(value: Column | str, weight: Column | str) -> Column:
    """Integer weighted mean truncated toward zero; NULL where the weights sum to zero."""
    v, w = col(value).cast("bigint"), col(weight).cast("bigint")
    return F.call_function("div", F.sum(v * w), F.nullif(F.sum(w), F.lit(0)))


def group_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, chunk: int = LIST_CHUNK, slices: int | None = None) -> DataFrame:
    """Ordered value lists of whole groups, at most ``chunk`` values per row.

    A group longer than that takes several rows, numbered by ``chunk_no``; together
    they hold every value, and no single row or task holds an unbounded group.
    """
    numbered = Ordered(df, keys, order, slices).scan(__n=running_count()).result()
    entry = F.struct(F.col("__n").alias("n"), value.alias("v"))
    return (
        numbered.withColumn("chunk_no", F.floor((F.col("__n") - 1) / F.lit(chunk)).cast("bigint"))
        .groupBy(*keys, "chunk_no").agg(F.array_sort(F.collect_list(entry)).alias("__list"))
        .select(*keys, "chunk_no", F.col("__list.v").alias(out))
    )


def latest_then_count(df: DataFrame, entity: str, value: str, order: Sequence[str], out: str) -> DataFrame:
    """Each entity's latest value, then the number of entities per value."""
    last = df.groupBy(entity).agg(F.max_by(value, F.struct(*order)).alias(value))
    return last.groupBy(value).agg(F.count(F.lit(1)).alias(out))
