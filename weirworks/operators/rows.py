"""Projections, filters, parsing and row-level fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirworks.functions.expr import col, map_number, map_text, text_map


def parse_delimited(df: DataFrame, text: str, schema: dict[str, str], sep: str = ",", defaults: dict | None = None) -> DataFrame:
    """``"a,b,c"`` lines to typed columns; a missing or unreadable field takes its default or NULL."""
    parts = F.split(F.col(text), f"\\Q{sep}\\E", -1)
    defaults = defaults or {}
    fields = []
    for i, (name, kind) in enumerate(schema.items()):
        value = F.get(parts, F.lit(i)).try_cast(kind)
        if name in defaults:
            value = F.coalesce(value, F.lit(defaults[name]).cast(kind))
        fields.append(value.alias(name))
    return df.select(*fields)


def tokens(df: DataFrame, text: str, pattern: str = "\\s+", out: str = "word") -> DataFrame:
    """One row per non-empty token; other columns are kept."""
    return df.withColumn(out, F.explode(F.split(F.col(text), pattern))).filter(F.length(out) > 0).drop(text)


def minute_key_lines(df: DataFrame, time_text: str, dims: list[str], amount: str) -> DataFrame:
    """Key of the first 16 characters of the time text and the dimensions, with a count of one and the amount."""
    key = F.concat_ws("_", F.substring(F.col(time_text), 1, 16), *[F.col(d).cast("string") for d in dims])
    return df.withColumn("biz_key", key).withColumn("cnt", F.lit(1).cast("bigint")).withColumn("amount", F.col(amount))


def tagged_fan_out(df: DataFrame, condition: Column, side: str = "side", main: str = "main") -> DataFrame:
    """Every row to ``main``; rows meeting ``condition`` also to ``side``. One pass over the input."""
    outputs = F.when(condition, F.array(F.lit(main), F.lit(side))).otherwise(F.array(F.lit(main)))
    return df.withColumn("output", F.explode(outputs))


def json_records(df: DataFrame, value: str, ddl: str, keep: list[str] | None = None) -> DataFrame:
    """JSON text to typed columns; a field missing from the text is NULL."""
    parsed = df.withColumn("__r", F.from_json(F.col(value), ddl))
    return parsed.select(*(keep or []), "__r.*")


def json_good_and_bad(df: DataFrame, value: str, ddl: str) -> DataFrame:
    """JSON text to typed columns plus ``is_dirty``: the text could not be parsed."""
    full = f"{ddl}, _corrupt STRING"
    parsed = F.from_json(F.col(value), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return (
        df.withColumn("__r", parsed)
        .withColumn("is_dirty", F.col("__r._corrupt").isNotNull())
        .select(*[c for c in df.columns if c != value], "is_dirty", "__r.*")
        .drop("_corrupt")
    )


def matches_map_condition(fields_json: str, text_equals: dict[str, str] | None = None, number_above: dict[str, float] | None = None) -> Column:
    """Conjunction over a JSON object read as a map; a missing or unreadable entry makes it false."""
    m = text_map(fields_json)
    condition = F.lit(True)
    for key, value in (text_equals or {}).items():
        condition = condition & (map_text(m, key) == F.lit(value))
    for key, bound in (number_above or {}).items():
        condition = condition & (map_number(m, key) > F.lit(bound))
    return F.coalesce(condition, F.lit(False))


def split_pair(df: DataFrame, text: str, sep: str, left: str, right: str) -> DataFrame:
    """``a#b`` to two columns; rows without the separator give no row."""
    parts = F.split(F.col(text), f"\\Q{sep}\\E", -1)
    return df.filter(F.col(text).contains(sep)).select(
        *[c for c in df.columns if c != text], F.get(parts, F.lit(0)).alias(left), F.get(parts, F.lit(1)).alias(right)
    )


def unnest(df: DataFrame, array: str, out: str) -> DataFrame:
    return df.withColumn(out, F.explode(F.col(array))).drop(array)


def to_celsius(fahrenheit: Column | str) -> Column:
    return (col(fahrenheit) - 32) * (F.lit(5.0) / F.lit(9.0))


def delimited_line(*columns: str, sep: str = ",") -> Column:
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in columns])


def tagged_union(**parts: DataFrame) -> DataFrame:
    """Tables of different shape in one, with the part's name in ``src``; absent columns are NULL."""
    tagged = [df.withColumn("src", F.lit(name)) for name, df in parts.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
