"""Scalar column expressions. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6378.137  # fixed value


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def n_rows() -> Column:
    return F.count(F.lit(1))


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column (UTC session)."""
    return F.unix_micros(col(ts).cast("timestamp"))


def from_micros(us: Column | str) -> Column:
    return F.timestamp_micros(col(us)).cast("timestamp_ntz")


def interval_us(text: str) -> int:
    """Microseconds of a duration such as ``'5 minutes'``."""
    unit_us = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6,
               "hour": 3600 * 10**6, "day": 86400 * 10**6}
    number, unit = text.split()
    return int(number) * unit_us[unit.rstrip("s")]


def great_circle_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres; kilometres are rounded to 4 decimals first."""
    a1, a2 = F.radians(col(lat1)), F.radians(col(lat2))
    half_lat = (a1 - a2) / 2
    half_lon = (F.radians(col(lon1)) - F.radians(col(lon2))) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(half_lon), 2)
    return F.round(F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord)), 4) * 1000


def time_text(ts, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Formatted time; a missing time gives the text ``null``."""
    return F.coalesce(F.date_format(col(ts), pattern), F.lit("null"))


def seconds_between(earlier, later) -> Column:
    """Whole seconds from ``earlier`` to ``later``, truncated toward zero."""
    us = micros(later) - micros(earlier)
    return F.signum(us).cast("bigint") * F.floor(F.abs(us) / F.lit(10**6))


def strict_upper(text) -> Column:
    """Upper-case text; blank or missing text is an error."""
    c = col(text)
    return F.when(F.length(F.trim(F.coalesce(c, F.lit("")))) > 0, F.upper(c)).otherwise(
        F.raise_error(F.lit("text must not be blank")).cast("string")
    )


def item_at(array, position: int) -> Column:
    """1-based array element; NULL past the end."""
    return F.get(col(array), F.lit(position - 1))


def map_text(m, key: str) -> Column:
    return F.try_element_at(col(m), F.lit(key))


def map_number(m, key: str) -> Column:
    return map_text(m, key).try_cast("double")


def json_int(text, path: str) -> Column:
    return F.get_json_object(col(text), path).try_cast("int")


def text_map(json_text) -> Column:
    return F.from_json(col(json_text), "map<string,string>")


def seconds_after(ts, seconds: int) -> Column:
    return col(ts) + F.expr(f"INTERVAL {int(seconds)} SECONDS")


def floor_to(us, size: int | Column, offset: int | Column = 0) -> Column:
    """Start of the fixed-size bucket that contains ``us`` (microseconds), shifted by ``offset``."""
    size = size if isinstance(size, Column) else F.lit(size)
    offset = offset if isinstance(offset, Column) else F.lit(offset)
    return col(us) - F.pmod(col(us) - offset, size)
