"""Named functions for SQL text: temporary SQL functions, so queries that call them stay in generated code.

``register(spark)`` defines them in a session (again without harm). Overloads are default arguments; ``split_pair`` is a table
function for LATERAL.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from weirworks.functions.expr import EARTH_RADIUS_KM

SCALAR = {
    # metres between two points on a great circle; kilometres are rounded to 4 decimals first
    "geo_distance(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE":
        f"round({2 * EARTH_RADIUS_KM}D * asin(sqrt(pow(sin((radians(lat1) - radians(lat2)) / 2), 2)"
        " + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin((radians(lon1) - radians(lon2)) / 2), 2))), 4) * 1000",
    # text of a time in milliseconds; a missing time is the text null
    "date_text(ms BIGINT, pattern STRING DEFAULT 'yyyy-MM-dd') RETURNS STRING": "coalesce(date_format(timestamp_millis(ms), pattern), 'null')",
    # whole seconds from the first time to the second, truncated toward zero
    "seconds_between(earlier TIMESTAMP_NTZ, later TIMESTAMP_NTZ) RETURNS BIGINT":
        "(unix_micros(CAST(later AS TIMESTAMP)) - unix_micros(CAST(earlier AS TIMESTAMP))) DIV 1000000",
    "add_seconds(at TIMESTAMP_NTZ, seconds INT DEFAULT 30) RETURNS TIMESTAMP_NTZ": "at + make_dt_interval(0, 0, 0, seconds)",
    "strict_upper(text STRING) RETURNS STRING": "if(length(trim(coalesce(text, ''))) > 0, upper(text), raise_error('text must not be blank'))",
    "map_field(fields MAP<STRING, STRING>, name STRING) RETURNS STRING": "try_element_at(fields, name)",
    "map_number(fields MAP<STRING, STRING>, name STRING) RETURNS DOUBLE": "try_cast(try_element_at(fields, name) AS DOUBLE)",
}
TABLE = {
    # 'a#b' as one row of two columns; text without the separator gives no row
    "split_pair(data STRING, sep STRING DEFAULT '#') RETURNS TABLE (name STRING, num INT)":
        "SELECT get(p, 0), try_cast(get(p, 1) AS INT) FROM (SELECT split(data, concat('\\\\Q', sep, '\\\\E'), -1) AS p) WHERE contains(data, sep)",
}


def register(spark: SparkSession) -> None:
    for head, body in (SCALAR | TABLE).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
