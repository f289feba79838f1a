"""Rules as a second stream: announced while the event stream runs, in force from their time on.

The rule stream has a query of its own that writes announcements to a shared table (append, exactly once). The event stream reads
the part of that table that matters to a micro-batch: the announcement in force at its first row, and those up to its last
one; min/max statistics of the files leave the others unread. So rules are swapped between and inside micro-batches without a restart,
and a micro-batch that runs again sees the same rules, as announcements carry the time from which they hold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from weirworks.operators.joins import asof_join
from weirworks.sources import files


def announced(batch: DataFrame, log: str, schema: StructType, ts: str, since: str) -> DataFrame:
    """Announcements that are in force at some row of ``batch``."""
    spark = batch.sparkSession
    if not files.exists(spark, log):
        return spark.createDataFrame([], schema)
    low, high = batch.agg(F.min(ts), F.max(ts)).first()
    known = spark.read.schema(schema).parquet(log).filter(F.col(since) <= F.lit(high).cast(schema[since].dataType))
    first = known.filter(F.col(since) <= F.lit(low).cast(schema[since].dataType)).agg(F.max(since)).first()[0]
    return known if first is None else known.filter(F.col(since) >= F.lit(first).cast(schema[since].dataType))


def with_rules(log: str, schema: StructType, keys: Sequence[str], ts: str, tie: str, since: str, rule_tie: str, values: Sequence[str],
               apply: Callable[[DataFrame], DataFrame], path: str):
    """``foreachBatch`` writer: each row with ``values`` of the announcement in force at its time (NULL before the first), through ``apply``.

    The result of a micro-batch replaces its own folder below ``path``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        joined = asof_join(batch, announced(batch, log, schema, ts, since), keys, ts, tie, since, rule_tie, values, how="left")
        apply(joined).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
