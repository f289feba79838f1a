"""Live metrics of a running query: observed figures of each micro-batch, gathered by a listener into a table.

``observed`` attaches counters, a meter (rows, from which a rate follows by the batch's duration) and histograms by fixed
bounds; they are computed where the rows pass, without another job. ``MetricsLog`` listens, and keeps a bounded number of
batches before it writes them as files, so a query may run for ever.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from weirworks.session import scratch_dir

SCHEMA = "query STRING, batch_id BIGINT, metric STRING, bucket BIGINT, n BIGINT, batch_ms BIGINT"


def observed(df: DataFrame, name: str, counters: dict[str, Column], histograms: dict[str, tuple[Column, Sequence[int]]] | None = None) -> DataFrame:
    """``counters``: conditions whose rows are counted. ``histograms``: values and ascending bounds; bucket i counts values below bound i,
    the last one all others; NULL values are in none."""
    figures = [F.count_if(c).alias(k) for k, c in counters.items()]
    for k, (value, bounds) in (histograms or {}).items():
        edges = [None, *bounds, None]
        for i, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
            inside = value.isNotNull()
            inside = inside if low is None else inside & (value >= low)
            inside = inside if high is None else inside & (value < high)
            figures.append(F.count_if(inside).alias(f"{k}#{i}"))
    return df.observe(name, *figures)


class MetricsLog(StreamingQueryListener):
    def __init__(self, spark: SparkSession, name: str, keep: int = 1_000):
        self.spark, self.name, self.keep = spark, name, keep
        self.path, self.held, self.files = scratch_dir(spark, "metrics"), [], 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        figures = progress.observedMetrics.get(self.name)
        if figures is None:
            return
        took = int(progress.durationMs.get("triggerExecution", 0))
        for key, n in figures.asDict().items():
            metric, _, bucket = key.partition("#")
            self.held.append((str(progress.id), progress.batchId, metric, int(bucket or -1), int(n or 0), took))
        if len(self.held) >= self.keep:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self) -> None:
        held, self.held = self.held, []
        if held:
            self.spark.createDataFrame(held, SCHEMA).coalesce(1).write.parquet(f"{self.path}/part={self.files}")
            self.files += 1

    def table(self) -> DataFrame:
        """One row per batch, metric and bucket (-1: a counter), after all events so far have been delivered."""
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        self.flush()
        if not self.files:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/part={i}" for i in range(self.files)])

    def __enter__(self) -> "MetricsLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
