"""Run a streaming DataFrame to the end of its available input."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from weirworks.session import ROCKSDB, scratch_dir
from weirworks.sources.upserts import UpsertTable

ONCE = (None,)


def use_rocksdb(df: DataFrame) -> None:
    """State goes to RocksDB, so it may exceed executor memory."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def run_all(writer, checkpoint: str, feed: Iterable = ONCE) -> None:
    """One run over what is available after each step of ``feed`` (a ``Replay``, or once), all from one checkpoint."""
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    for _ in feed:
        writer.start().awaitTermination()


def run_to_files(df: DataFrame, path: str, checkpoint: str | None = None, partition: str | None = None, feed: Iterable = ONCE) -> str:
    """Append-mode run into parquet files (exactly-once through the file sink's log); returns the checkpoint folder."""
    use_rocksdb(df)
    checkpoint = checkpoint or scratch_dir(df.sparkSession, "checkpoint")
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition:
        writer = writer.partitionBy(partition)
    run_all(writer, checkpoint, feed)
    return checkpoint


def run_append(df: DataFrame, label: str = "stream", checkpoint: str | None = None, feed: Iterable = ONCE) -> DataFrame:
    """Append-mode run; the emitted rows as a table."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    run_to_files(df, path, checkpoint, feed=feed)
    return spark.read.schema(df.schema).parquet(path)


def run_to_changes(df: DataFrame, keys: list[str], label: str = "changes", checkpoint: str | None = None, feed: Iterable = ONCE) -> DataFrame:
    """Update-mode run upserted by key; the final table."""
    use_rocksdb(df)
    spark = df.sparkSession
    table = UpsertTable(spark, scratch_dir(spark, label), df.schema, keys)
    run_all(df.writeStream.outputMode("update").foreachBatch(table.write), checkpoint or scratch_dir(spark, "checkpoint"), feed)
    return table.read()


def run_batches(df: DataFrame, write, checkpoint: str | None = None, feed: Iterable = ONCE) -> None:
    """Append-mode run with a ``foreachBatch`` writer."""
    use_rocksdb(df)
    run_all(df.writeStream.outputMode("append").foreachBatch(write), checkpoint or scratch_dir(df.sparkSession, "checkpoint"), feed)
