"""Writers: bucketed files, change logs, chunked and multi-target sinks, JDBC."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from weirworks.functions.expr import interval_us
from weirworks.operators.greedy import chain
from weirworks.operators.ordered import KEY, Ordered, key_struct, running_count, scanned_by_key, total
from weirworks.session import stored
from weirworks.sources import files, small_files

HOUR_BUCKET = "yyyy-MM-dd-HH"
#: Writer options for very many small files. A local folder gets no checksum file beside each (four processes are started per file for the
#: permissions of both, which takes most of the time); a task that commits moves its files itself. Other file systems ignore the first two.
SMALL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true", "mapreduce.fileoutputcommitter.algorithm.version": "2"}


def write_time_buckets(df: DataFrame, ts: str, path: str, fmt: str = "parquet", pattern: str = HOUR_BUCKET,
                       records_per_file: int = 1_000_000, bucket: str = "bucket", **options: str) -> None:
    """Files in one folder per event-time bucket.

    The rebalance hint gives each bucket few files, and lets adaptive execution
    split a bucket that is far larger than the others.
    """
    out = df.withColumn(bucket, F.date_format(F.col(ts), pattern))
    if not df.isStreaming:
        out = out.hint("rebalance", F.col(bucket))
    out.write.partitionBy(bucket).options(maxRecordsPerFile=records_per_file, **options).format(fmt).save(path)


def rolling_parts(df: DataFrame, ts: str, tie: str, bucket: str, max_bytes: int, max_age: str, max_idle: str, slices: int | None = None) -> DataFrame:
    """Adds ``part``, the number of the file a rolling sink writes a row to, per bucket in time order.

    A file ends before a row that comes more than ``max_idle`` after the one before it or ``max_age`` or more after its first row, and
    before its rows' JSON text would pass ``max_bytes``. A row of half that size or more is refused.
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns))) + 1
    sized = df.withColumn("__size", size.cast("bigint"))
    largest = sized.agg(F.max("__size")).first()[0] or 0
    if 2 * largest > max_bytes:
        raise ValueError(f"rows of {largest} bytes don't fit files of {max_bytes} bytes")
    # both steps are stored: what follows reads them several times
    runs = stored(chain(sized, [bucket], ts, tie, interval_us(max_age), gap_us=interval_us(max_idle), slices=slices), "rolling-runs")
    run = [bucket, "anchor_ts", "anchor_id"]
    filled = scanned_by_key(runs, run, [ts, tie], lambda seq: seq.scan(__sum=total("__size")), slices)
    cut = F.floor((F.col("__sum") - F.col("__size")) / F.lit(max_bytes - largest)).cast("bigint")  # the row that starts in a share belongs to it
    cut = stored(filled.withColumn("__cut", cut), "rolling-cuts")
    first = cut.select(*run, "__cut").distinct()
    numbered = scanned_by_key(first, [bucket], ["anchor_ts", "anchor_id", "__cut"], lambda seq: seq.scan(part=running_count()), slices)
    file = key_struct([*run, "__cut"]).alias(KEY)  # a bucket or tie may be NULL
    return cut.withColumn(KEY, file).join(numbered.select(file, "part"), KEY).select(*df.columns, "part")


def write_rolling(df: DataFrame, ts: str, tie: str, path: str, max_bytes: int, max_age: str, max_idle: str, pattern: str = HOUR_BUCKET, **options: str) -> None:
    """JSON files below ``bucket=<text>/part=<number>``, one each, rolled by size, age and idle time. Rows without a time are in a bucket of their own.

    The time goes into the number of files, not into their bytes. So the number of tasks is given, which adaptive execution leaves alone, and
    files move to their place when they are whole (``small_files``, on a local file system) or when a task commits (``SMALL_FILES``), not one by one
    in the driver: the folder is complete once ``_SUCCESS`` is there.
    """
    timed = df.withColumn("bucket", F.coalesce(F.date_format(F.col(ts), pattern), F.lit("none"))).withColumn("__at", F.coalesce(F.col(ts), F.lit("1970-01-01").cast(df.schema[ts].dataType)))
    parts = rolling_parts(timed, "__at", tie, "bucket", max_bytes, max_age, max_idle).drop("__at")
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    placed = parts.repartition(tasks, "bucket", "part").sortWithinPartitions("bucket", "part", ts, tie)
    folder = files.local(spark, path)
    if folder is None or files.exists(spark, path) or options.keys() - small_files.TEXT_OPTIONS:
        placed.write.partitionBy("bucket", "part").options(**{**SMALL_FILES, **options}).json(path)
    else:
        small_files.write(placed, folder, "bucket", "part", options)
        files.mark(spark, f"{path}/_SUCCESS")


def read_rolling(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """The rows of ``write_rolling``. The folders are listed by tasks that read them (``small_files``, on a local file system), or found by a pattern
    and listed in one job instead of one per bucket."""
    empty = spark.createDataFrame([], schema)
    if not any(name.startswith("bucket=") for name in files.names(spark, path)):
        return empty
    folder = files.local(spark, path)
    if folder is not None and not options and small_files.readable(empty.schema, "bucket"):
        return small_files.read(spark, folder, "bucket", "part", empty.schema)
    return spark.read.schema(schema).options(basePath=path, **options).json(f"{path}/bucket=*/part=*").drop("part")


def stream_time_buckets(df: DataFrame, ts: str, path: str, checkpoint: str, pattern: str = HOUR_BUCKET, fmt: str = "parquet"):
    return (
        df.withColumn("bucket", F.date_format(F.col(ts), pattern))
        .writeStream.partitionBy("bucket").format(fmt).outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def append_changes(path: str):
    """``foreachBatch`` writer of an update-mode stream: one folder per micro-batch.

    A batch that is run again after a failure overwrites its own folder, so each
    change is stored once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def current_rows(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """Upserted table: for each key the row of its last micro-batch."""
    changes = spark.read.schema(StructType(list(schema.fields)).add("batch_id", "long")).parquet(path)
    rest = [c for c in schema.fieldNames() if c not in keys]
    return (
        changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("__row")).select(*keys, "__row.*")
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Last value per key by order columns (map-side combined, so a hot key is no bottleneck)."""
    return (
        df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("__row")).select(*keys, "__row.*")
    )


def write_targets(*targets):
    """``foreachBatch`` writer feeding several sinks: the batch is computed once and kept while all are written."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for target in targets:
                target(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def flush_chunks(df: DataFrame, order: list[str], size: int, slices: int | None = None) -> DataFrame:
    """Chunk number of every row when a sink flushes each ``size`` rows in arrival order."""
    numbered = Ordered(df, [], order, slices).scan(__n=running_count()).result()
    return numbered.withColumn("chunk_id", F.floor((F.col("__n") - 1) / F.lit(size)).cast("bigint")).drop("__n")


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], rows_per_statement: int = 1000, mode: str = "append") -> None:
    """``rows_per_statement=1`` sends every row on its own."""
    df.write.option("batchsize", rows_per_statement).jdbc(url, table, mode=mode, properties=properties)


def jdbc_batch_writer(url: str, table: str, properties: dict[str, str], rows_per_statement: int = 1000):
    """``foreachBatch`` writer with exactly-once effect: rows carry ``batch_id``, and a repeated batch is skipped.

    The commit marker in ``<table>_batches`` is written after the rows; rows of a
    batch that failed half-way have no marker, and readers join with the markers
    on (batch, attempt).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = (
            spark.read.format("jdbc").option("url", url).options(**properties)
            .option("query", f"select batch_id from {table}_batches where batch_id = {int(batch_id)}").load()
        )
        if not done.isEmpty():
            return
        attempt = uuid.uuid4().hex
        marked = batch.withColumn("batch_id", F.lit(batch_id)).withColumn("attempt", F.lit(attempt))
        write_jdbc(marked, url, table, properties, rows_per_statement)
        marker = spark.range(1).select(F.lit(batch_id).alias("batch_id"), F.lit(attempt).alias("attempt"))
        write_jdbc(marker, url, f"{table}_batches", properties)

    return write


def json_value(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns))
