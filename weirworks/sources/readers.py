"""Readers: files, declared tables, JDBC and message topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirworks.operators.rows import json_records
from weirworks.sources import files


def csv_reader_options(sep: str = ",", line_sep: str = "\n", quote: str = '"', header: bool = True,
                       comment: str | None = None, lenient: bool = True) -> dict[str, str]:
    options = {"sep": sep, "lineSep": line_sep, "quote": quote, "header": str(header).lower(),
               "mode": "DROPMALFORMED" if lenient else "FAILFAST"}
    if comment:
        options["comment"] = comment
    return options


def read_csv(spark: SparkSession, path: str, schema: str, **dialect) -> DataFrame:
    return spark.read.schema(schema).options(**csv_reader_options(**dialect)).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """With a schema only its columns are read; without one the schema comes from a file footer."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_jdbc_query(spark: SparkSession, url: str, query: str, properties: dict[str, str],
                    partition_column: str | None = None, lower: int = 0, upper: int = 0, partitions: int = 1) -> DataFrame:
    """Rows of a database query; a numeric partition column spreads the read over tasks."""
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    if partition_column:
        return (
            reader.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
            .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", partitions).load()
        )
    return reader.option("query", query).load()


def kafka_options(servers: str, topic: str, position: str = "earliest", timestamp_ms: int | None = None) -> dict[str, str]:
    """Options of the ``kafka`` source for a start at earliest, latest or a time.

    A committed position needs no option: the query's checkpoint holds it.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if position == "timestamp":
        options["startingTimestamp"] = str(timestamp_ms)
    elif position in ("earliest", "latest"):
        options["startingOffsets"] = position
    elif position != "committed":
        raise ValueError(position)
    return options


def stream_json_topic(spark: SparkSession, schema: str, **kafka) -> DataFrame:
    """Typed records of a topic of JSON texts (needs the Kafka connector on the classpath)."""
    raw = spark.readStream.format("kafka").options(**kafka_options(**kafka)).load()
    return json_records(raw.select(F.col("value").cast("string").alias("value")), "value", schema)


def stream_json_files(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """The same records from a folder of text files, one JSON text per line."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return json_records(raw, "value", schema)


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("lineSep", "\n").text(folder)


def from_position(df: DataFrame, position: str, ts: str, offset: str, start=None) -> DataFrame:
    """Start position on stored history: everything, rows from a time on, rows after a committed offset, or none."""
    if position == "earliest":
        return df
    if position == "timestamp":
        return df.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if position == "committed":
        return df.filter(F.col(offset) > F.lit(start))
    if position == "latest":
        return df.filter(F.lit(False))
    raise ValueError(position)


def mark_start(spark: SparkSession, folder: str, checkpoint: str) -> None:
    """Fixes the position ``latest`` of a folder: what is there now lies before it. Kept beside the checkpoint, so restarts keep it."""
    newest = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).agg(F.max("modificationTime").alias("since"))
    newest.coalesce(1).write.mode("errorifexists").parquet(f"{checkpoint}-start")


def from_start(stream: DataFrame, position: str, folder: str, checkpoint: str, ts: str, start=None) -> DataFrame:
    """A stream of files from a start position.

    ``earliest`` reads all files; ``timestamp`` rows from the time ``start`` on; ``committed`` goes on where the checkpoint stands, and from the
    earliest file without one; ``latest`` reads files that changed after the position that ``mark_start`` fixed (now, if it fixed none).
    """
    if position in ("earliest", "committed"):
        return stream
    if position == "timestamp":
        return stream.filter(F.col(ts) >= F.lit(start).cast(stream.schema[ts].dataType))
    if position != "latest":
        raise ValueError(position)
    spark = stream.sparkSession
    if not files.exists(spark, f"{checkpoint}-start"):
        mark_start(spark, folder, checkpoint)
    since = spark.read.parquet(f"{checkpoint}-start").first()["since"]
    return stream if since is None else stream.filter(F.col("_metadata.file_modification_time") > F.lit(since))


def declare_table(df: DataFrame, name: str, rowtime: str | None = None, delay: str = "2 seconds") -> DataFrame:
    """Register a (typed) source under a name for SQL, with a bounded-disorder watermark on streams."""
    if rowtime and df.isStreaming:
        df = df.withWatermark(rowtime, delay)
    df.createOrReplaceTempView(name)
    return df
