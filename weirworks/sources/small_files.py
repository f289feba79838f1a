"""Very many small JSON files on a local file system, written and read by the tasks' Python workers.

Hadoop's client without its native library starts a process for the permissions of each new folder and file, three per file; Spark's listing takes ten thousand
tasks, and its reader some milliseconds per file. Python makes, lists and reads the same folders and files in a small part of that.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from weirworks.operators.greedy import differs
from weirworks.session import stored

ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")  # as Spark does in folder names of partition values
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
FILES_PER_TASK, READ_BYTES = 4_096, 1 << 20
#: Options of Spark's JSON writer that only make the text.
TEXT_OPTIONS = {"dateFormat", "timestampFormat", "timestampNTZFormat", "ignoreNullFields", "timeZone", "locale"}


def folder_name(column: str, value: str | int | None) -> str:
    text = "" if value is None else str(value)
    return f"{column}={ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', text) or NO_VALUE}"


def folder_value(name: str) -> str | None:
    value = name.split("=", 1)[1]
    return None if value == NO_VALUE else unquote(value)


def write(placed: DataFrame, folder: str, outer: str, inner: str, options: dict[str, str]) -> None:
    """One JSON file below ``<outer>=<value>/<inner>=<value>`` for each pair. The rows of a pair are in one partition, one after the other.

    A file is written under a hidden name and renamed when it is whole; the name is the same in each attempt of a task, so a repeated task replaces its own files.
    """
    job = uuid.uuid4()
    columns = [c for c in placed.columns if c not in (outer, inner)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, hidden = f"part-{task.partitionId():05d}-{job}.json", f".{task.taskAttemptId()}-{job}"
        made, written, at, held = None, 0, None, []

        def put() -> None:
            nonlocal made, written
            above = f"{folder}/{folder_name(outer, at[0])}"
            if made != above:
                os.makedirs(made := above, exist_ok=True)
            below = f"{above}/{folder_name(inner, at[1])}"
            try:
                os.mkdir(below)
            except FileExistsError:
                pass
            with open(f"{below}/{hidden}", "wb", buffering=0) as f:
                f.write(b"".join(held))
            os.replace(f"{below}/{hidden}", f"{below}/{name}")
            written += 1

        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, lines = (batch.column(i) for i in range(3))
            text = lines.cast(pa.large_binary())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            data = memoryview(text.buffers()[2])
            starts = np.flatnonzero(np.append(True, differs(a) | differs(b)))
            for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(text)]):
                here = a[i].as_py(), b[i].as_py()
                if here != at and held:
                    put()
                    held = []
                at = here
                held.append(bytes(data[offsets[i]:offsets[j]]))
        if held:
            put()
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], names=["files"])

    line = F.concat(F.to_json(F.struct(*[placed[c] for c in columns]), options), F.lit("\n"))
    placed.select(outer, inner, line.alias("line")).mapInArrow(run, "files long").agg(F.sum("files")).first()


def shown(name: str) -> bool:
    return not name.startswith((".", "_"))


def read(spark: SparkSession, folder: str, outer: str, inner: str, schema: StructType) -> DataFrame:
    """The rows of all files below ``<outer>=<value>/<inner>=<value>``; ``schema`` has ``outer``, a string, as a column. The folders are those of now."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for above in batch.column(0).to_pylist():
                below = [n for n in os.listdir(f"{folder}/{above}") if n.startswith(f"{inner}=")]
                yield pa.RecordBatch.from_arrays([pa.array([above] * len(below), pa.string()), pa.array(below, pa.string())], names=["above", "below"])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, values, size = [], [], 0

        def out() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(texts), np.uint8)
            ends = np.flatnonzero(data == 10) + 1
            line = pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(data))
            of = np.searchsorted(np.cumsum([len(t) for t in texts]), ends, side="left")
            made = pa.RecordBatch.from_arrays([pa.array(values, pa.string()).take(pa.array(of)), line], names=["value", "line"])
            return made.filter(pa.array(np.diff(ends, prepend=0) > 1))

        for batch in batches:
            for above, below in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for name in filter(shown, os.listdir(f"{folder}/{above}/{below}")):
                    with open(f"{folder}/{above}/{below}/{name}", "rb", buffering=0) as f:
                        text = f.read()
                    texts.append(text if text.endswith(b"\n") else text + b"\n")
                    values.append(folder_value(above))
                    size += len(text)
                    if size >= READ_BYTES:
                        yield out()
                        texts, values, size = [], [], 0
        if texts:
            yield out()

    tops = [(n,) for n in sorted(os.listdir(folder)) if n.startswith(f"{outer}=")]
    tasks = min(len(tops), spark.sparkContext.defaultParallelism)
    folders = stored(spark.createDataFrame(tops, "above string").repartition(tasks).mapInArrow(listed, "above string, below string"), "rolling-folders")
    tasks = max(spark.sparkContext.defaultParallelism, -(-folders.count() // FILES_PER_TASK))
    data = StructType([f for f in schema.fields if f.name != outer])
    found = folders.repartition(tasks).mapInArrow(lines, "value string, line string")
    return found.select(F.from_json("line", data).alias("row"), F.col("value").alias(outer)).select("row.*", outer)


def readable(schema: StructType, outer: str) -> bool:
    return any(f.name == outer and f.dataType == StringType() for f in schema.fields) and len(schema.fields) > 1
