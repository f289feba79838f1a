"""A table upserted by the micro-batches of a stream: one base and a few deltas.

Layout below ``path``: ``base/upto=<batch>`` holds the newest row per key of all batches up to that number,
``delta/batch_id=<batch>`` the changed rows of one batch. Readers take the newest committed base and the deltas after it, so a read
costs the base and at most ``every`` deltas, however many batches there were.

* A micro-batch that runs again replaces its own delta; if a base holds it already, it is left out.
* Compaction writes a new base beside the old one and only then removes what is older than the *previous* base: a reader that
  started before goes on. A base without its commit mark is ignored, and deltas a base holds are never read, so a crash between
  any two steps changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from weirworks.sources import files

NUMBER = "batch_id"


class UpsertTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], every: int = 8):
        if every < 1:
            raise ValueError("a table is compacted after one delta at least")
        self.spark, self.path, self.schema, self.keys, self.every = spark, path, schema, list(keys), every
        self.rest = [c for c in schema.fieldNames() if c not in self.keys]
        self.stored = StructType(list(schema.fields)).add(NUMBER, "long")

    def bases(self) -> list[int]:
        return files.committed(self.spark, f"{self.path}/base", "upto=")

    def deltas(self, after: int = -1) -> list[int]:
        return [n for n in files.committed(self.spark, f"{self.path}/delta", f"{NUMBER}=") if n > after]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` writer. A batch holds at most one row per key."""
        base = (self.bases() or [-1])[-1]
        if batch_id <= base:
            return
        batch.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/delta/{NUMBER}={batch_id}")
        if len(self.deltas(base)) >= self.every:
            self.compact()

    def _changes(self) -> DataFrame:
        bases = self.bases()
        base = bases[-1] if bases else -1
        parts = [self.spark.read.schema(self.stored).parquet(f"{self.path}/base/upto={base}")] if bases else []
        if deltas := self.deltas(base):
            folders = [f"{self.path}/delta/{NUMBER}={n}" for n in deltas]
            parts.append(self.spark.read.schema(self.stored).option("basePath", f"{self.path}/delta").parquet(*folders))
        if not parts:
            return self.spark.createDataFrame([], self.stored)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _merged(self) -> DataFrame:
        """The row of each key's last batch, combined before the shuffle."""
        last = self._changes().groupBy(*self.keys).agg(F.max_by(F.struct(*self.rest, NUMBER), NUMBER).alias("__row"))
        return last.select(*self.keys, "__row.*").select(*self.stored.fieldNames())

    def read(self) -> DataFrame:
        return self._merged().drop(NUMBER)

    def compact(self) -> None:
        before = self.bases()
        done = self.deltas(before[-1] if before else -1)
        if not done:
            return
        self._merged().write.mode("overwrite").parquet(f"{self.path}/base/upto={done[-1]}")
        self.clean(keep_from=before[-1] if before else -1)

    def clean(self, keep_from: int) -> None:
        """Removes bases before ``keep_from`` and the deltas it holds."""
        for n in self.bases():
            if n < keep_from:
                files.delete(self.spark, f"{self.path}/base/upto={n}")
        for n in self.deltas():
            if n <= keep_from:
                files.delete(self.spark, f"{self.path}/delta/{NUMBER}={n}")
