"""A dimension table that is published again and again, and read in its newest good version.

Each version is a folder of its own, ``version=<number>``; a version counts once its write is committed. A reader loads a version
when it first sees it: every column of every row is decoded once, keys must be there and be unique. A version that
can't be loaded is left out with a warning and the one before it stays in force, until a newer one is good.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from py4j.protocol import Py4JJavaError

from weirworks.operators.joins import lookup
from weirworks.sources import files

log = logging.getLogger(__name__)


class Snapshots:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, list(keys)
        self.good: set[int] = set()
        self.failed: dict[int, str] = {}

    def folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def publish(self, df: DataFrame, version: int) -> None:
        df.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self.folder(version))

    def versions(self) -> list[int]:
        return files.committed(self.spark, self.path, "version=")

    def table(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder(version))

    def load(self, version: int) -> bool:
        """Whether a version can be read and its keys are complete and unique; tried once per version."""
        if version not in self.good and version not in self.failed:
            df = self.table(version)
            whole = F.count_if(F.hash(*[F.col(c).cast("string") for c in df.columns]).isNull())
            per_key = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"), whole.alias("unread"))
            bad = F.greatest(*[F.col(k).isNull().cast("int") for k in self.keys], (F.col("n") > 1).cast("int"), (F.col("unread") > 0).cast("int"))
            try:
                wrong = per_key.agg(F.sum(bad)).first()[0] or 0
            except (PySparkException, Py4JJavaError) as e:
                self.failed[version] = str(e).splitlines()[0]
            else:
                if wrong:
                    self.failed[version] = f"{wrong} keys are missing or repeated"
                else:
                    self.good.add(version)
            if version in self.failed:
                log.warning("version %d of %s is left out: %s", version, self.path, self.failed[version])
        return version in self.good

    def current(self) -> int | None:
        """The newest version that loads."""
        return next((v for v in reversed(self.versions()) if self.load(v)), None)


def refreshed_lookup(snapshots: Snapshots, path: str, mode: str = "flag", defaults: dict | None = None):
    """``foreachBatch`` writer: rows enriched from the newest good version at the start of their micro-batch, with ``version``.

    A batch that runs again replaces its own folder. Without any good version the batch fails, as there is nothing to look up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        version = snapshots.current()
        if version is None:
            raise ValueError(f"no version of {snapshots.path} can be read")
        joined = lookup(batch, snapshots.table(version), snapshots.keys, mode, defaults)
        joined.withColumn("version", F.lit(version).cast("long")).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
