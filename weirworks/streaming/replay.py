"""Stored tables played as streams, one micro-batch per part.

A part becomes one folder whose files follow its size. Iterating publishes the parts one by one; a run that takes all that is
available after each of them (``runner``) makes one micro-batch of data per part, and one without data in which timers fire at
the watermark that the part brought. So micro-batches don't depend on the number of files, and a part may have any number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame

from weirworks.session import pin_utc, scratch_dir


class Replay:
    def __init__(self, parts: Sequence[DataFrame], label: str = "replay"):
        self.parts = list(parts)
        self.spark, self.schema = self.parts[0].sparkSession, self.parts[0].schema
        pin_utc(self.spark)
        self.folder = scratch_dir(self.spark, label)
        self.parts[0].limit(0).write.parquet(f"{self.folder}/part-of-none")

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(self.folder)

    def __iter__(self) -> Iterator[int]:
        for i, part in enumerate(self.parts):
            part.hint("rebalance").write.parquet(f"{self.folder}/part-{i:05d}")
            yield i
