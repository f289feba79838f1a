"""Helpers shared by the text operators: word bytes, Arrow batches, table loading."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

PIECE_ROWS = 500  # rows turned into Python objects at a time
SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes) -> list[bytes]:
    """Maximal runs without the six ASCII white-space characters: ``bytes.split`` cuts at exactly these."""
    return text.split()


def lower_words(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased; ``bytes.lower`` leaves all other letters alone."""
    return text.lower().split()


def pieces(batches: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that little is held as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; NULL is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], schema: str, rows: int = PIECE_ROWS) -> DataFrame:
    """``fn`` makes columns (lists or Arrow arrays) from a small batch; ``schema`` names and types them."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, rows):
            made = fn(batch)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c := made[f.name], pa.Array) else pa.array(c, f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def same(left: DataFrame, right: DataFrame, *names: str):
    """Null-safe equality on the named columns."""
    condition = F.lit(True)
    for n in names:
        condition = condition & left[n].eqNullSafe(right[n])
    return condition


def hash_limit(ids: DataFrame, limit: int) -> int | None:
    """The greatest hash so that at most ``limit`` rows are not above it; None where all rows are within the limit.

    Counted by the first 16 bits of the hash, then inside the part that passes the limit by the next 16: the driver gets 65,536 counts at most.
    """
    prefix, taken = None, 0
    for shift in (48, 32, 16, 0):
        inside = ids if prefix is None else ids.filter(F.shiftright("hash", shift + 16) == prefix)
        for r in sorted(inside.groupBy(F.shiftright("hash", shift).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["part"]):
            if taken + r["n"] > limit:
                break
            taken += r["n"]
        else:
            return None
        prefix = r["part"]
        if r["n"] == 1:
            break
    return (prefix << shift) - 1
