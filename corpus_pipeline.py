"""Corpus pipeline: quality rules, near-duplicates, decontamination, secrets, SentencePiece ids.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame that is written as Parquet
and read again as the next stage's docs. All but the last return the columns of the documents table.

* quality: rejected documents go, lines above the host's limit leave the texts of the others (n_chars follows);
* near_duplicates: one document of each component stays, the one with the smallest id (five-word shingles, similarity 0.8);
* decontamination: documents that hold a benchmark item's template with consistent slots go;
* secrets: every span found is replaced by ``<SECRET>``, no document goes;
* pieces: doc_id, lang, source, the ids of the text, their number, the segmentation's score, whether decoding gives the text back.

SQL can't express minima, components or a Viterbi search, so ORACLE_SQL is None; the tests compare with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirworks.llm import line_frequency, minhash, pieces, secret_scan, templates
from weirworks.llm.common import table
from weirworks.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_frequency.clean_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = pieces.encode(docs, keep=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_pieces"), "score", "round_trip")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("pieces", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
