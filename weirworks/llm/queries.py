"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from weirworks.llm import alignment, chat, hidden_markov, license_scan, line_frequency as lf, minhash, phrases, pieces, secret_scan, severity, templates, warc, word_pieces
from weirworks.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op1_line_frequency", lf.SQL)
def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.line_frequency(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")


@query("op5_minhash_near_dedup")
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4)


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


@query("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(table(spark, sf_dir, "documents"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_pieces.token_counts(table(spark, sf_dir, "documents"))


@query("op2_template_decontamination")
def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("doc_print").distinct()


@query("op6_hidden_markov_scores")
def op6_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.language_model_scores(table(spark, sf_dir, "documents"))


@query("op8_chat_formatting", chat.SQL)
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", chat.EXTRA), (-7, 1, "assistant", chat.EXTRA)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.summaries(chat.format_conversations(rows))


@query("op7_warc_capture_index")
def op7_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).drop("url")


@query("op3_ordinal_severity")
def op3_ordinal_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return severity.severities(docs, severity.train(docs, table(spark, sf_dir, "labels")))


@query("op11_tokenizer_alignment")
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.scores(alignment.index(table(spark, sf_dir, "documents")))


@query("op12_license_scan")
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op13_phrase_mining", phrases.SQL)
def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
