"""The operators bound to the supplied tables: ``QUERIES`` and, where SQL can state it, ``ORACLE``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm import (
    alignment, decontaminate, embeddings, html_text, language_id, mixing, neighbours, passages, secrets, simhash, token_files, toxicity,
    whitening,
)
from tallyfield.llm.shipping import shipped
from tallyfield.llm.tables import crc_bucket
from tallyfield.sources.scratch import scratch_dir
from tallyfield.sources.tables import load_table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_bucket("doc_id", 3) == 1
    model = language_id.fit(docs, ~held_out)
    return language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep=["doc_id", "held_out"])


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(load_table(spark, sf_dir, "documents"), scratch_dir(spark, "secret-ledger")))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(load_table(spark, sf_dir, "embeddings"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.scan(
        load_table(spark, sf_dir, "documents").select("doc_id", "text"), load_table(spark, sf_dir, "benchmark"),
        keep=["doc_id"])


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_bucket("doc_id", 5) == 0
    model = toxicity.fit(docs, load_table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep=["doc_id", "held_out"])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(load_table(spark, sf_dir, "documents"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(load_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    token_files.write_tokens(load_table(spark, sf_dir, "documents"), folder, WORD_TOKENIZER)
    return token_files.read_tokens(spark, folder)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(load_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(load_table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(load_table(spark, sf_dir, "embeddings"))
    # The contract asks for a long; sums that do not fit one are NULL.
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(load_table(spark, sf_dir, "embeddings"))


QUERIES = {name: shipped(plan) for name, plan in {
    "op1_language_id": op1_language_id,
    "op2_secret_scan": op2_secret_scan,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_passages": op7_passages,
    "op8_simhash": op8_simhash,
    "op9_token_files": op9_token_files,
    "op10_html_text": op10_html_text,
    "op11_alignment": op11_alignment,
    "op12_whitening": op12_whitening,
    "op13_neighbours": op13_neighbours,
}.items()}
ORACLE: dict[str, str] = {
    "op2_secret_scan": secrets.oracle(),
    "op3_embedding_dedup": embeddings.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
}
