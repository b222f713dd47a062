"""Training-data pipeline over ``documents``, and the queries of the operators it draws from.

Stages, each on all that the one before kept: toxic documents go; of every group of near copies one
document stays; documents that hold benchmark passages go; the sources are mixed to their targets,
whole documents or the runs of words that the mix takes; what is left is written as token files.

Stages take any documents table with ``doc_id``, ``text`` and ``source``; NULLs, empty and repeated
rows, and extra columns are treated as their operators say. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm import decontaminate, mixing, queries, simhash, token_files, toxicity
from tallyfield.llm.shipping import ship
from tallyfield.llm.tables import fresh, stored
from tallyfield.sources.scratch import scratch_dir
from tallyfield.sources.tables import load_table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = toxicity.fit(docs, load_table(spark, sf_dir, "labels"), F.lit(True))
    return kept(docs, lambda df: toxicity.predict(df, model).filter("predicted = 0"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return kept(docs, lambda df: decontaminate.scan(df, load_table(spark, sf_dir, "benchmark")).filter("NOT contaminated"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    folder = scratch_dir(spark, "pipeline-tokens")
    # After four other stages the workers have less memory left than in a job of its own.
    token_files.write_tokens(docs, folder, queries.WORD_TOKENIZER, parts_kept=100_000, slice_bytes=1_300_000)
    return token_files.read_tokens(spark, folder)


def kept(docs: DataFrame, judge) -> DataFrame:
    """Rows that pass ``judge``, with all columns of ``docs``, whatever columns the judge adds."""
    text = "text"
    others = [c for c in docs.columns if c != text]
    packed = fresh([text], "packed")
    judged = judge(docs.select(F.struct(*others).alias(packed), text) if others else docs)
    return judged.select(*(text if c == text else F.col(packed)[c].alias(c) for c in docs.columns))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash", without_copies),
    ("decontaminate", without_benchmark),
    ("mixing", mixed),
    ("token_files", tokens),
]

# No SQL: a fitted model decides in the first stage, pseudorandom draws in the fourth.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result but the last is written to shared storage and read again."""
    docs = load_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs


QUERIES = {**queries.QUERIES, "pipeline": run}
ORACLE = dict(queries.ORACLE)
