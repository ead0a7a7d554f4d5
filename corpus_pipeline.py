"""The training-data pipeline: five stages over documents, each stored as Parquet and read by the next.

language    documents whose language can't be told (no letters) go
near_dedup  one document of each class of near-duplicates stays
benchmark   documents that hold a window of a benchmark item go
mixture     documents are repeated or left out, to the sources' target weights
tokens      token sequences, in the slots of the training order

Edges, in every stage but the last: rows keep all their columns, with their values, whatever those are named (an
operator's own columns never meet them); an empty table gives an empty one. Null texts and texts without letters
go at the first stage; the stages after it keep null texts as documents without words, but the mixture takes none of
size 0. A null source is a source of its own. Of repeated rows near_dedup keeps one; of equal classes the least id's row.
Very long texts are worked on whole. In the last stage a null text has no sequences, and an empty table no rows.

ORACLE_SQL is None: the learned classifier, the signatures and the tokenizer are beyond SQL; the tests
hold run() against a version written without Spark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm import decontamination, language_id, mixing, token_output
from tabulith.llm.common import boxed, discard, stored, table
from tabulith.llm.dart_minhash import near_duplicates


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents outside the held-out fold; keep the documents of a known language (all with letters, where nothing is labelled)."""
    model = language_id.train(docs.filter(~language_id.held_out()))
    if model is None:
        return docs.filter(F.col("text").rlike(language_id.LETTER))
    told = language_id.identify(boxed(docs, text=F.col("text")), model)
    return told.filter(F.col("lang_pred") != language_id.UNKNOWN).select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_duplicates(boxed(docs, doc_id=F.col("doc_id"), text=F.col("text")))
    return found.filter("kept").select("_row.*")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shards = token_output.read_shards(spark, token_output.write_shards(docs), key=docs.schema["doc_id"].dataType.simpleString())
    return shards.select(F.col("key").alias("doc_id"), "seq", "slot", "shard", "n_tokens", "tokens")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("benchmark", benchmark),
    ("mixture", mixture),
    ("tokens", tokens),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's rows are stored before the next reads them, and deleted when the next ones are."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
