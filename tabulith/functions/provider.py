"""Asking a model behind a cache: only requests without a cached answer reach the provider."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.plans.ship import ship

ANSWERS = "fingerprint string, answer string"
MODEL, EFFORT, MAX_TOKENS = "baseline", "low", 12000
SYSTEM = "Group the lines of a hardware set into components; every line belongs to one component or to the notes."
SCHEMA = "components: array of {anchors, description, catalog_number, pseudo, pseudo_reason}; set_notes: array of anchors"


def fingerprint(prompt: str = "prompt", model: str = MODEL, effort: str = EFFORT, max_tokens: int = MAX_TOKENS, system: str = SYSTEM, schema: str = SCHEMA):
    """The first 32 hex digits of the SHA-256 of the request's JSON, keys in order, nulls written."""
    fields = {"effort": F.lit(effort), "max_tokens": F.lit(max_tokens), "model": F.lit(model), "schema": F.lit(schema), "system": F.lit(system), "user": F.col(prompt)}
    request = F.to_json(F.struct(*[v.alias(k) for k, v in sorted(fields.items())]), {"ignoreNullFields": "false"})
    return F.substring(F.sha2(request, 256), 1, 32)


def baseline(prompt: str) -> str:
    """The answer without a model: every component row as it stands."""
    return "\n".join(line for line in prompt.splitlines() if " | component row " in line)


def ask(prompts: DataFrame, cache: DataFrame, provider: Callable[[str], str] = baseline) -> tuple[DataFrame, DataFrame]:
    """(prompts with answers, answers that are new to the cache). Equal requests are asked once."""
    ship(prompts.sparkSession)
    keyed = prompts.withColumn("fingerprint", fingerprint())
    known = cache.select("fingerprint", "answer").dropDuplicates(["fingerprint"])

    def answered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"fingerprint": batch["fingerprint"], "answer": [provider(p) for p in batch["prompt"]]})

    missing = keyed.select("fingerprint", "prompt").dropDuplicates(["fingerprint"]).join(known, "fingerprint", "left_anti")
    fresh = missing.mapInPandas(answered, ANSWERS)
    return keyed.join(known.unionByName(fresh), "fingerprint", "left"), fresh


def ask_stored(prompts: DataFrame, path: str, provider: Callable[[str], str] = baseline) -> DataFrame:
    """ask with a cache kept as Parquet under path: what is new is written there, and the answers are read from there."""
    spark = prompts.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    kept = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    cache = spark.read.schema(ANSWERS).parquet(path) if kept else spark.createDataFrame([], ANSWERS)
    ask(prompts, cache, provider)[1].write.mode("append").parquet(path)
    answers = spark.read.schema(ANSWERS).parquet(path).dropDuplicates(["fingerprint"])
    return prompts.withColumn("fingerprint", fingerprint()).join(answers, "fingerprint", "left")
