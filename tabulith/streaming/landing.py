"""Uploads as a stream: files that land in a folder are checked as they come, and the accepted ones kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

MAGIC, LIMIT = "%PDF-", 400 * 1024 * 1024
SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def verdict(path: Column, length: Column, content: Column) -> Column:
    """Why a file is refused, or accepted: its name, its size, its first bytes."""
    return (
        F.when(~F.lower(path).endswith(".pdf"), "not_a_pdf_name")
        .when(length == 0, "empty")
        .when(length > LIMIT, "too_large")
        .when(F.substring(content, 1, len(MAGIC)) != F.lit(MAGIC).cast("binary"), "no_pdf_magic")
        .otherwise("accepted")
    )


def uploads(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of files of a folder, with their verdicts; contents are not carried on. Spark's file reader passes over files without a byte."""
    files = spark.readStream.format("binaryFile").schema(SCHEMA).load(folder)
    return files.select("path", "modificationTime", "length", verdict(F.col("path"), F.col("length"), F.col("content")).alias("verdict"))


def take_in(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Process what has landed since the last call, once, and stop."""
    return uploads(spark, folder).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
