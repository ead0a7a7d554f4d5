"""What the training-data operators share: stored tables, dense numbering, bounded broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.plans.ship import ship
from tabulith.sources.sinks import delete, discard, run_folder, stored

__all__ = ["boxed", "bounded_broadcast", "delete", "dense_index", "discard", "shared_path", "small_batches", "stored", "table", "text_or_empty", "unboxed"]

#: A side is broadcast only after its rows were counted and are at most so many.
BROADCAST_ROWS = 100_000


#: Bytes of rows that go to a Python worker at once, where the session does not say.
ARROW_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """Bound what a Python worker, and Spark's side of it, hold of df at a time (a longer row goes by itself): gives the session's maxBytesPerBatch a value where it has none; a value of the user's own stays. Sees to it that workers have the package."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(ARROW_BYTES))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def boxed(df: DataFrame, **own: Column) -> DataFrame:
    """df's rows as one column, _row, beside the columns that an operator works on: no name of df's can clash with one of the operator's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(n) for n, c in own.items()])


def unboxed(df: DataFrame, columns: list[str], **made: Column) -> DataFrame:
    """The boxed columns again, with what the operator made; a column of a made one's name is replaced."""
    return df.select(*[F.col(f"_row.`{c}`").alias(c) for c in columns if c not in made], *[c.alias(n) for n, c in made.items()])


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if df has at most limit rows; else df as it is, for a shuffled join that Spark may split."""
    return F.broadcast(df) if len(df.select(F.lit(1)).limit(limit + 1).take(limit + 1)) <= limit else df


def dense_index(df: DataFrame, order: list[Column], index: str, name: str) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given order without one task that sees them all.

    Rows are range-partitioned and sorted, stored once with (partition, ordinal), and each
    partition's offset is the sum of the counts before it (one row a partition reaches the driver).
    Rows that tie get their numbers in any order: they are parted by where they came from, so that
    many of them go to many partitions.
    """
    spark = df.sparkSession
    tie = df.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    # the id is partition << 33 | ordinal
    placed = stored(tie.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie").withColumn("_mid", F.monotonically_increasing_id()), name)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(F.shiftrightunsigned("_mid", 33).alias("p")).agg((F.max(F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))) + 1).alias("n")).collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    offset = F.broadcast(spark.createDataFrame(offsets or [(0, 0)], "_p long, _offset long"))
    return (
        placed.withColumn("_p", F.shiftrightunsigned("_mid", 33))
        .join(offset, "_p")
        .withColumn(index, F.col("_offset") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_p", "_offset", "_mid")
    )


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
