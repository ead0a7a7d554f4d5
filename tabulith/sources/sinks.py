"""Writing streams and records, and reading them back."""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = "spark.sql.shuffle.partitions"

#: How plans over buckets are made while a table is stored: a plain filter keeps them, so that its own table needs no shuffle; joins by their key and more meet in them; groups of rows that come sorted are made without a map.
IN_BUCKETS = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", "spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.execution.replaceHashWithSortAgg": "true"}

_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, else the context's checkpoint folder. A local session (tests) gets a temporary one where neither is set; a cluster is refused, because a folder of the driver's would lose data there."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
    return _folders.setdefault(spark.sparkContext.applicationId, f"file://{tempfile.mkdtemp(prefix='tabulith-')}")


def run_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables are; clear() deletes it."""
    return f"{shared_folder(spark)}/tabulith/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df as a Parquet table in the run's shared folder and read it back: a cut lineage that outlives executors."""
    path = f"{run_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def stored_by(df: DataFrame, name: str, key: str, buckets: int, **options: str) -> DataFrame:
    """stored, in buckets by a key: plans over it group by the key, or by the key and more, without a shuffle (joins by more than the key are shuffled). The session's catalog knows the table until it is discarded; its files are in the run's folder as well."""
    spark, tag = df.sparkSession, uuid.uuid4().hex
    path, table = f"{run_folder(spark)}/{name}-{tag}", f"tabulith_{name}_{tag}"
    before = {k: spark.conf.get(k) for k in (*IN_BUCKETS, PARTITIONS)}
    # what is shuffled on the way grows with the tables too
    for k, value in {**IN_BUCKETS, PARTITIONS: str(max(buckets, int(before[PARTITIONS])))}.items():
        spark.conf.set(k, value)
    try:
        df.repartition(buckets, key).write.options(**{"compression": "zstd", **options}).option("path", path).bucketBy(buckets, key).saveAsTable(table, format="parquet")
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)
    out = spark.table(table)
    out._stored_at, out._stored_as = path, table
    return out


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later plan reads."""
    for t in tables:
        if hasattr(t, "_stored_as"):
            t.sparkSession.sql(f"DROP TABLE IF EXISTS {t._stored_as}")
        delete(t.sparkSession, t._stored_at)


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; what was returned over them can't be read any more."""
    delete(spark, run_folder(spark))


def write_parquet(df: DataFrame, path: str, *partition: str) -> None:
    """A partition a stream, say; partitions that this run doesn't write stay (dynamic overwrite)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def json_lines(df: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """A row of one column, value: JSON with the keys in order. keep_nulls: nulls are written; else their keys are absent."""
    row = F.struct(*sorted(df.columns))
    return df.select(F.to_json(row, {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value"))


def write_json_lines(df: DataFrame, path: str, keep_nulls: bool = True) -> None:
    json_lines(df, keep_nulls).write.mode("overwrite").text(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def stale(existing: DataFrame, declared: DataFrame, name: str = "file") -> DataFrame:
    """Names that exist but that this run did not write."""
    return existing.select(name).distinct().join(declared.select(name), name, "left_anti")


def write_report(report: DataFrame, path: str, key: str = "project") -> None:
    """A JSON document for each row, in a folder of its own by the key; keys in order, nulls written."""
    row = F.struct(*sorted(c for c in report.columns))
    report.select(F.col(key), F.to_json(row, {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).text(path)


def read_report(spark: SparkSession, path: str) -> dict:
    """One JSON document; {} where there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return {}
    found = spark.read.option("wholetext", True).text(path).first()
    return json.loads(found["value"]) if found else {}
