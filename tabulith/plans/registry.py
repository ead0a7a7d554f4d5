"""Every query by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabulith.operators import assemble, catalog, chunk, dossier, geometry, jobs, locate, repair, roles, rules  # noqa: F401  they register their relations
from tabulith.plans.graph import RELATIONS, oracle, over_tables
from tabulith.sources import documents, schedule, sinks  # noqa: F401


def x0_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.x0_clusters(over_tables("start_counts")(spark, sf_dir))


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The set records, written and read again."""
    return sinks.stored(over_tables("set_records")(spark, sf_dir), "sink-roundtrip")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: over_tables(n) for n, r in RELATIONS.items() if r.query} | {"x0_clusters": x0_clusters, "sink_roundtrip": sink_roundtrip}
SQL: dict[str, str] = {n: oracle(n) for n in QUERIES if n in RELATIONS} | {"sink_roundtrip": oracle("set_records"), "x0_clusters": geometry.x0_clusters_oracle(oracle("start_counts"))}
