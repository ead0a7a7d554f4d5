"""Named relations, each a function of others; rendered to one WITH query, or run on DataFrames."""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabulith.plans.dialect import ORACLE, SPARK, Dialect
from tabulith.sources.sinks import discard, stored, stored_by

TABLES = frozenset("region nation customer supplier part orders lineitem events documents pages labels benchmark conversations".split())
_count = itertools.count()


@dataclass(frozen=True)
class Relation:
    name: str
    inputs: tuple[str, ...]
    body: Callable[..., str]
    query: bool
    spark: tuple[str, ...] = ()
    spared: tuple[str, ...] = ()
    unless: tuple[str, ...] = ()

    def reads(self, given) -> tuple[str, ...]:
        """The inputs that Spark's spelling reads."""
        if self.spared and all(i in given for i in self.spared) or any(i in given for i in self.unless):
            return self.inputs
        return tuple(i for i in self.inputs if i not in self.spared or i in given) + self.spark


RELATIONS: dict[str, Relation] = {}


def relation(*inputs: str, query: bool = True, name: str | None = None, spark: tuple[str, ...] = (), spared: tuple[str, ...] = (), unless: tuple[str, ...] = ()):
    """Register a function (dialect, *inputs' names) -> SELECT as the relation of its name. query: it is a query of its own. spark: further inputs that only Spark's spelling reads; the oracle gets None for them. spared: inputs that Spark's spelling reads only where they are given, and then instead of the further ones. unless: relations that, where one is given, make Spark's spelling read the plain inputs."""

    def put(body):
        RELATIONS[name or body.__name__] = Relation(name or body.__name__, inputs, body, query, spark, spared, unless)
        return body

    return put


def render(name: str, dialect: Dialect, given: dict[str, str] | None = None) -> str:
    """One query for a relation; given: relations or tables that exist under other names."""
    given, parts, done = given or {}, [], set()

    def visit(n: str) -> str:
        if n in given:
            return given[n]
        if n in RELATIONS and n not in done:
            done.add(n)
            r = RELATIONS[n]
            read = r.reads(given) if dialect is SPARK else r.inputs
            parts.append((n, r.body(dialect, *[visit(i) if i in read else i for i in r.inputs], *[visit(i) if i in read else None for i in r.spark])))
        elif n not in RELATIONS and n not in TABLES:
            raise KeyError(n)
        return n

    last = visit(name)
    # the oracle computes a relation that several read once
    kind = "AS" if dialect is SPARK else "AS MATERIALIZED"
    ctes = ",\n".join(f"{n} {kind} (\n{body}\n)" for n, body in parts)
    return f"WITH {ctes}\nSELECT * FROM {last}" if parts else f"SELECT * FROM {last}"


#: Relations at which the record extraction has its own file borders. Over tables they are stored as Parquet in the
#: shared folder, which keeps plans small, computes nothing twice and outlives lost executors.
BORDERS = (
    "lines", "band_groups", "running_lines", "chunk_blocks", "page_class", "slot_counts", "legend", "column_schema", "vocabulary", "rule_buckets", "rule_rows", "stitch_tails", "prompt_render", "word_line_assign", "tail_words",
    "column_bands", "slot_zones", "baseline_components", "region_floor", "region_sequences",
)


#: How borders are written: they are read a few times and then go.
QUICK = {"parquet.enable.dictionary": "false", "parquet.compression.codec.zstd.level": "1"}

#: Bytes of input tables for a bucket of a border; streams are whole in a bucket.
BUCKET_BYTES = 8 * 1024 * 1024


def buckets(spark: SparkSession, state: tuple) -> int:
    """How many buckets the borders over inputs in a state have, all of them the same: full rounds of tasks."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-sum(size for files in state for _, size, _ in files) // (BUCKET_BYTES * cores))) * cores


#: Stored borders of this process, by application, relation, its SQL and the state of the input files.
_stored: dict[tuple, DataFrame] = {}


def apply(spark: SparkSession, name: str, keep: tuple[str, ...] = (), state: tuple = (), **inputs: DataFrame) -> DataFrame:
    """The relation over DataFrames, given for tables or for any relations it is made of. keep: relations to store on the way; with a state of the inputs, what was stored for the same state is read again."""
    views = {}

    def view(n: str, df: DataFrame) -> None:
        views[n] = f"tabulith_{n}_{next(_count)}"
        df.createOrReplaceTempView(views[n])

    for n, df in inputs.items():
        view(n, df)
    for n in keep:
        if n != name and n not in views and n in upstream(name, frozenset(views)):
            key = (spark.sparkContext.applicationId, n, render(n, SPARK), state)
            if not state or key not in _stored:
                df = spark.sql(render(n, SPARK, views))
                _stored[key] = stored_by(df, n, "stream", buckets(spark, state), **QUICK) if state and "stream" in df.columns else stored(df, n)
            view(n, _stored[key] if state else _stored.pop(key))
    return spark.sql(render(name, SPARK, views))


def forget() -> None:
    """Let go of the borders that this process has stored, so that the next query computes its own."""
    discard(*_stored.values())
    _stored.clear()


def upstream(name: str, given: frozenset[str]) -> set[str]:
    """Every relation and table that name is made of, as far as those given."""
    if name in given or name not in RELATIONS:
        return {name}
    return {name}.union(*(upstream(i, given) for i in RELATIONS[name].reads(given)))


def tables_of(name: str) -> set[str]:
    r = RELATIONS.get(name)
    return {name} if r is None else set().union(*(tables_of(i) for i in r.inputs))


def file_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a table's files."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    return tuple((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)


def over_tables(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = sorted(tables_of(name))
        state = tuple(file_state(spark, f"{sf_dir}/{t}.parquet") for t in sorted(TABLES & set().union(*(tables_of(b) for b in BORDERS))))
        return apply(spark, name, BORDERS, state, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})

    return run


def oracle(name: str) -> str:
    return render(name, ORACLE)
