"""Mixing sources to target weights by capped water-filling, with DataFrame operations only.

Targets: every source asks for its weight's share of the budget. A source whose share exceeds
max_epochs times its own size is clamped there; the excess is dealt again to the others in
proportion to their weights, until no share exceeds its clamp. Each round is one aggregate over
the table of sources, of which three numbers reach the driver.

Sampling: a source whose target is w whole epochs and a remainder takes every document w times,
and once more the documents that come first in an order by a seeded hash, until the remainder is
used up; the document at the border gives the words that are still missing. The border is found by
two histograms over hash bits (map-side sums), so that no task ever sees a whole source. Within the border's
bucket, rows of one key and text are counted first and take their turn together; only where the border falls among
repeated rows are these numbered, by ranges.

Edges: a null source is a source of its own, last in order; a null or blank text has size 0 and
takes 0 words; repeated rows count once each; further columns are carried through untouched, whatever their
names; an empty table gives an empty result; a very long text is a document like others, taken whole or, at its
source's border, in part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulith.llm.common import bounded_broadcast, dense_index, stored

SPACE = "\\x20\\x09-\\x0D"
BITS = 12


def word_count(text: Column) -> Column:
    """Runs of characters other than the ASCII white space; 0 for null."""
    body = F.ltrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.length(F.regexp_replace(body, f"[^{SPACE}]+[{SPACE}]*", "x")).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Give the sources, by code point and null last, the weights in turn."""
    ranked = dense_index(sources, [F.col("_source").asc_nulls_last()], "_rank", "mix-rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return ranked.withColumn("_weight", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int"))).drop("_rank")


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """Add _target to sources (_size, _weight): the budget by weight, clamped at max_epochs * _size.

    The level rises until the clamped set stays as it is; each turn clamps at least one more source.
    """
    cap = F.col("_size") * F.lit(float(max_epochs))
    total_weight = sources.agg(F.sum("_weight")).first()[0] or 0.0
    level, clamped = (budget / total_weight if total_weight else 0.0), -1
    while True:
        over = cap <= F.lit(level) * F.col("_weight")
        row = sources.agg(
            F.count_if(over).alias("n"),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~over, F.col("_weight"))), F.lit(0.0)).alias("free"),
        ).first()
        if row["n"] == clamped or not row["free"]:
            level = math.inf if not row["free"] else level
            break
        clamped, level = row["n"], max(level, (budget - row["held"]) / row["free"])
    asked = F.lit(level) * F.col("_weight") if math.isfinite(level) else cap
    return sources.withColumn("_target", F.least(cap, asked))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: key, _size, _source_size, _target and _taken (words the mix takes, repeats counted), and the columns named in keep."""
    if not 0 <= share <= max_epochs:
        raise ValueError("share must lie between 0 and max_epochs: beyond that no mix fits")
    fine = F.shiftrightunsigned("_hash", 64 - 2 * BITS)
    measured = docs.select(
        F.col(key).alias("_key"),
        F.col(source).alias("_source"),
        word_count(F.col(text)).alias("_size"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("_hash"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
    )
    # only the measures are stored; columns that are kept are read from docs once more
    sized = stored(measured.select("_key", "_source", "_size", "_hash"), "mix-sizes").withColumn("_fine", fine)
    sums = stored(sized.groupBy("_source").agg(F.sum("_size").alias("_size")), "mix-sources")
    total = sums.agg(F.sum("_size")).first()[0] or 0
    filled = stored(water_fill(stored(cycled_weights(sums, weights), "mix-weights"), share * total, max_epochs), "mix-targets")
    need = filled.select(
        F.col("_source").alias("_of"),
        F.col("_size").alias("_source_size"),
        "_target",
        F.round("_target").cast("long").alias("_want"),
    ).withColumn("_whole", F.when(F.col("_source_size") > 0, F.floor(F.col("_want") / F.col("_source_size"))).otherwise(0)).withColumn("_rest", F.col("_want") - F.col("_whole") * F.col("_source_size"))

    # first histogram: the bucket of each source's hash order in which the remainder runs out
    in_order = Window.partitionBy("_source").orderBy("_bucket")

    def border(rows: DataFrame, bucket: Column, limits: DataFrame, used: str, name: str) -> DataFrame:
        found = (
            rows.groupBy("_source", bucket.alias("_bucket"))
            .agg(F.sum("_size").alias("_in"))
            .withColumn("_before", F.sum("_in").over(in_order) - F.col("_in"))
            .join(bounded_broadcast(limits), F.col("_source").eqNullSafe(F.col("_of")))
            .withColumn("_before", F.col("_before") + F.col(used))
            .filter((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_in")))
        )
        return stored(found.select("_of", "_rest", F.col("_bucket").alias("_at"), F.col("_before").alias("_used")), name)

    start = need.withColumn("_zero", F.lit(0).cast("long"))
    first = border(sized, F.shiftrightunsigned("_fine", BITS), start, "_zero", "mix-border-1")
    within = sized.join(bounded_broadcast(first.select("_of", "_at")), F.col("_source").eqNullSafe(F.col("_of")) & (F.shiftrightunsigned("_fine", BITS) == F.col("_at"))).drop("_of", "_at")
    second = border(within, F.col("_fine"), first.drop("_at"), "_used", "mix-border-2")
    cut = stored(need.join(second.select(F.col("_of").alias("_of2"), "_at", "_used"), F.col("_of").eqNullSafe(F.col("_of2")), "left").drop("_of2"), "mix-cuts")

    rows = (measured.withColumn("_fine", fine) if keep else sized).join(bounded_broadcast(cut), F.col("_source").eqNullSafe(F.col("_of")))
    whole = F.col("_whole") * F.col("_size")
    plain = rows.filter(F.col("_at").isNull() | (F.col("_fine") != F.col("_at"))).withColumn("_taken", whole + F.when(F.col("_fine") < F.col("_at"), F.col("_size")).otherwise(0))
    # a 2^-24 part of a source: its rows in the full order, those of one key and text together
    same = ["_source", "_fine", "_hash", "_key", "_size"]
    edge = rows.filter(F.col("_fine") == F.col("_at"))
    at_edge = sized.join(bounded_broadcast(cut.select("_of", "_at", (F.col("_rest") - F.col("_used")).alias("_open"))), F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_fine") == F.col("_at")))
    running = Window.partitionBy("_source", "_fine").orderBy("_hash", F.col("_key").asc_nulls_first(), "_size").rowsBetween(Window.unboundedPreceding, -1)
    turns = stored(at_edge.groupBy(*same, "_open").agg(F.count(F.lit(1)).alias("_n")).withColumn("_left", F.col("_open") - F.coalesce(F.sum(F.col("_n") * F.col("_size")).over(running), F.lit(0))), "mix-turns")
    turn = turns.select(F.col("_hash").alias("_h"), F.col("_key").alias("_k"), F.col("_size").alias("_s"), F.col("_source").alias("_o"), "_left", "_n")
    edge = edge.join(turn, (F.col("_hash") == F.col("_h")) & F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_size") == F.col("_s")) & F.col("_source").eqNullSafe(F.col("_o"))).drop("_h", "_k", "_s", "_o")
    among = (F.col("_n") > 1) & (F.col("_left") > 0) & (F.col("_left") < F.col("_n") * F.col("_size"))
    if turns.filter(among).limit(1).count():
        numbered = dense_index(edge.filter(among), [F.col("_source").asc_nulls_first(), F.col("_hash")], "_number", "mix-numbered")
        starts = numbered.groupBy("_source").agg(F.min("_number").alias("_start")).withColumnRenamed("_source", "_o")
        counted = numbered.join(bounded_broadcast(starts), F.col("_source").eqNullSafe(F.col("_o"))).withColumn("_before", F.col("_number") - F.col("_start")).drop("_number", "_start", "_o")
        edge = edge.filter(~among).withColumn("_before", F.lit(0).cast("long")).unionByName(counted)
    else:
        edge = edge.withColumn("_before", F.lit(0).cast("long"))
    edge = edge.withColumn("_taken", whole + F.greatest(F.lit(0), F.least(F.col("_size"), F.col("_left") - F.col("_before") * F.col("_size"))))
    chosen = [F.col("_key").alias(key), "_size", "_source_size", "_target", F.col("_taken").cast("long").alias("_taken"), *[F.col(f"_keep_{c}").alias(c) for c in keep if c != key]]
    return plain.select(*chosen).unionByName(edge.select(*chosen))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as rows: every document whole, as often as its taken words make it (a half counts as one more)."""
    times = F.when(F.col("_size") > 0, F.floor(F.col("_taken") / F.col("_size") + F.lit(0.5))).otherwise(0)
    rows = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return mix(rows, keep=("_row",), **settings).withColumn("_times", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select("_row.*")
