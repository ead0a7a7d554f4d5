"""Spark's spellings that spare work: what they compute once, and that they give what the plain ones give."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulith.plans import graph
from tabulith.plans.dialect import SPARK
from tabulith.plans.graph import TABLES, apply, upstream
from tabulith.plans.registry import QUERIES
from tabulith.sources import sinks

from tests.test_operators import lines

SF = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in TABLES & upstream(name, frozenset())}
    return apply(spark, name, **tables)._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_placed_once(spark):
    """A window numbers the rows of an order, one the lines of a stream: neither is computed again for running lines or second lines."""
    assert plan(spark, "lines").count("Window [row_number()") == 2


def test_running_lines_are_the_furniture_with_a_role(spark):
    """Also where a running line stands elsewhere too, by its first letter or as digits, which takes its role away."""
    base = lines(spark, [])
    for page in (1, 2, 3, 4):
        texts = [f"Door Hardware {s}" for s in ("Submittal",)] + ["1 EA HINGE 5BB1"] * 5
        one = lines(spark, texts).withColumn("page", F.lit(page).cast("bigint"))
        base = base.union(one.withColumn("stream", F.lit(1).cast("bigint"))).union(one.withColumn("stream", F.lit(2).cast("bigint")))
    base = base.union(base.filter("line = 1").withColumn("line", F.lit(44).cast("bigint")).withColumn("top", F.lit(724.0)).withColumn("text", F.concat(F.lit("Page "), F.col("page")))).localCheckpoint()
    moved = base.filter("line = 1 AND page % 2 = 0 AND stream % 2 = 0").withColumn("line", F.lit(20).cast("bigint")).withColumn("top", F.lit(340.0)).withColumn("text", F.concat(F.lit("\t "), F.lower("text")))
    digits = base.filter("line = 44").withColumn("line", F.lit(43).cast("bigint")).withColumn("top", F.lit(712.0)).withColumn("text", F.concat(F.lit(" "), F.col("page"), F.lit(" of 99")))
    every = base.union(moved.select(base.columns)).union(digits.select(base.columns)).localCheckpoint()
    want = apply(spark, "furniture_groups", lines=every).filter("role IS NOT NULL").select("stream", "norm", "role")
    got = apply(spark, "running_lines", lines=every)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.norm[:1] for r in got.collect()} >= {"#", "D"}


def test_anchor_reads_as_formatted(spark):
    sql = f"SELECT {SPARK.anchor('p', 'l')} AS got, format_string('p%d-L%02d', p, l) AS want FROM VALUES (1L, 5L), (12L, 44L), (3L, 100L), (-1L, -1L), (0L, 0L), (CAST(NULL AS BIGINT), 7L), (7L, CAST(NULL AS BIGINT)) v(p, l)"
    assert all(r.got == r.want for r in spark.sql(sql).collect())


def test_words_that_spare_a_pattern_are_in_what_it_finds(spark):
    texts = ["hw-12 x", "Set #1", "HEADING: 4", "hdw 7A", "Hardware Group No. ABC", "qty finish notes", "qty number no", "QTY NUMBER NO", "part 3 -", "ſet #1", "no words here"]
    got = [r.role for r in apply(spark, "line_roles", lines=lines(spark, texts)).sort("line").collect()]
    assert got == ["content"] * 5 + ["col_hdr"] * 3 + ["noise"] + ["content"] * 2


def test_borders_keep_streams_together(spark, sf_dir):
    """Lines of a stream are counted without a shuffle, and the session's settings stay as they were."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert "hashpartitioning" not in QUERIES["rules_summary"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_discarded_borders_leave_the_catalog(spark):
    table = sinks.stored_by(spark.range(10), "of_ids", "id", 2)
    assert table.count() == 10 and spark.catalog.tableExists(table._stored_as)
    sinks.discard(table)
    assert not spark.catalog.tableExists(table._stored_as)


def test_a_row_brings_its_own_hint(spark):
    """The baseline joins rows with the fragments they took, not with themselves."""
    rows = spark.createDataFrame([(1, 1, "p1-L04", 1.0, "EA", False, "IVE", "626", ["HINGE", "5BB1"])], "stream bigint, seq bigint, anchor string, qty double, unit string, by_others boolean, mfr string, finish string, rest_toks array<string>")
    stitches = spark.createDataFrame([], "stream bigint, seq bigint, anchor string, row_anchor string, how string, finish string, mfr string")
    got = apply(spark, "baseline_components", rule_rows=rows, stitch_tails=stitches)
    assert [(r.description, r.catalog_number) for r in got.collect()] == [("HINGE", "5BB1")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2


def test_words_come_with_their_lines(spark):
    """Words are a row's cells where its line was placed: rows are numbered once and joined with nothing."""
    assert plan(spark, "words").count("Window [row_number()") <= 4  # as often as lines are placed: for rows and for headers


def test_equal_texts_are_strict(spark):
    answers = spark.createDataFrame([(1, 1, "a", "X 1", "X 1"), (1, 1, "b", "1 X", "X 1"), (1, 1, "c", "x, 1", "X 1"), (1, 1, "d", "Y", "X 1"), (1, 1, "e", "", "")], "stream bigint, seq bigint, anchor string, answer string, source string")
    assert [r.level for r in apply(spark, "conservation", provider_answers=answers).sort("anchor").collect()] == ["strict", "strict", "normalized", "failed", "strict"]


def test_patterns_that_begin_with_a_letter_are_not_tried_on_digits(spark):
    texts = ["1 EA HINGE", "notes: x", "", None, ":9", "/x", "OPERATION : y", "9"]
    led = SPARK.has_led("t", "(?i)^(?:NOTES|OPERATION)\\s*:")
    got = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", f"{led} AS got", f"{SPARK.has('t', '(?i)^(?:NOTES|OPERATION)' + chr(92) + 's*:')} AS want")
    assert all(r.got == r.want for r in got.collect())
    assert "has_led" not in SPARK.has("t", "x") and ">= '0'" in graph.render("rule_buckets", SPARK)
