"""Record borders over large tables: fewer windows and shuffles, the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulith.plans import graph
from tabulith.plans.dialect import SPARK
from tabulith.plans.graph import apply, upstream
from tabulith.plans.registry import QUERIES
from tabulith.sources import sinks

from tests.test_operators import lines

BLOCK = [
    "NOTES: before the head", "12", "OPERATION: in the head", "PROVIDE EACH SINGLE DOOR WITH THE FOLLOWING:", "1 EA HINGE 5BB1 626 IVE", "For use on Door #(s):", "", "101A 102", "Each to have:", "Description: one",
    "626 IVE", "Notes: go on", "as they do", "Description: two", "2 EA LOCK 33 630 SCH", "Item #4 here", "2 Pair leaves", "2 Pair Operator", "100 x 200", "Properties: Rated", "Doors: 7", "9B", "loose", "630 IVE",
    "a longer text that stands alone as prose does", "OPERATION: closes", "101A 102", "Doors:", "1 EA AFTER THE END 626 IVE", "  3  EA  SPACED  OUT  626  IVE ", "PART 4 - 1 EA PARTED 626 IVE", "1\tEA TABBED 626 IVE",
]


def blocks(spark):
    """The block's lines from each place on, so that states begin everywhere, as blocks of a stream; the first goes on with its header's trailer."""
    rows = [(1, seq, 1 + n // 40, 3 + n % 40, f"p{1 + n // 40}-L{3 + n % 40:02d}", text) for seq in range(1, 33) for n, text in enumerate(["HW-" + str(seq)] + BLOCK[seq - 1 :] + BLOCK[: seq - 1], 100 * seq)]
    rows.append((1, 40, 90, 3, "p90-L03", "HW-40"))
    out = spark.createDataFrame(rows, "stream bigint, seq bigint, page bigint, line bigint, anchor string, text string")
    return out.withColumn("part", F.lit("block")).withColumn("trailer", F.expr("CASE WHEN text = 'HW-1' THEN '(Door' WHEN text LIKE 'HW-%' THEN '' END")).localCheckpoint()


def test_buckets_of_flags_are_those_of_windows(spark):
    """Spark's counted windows against the plain ones, which it takes for given body lines."""
    vocabulary = spark.createDataFrame([(1, "finish", "626", "legend"), (1, "finish", "630", "legend"), (1, "mfr", "IVE", "legend"), (1, "mfr", "SCH", "legend")], "stream bigint, role string, value string, origin string")
    body = apply(spark, "body_lines", chunk_blocks=blocks(spark)).localCheckpoint()
    continued = apply(spark, "trailer_continuation", chunk_blocks=blocks(spark), body_lines=body).localCheckpoint()
    want = apply(spark, "rule_buckets", body_lines=body, vocabulary=vocabulary, trailer_continuation=continued)
    got = apply(spark, "rule_buckets", chunk_blocks=blocks(spark), vocabulary=vocabulary)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.kind for r in want.select("kind").distinct().collect()} >= {"trailer", "blank", "opener", "bare_qty", "door", "door_header", "note", "note_header", "description", "properties", "orphan", "dropped_tail", "row", "prose"}
    # one for positions, one for the head, one for door lists and ends, one for notes and descriptions
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 4


def test_headers_and_blocks_need_one_window(spark):
    """Also where a stream announces dotted headers, which then open blocks, and where none does."""
    texts = ["before", "1.2 NAMED", "HW-1 first", "1 EA HINGE", "2.10 (B)", "12.5 x", "END OF SECTION", "after", "Set #3: again", "SET HARDWARE TYPE"]
    one = lines(spark, texts).localCheckpoint()
    both = one.union(lines(spark, texts[:-1]).withColumn("stream", F.lit(9).cast("bigint"))).localCheckpoint()
    headers = apply(spark, "set_headers", lines=both).localCheckpoint()
    want, got = apply(spark, "chunk_blocks", set_headers=headers), apply(spark, "chunk_blocks", line_roles=apply(spark, "line_roles", lines=both).localCheckpoint())
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert [r.n for r in got.filter("family = 'bare_dotted'").groupBy("stream").agg(F.count("*").alias("n")).collect()] == [2]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1


def test_listings_compute_only_what_they_show(spark, sf_dir):
    none = frozenset()
    assert not {"baseline_components", "prompt_render"} & (upstream("catalog_stats", none) | upstream("project_report", none) | upstream("set_records", none))
    assert "prompt_render" not in upstream("catalog_streams", none) and "prompt_render" in upstream("assembly_summary", none)
    given = {"catalog_streams": "streams_given"}
    assert "streams_given" in graph.render("catalog_stats", SPARK, given) and "streams_given" in graph.render("project_report", SPARK, given)


def test_prompts_are_read_where_they_are_stored(spark, sf_dir):
    assert "Join" not in QUERIES["prompt_fingerprint"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def test_settings_of_buckets_end_with_the_table(spark):
    before = {k: spark.conf.get(k) for k in sinks.IN_BUCKETS}
    table = sinks.stored_by(spark.range(10), "of_ids", "id", 2)
    assert {k: spark.conf.get(k) for k in sinks.IN_BUCKETS} == before != sinks.IN_BUCKETS
    sinks.discard(table)


def test_normal_text_without_a_pattern(spark):
    from tabulith.operators.dossier import clean, normal

    texts = ["1 EA HINGE", " led", "trailed ", "a  b", "PART 3 - x", "part 3 - x", "Pp", "tab\there", "new\nline", "café", " icon", "", "P", " ", None, "part", "nbsp x"]
    full = SPARK.swap(clean(SPARK, "t"), r"(?i)^PART\s+\d{1,3}\s*[-–—]\s*", "")
    got = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(f"{normal(SPARK, 't')} AS got", f"{full} AS want")
    assert all(r.got == r.want for r in got.collect())
    assert "|  |" not in normal(SPARK, "t")
