"""The baseline and its confidence over large tables: fewer passes, the same rows."""

from __future__ import annotations

from tabulith.operators.assemble import level, tokens
from tabulith.plans.dialect import SPARK
from tabulith.plans.graph import apply, upstream
from tabulith.plans.registry import QUERIES

from tests.test_operators import lines

PLACED = "stream bigint, seq bigint, anchor string, page bigint, line bigint, pos bigint, qty double, unit string, by_others boolean, mfr string, finish string, mfr_level string, finish_level string, rest_toks array<string>"
STITCHES = "stream bigint, seq bigint, anchor string, row_anchor string, how string, finish string, mfr string"
RESTS = [["HINGE", "5BB1"], ["5BB1", "X"], ["HINGE"], [""], [], ["A", "", "5"], ["", "A", "5"], ["A", "5", ""], ["A 7", "B"], ["A", None, "5"], ["X\n", "Y", "é5", "6"], ["A", "B", "C1", "D", "E2"], ["A", "٣", "4"]]


def rows(spark, seq=1):
    return spark.createDataFrame([(1, seq, f"p1-L{n:02d}", 1, n, n, 1.0, "EA", False, None, None, None, None, rest) for n, rest in enumerate(RESTS, 3)], PLACED)


def same(got, want):
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rests_are_cut_by_one_pattern(spark):
    """Against the plain spelling, which is taken for given rows and hints; also for rests whose words are not at single spaces."""
    placed, stitches = rows(spark).localCheckpoint(), spark.createDataFrame([(1, 1, "p1-L90", "p1-L03", "dropped_tail", "626", "IVE")], STITCHES)
    repaired, hints = apply(spark, "repaired_rows", rule_rows=placed, stitch_tails=stitches), apply(spark, "split_hint", rule_rows=placed)
    got = apply(spark, "baseline_components", rule_rows=placed, stitch_tails=stitches)
    same(got, apply(spark, "baseline_components", rule_rows=placed, stitch_tails=stitches, repaired_rows=repaired.localCheckpoint(), split_hint=hints.localCheckpoint()))
    assert "AS lead" in got._jdf.queryExecution().optimizedPlan().toString()


def test_slots_are_counted_once(spark):
    """Schema and vocabulary from counts of the last two words, against those from the words themselves."""
    toks = [["HINGE", "5BB1", "626", "IVE"]] * 6 + [["LOCK", "630", "SCH"]] * 6 + [["HINGE", "IVE"], ["STOP", "626/630"], ["A", "626/630", "IVE"], ["A", "626/630", "IVE"], ["A", "626/630", "IVE"]]
    names = [["HINGE", "9", "Ives"]] * 12 + [["HINGE", "Ives"]]
    tokens = spark.createDataFrame([(s, 1, 1, n, f"p1-L{n:02d}", t) for s, some in ((1, toks), (2, names)) for n, t in enumerate(some, 3)], "stream bigint, seq bigint, page bigint, line bigint, anchor string, toks array<string>").localCheckpoint()
    legend = spark.createDataFrame([(1, "finish", "626", "x")], "stream bigint, role string, code string, name string").localCheckpoint()
    counts = apply(spark, "slot_counts", candidate_tokens=tokens).localCheckpoint()
    slots = apply(spark, "slot_tokens", candidate_tokens=tokens).localCheckpoint()
    assert slots.count() == 2 * tokens.count() - 3
    same(apply(spark, "slot_identity", slot_counts=counts, legend=legend), apply(spark, "slot_identity", slot_tokens=slots, legend=legend))
    schema = spark.createDataFrame([(1, -1, -2), (2, None, None)], "stream bigint, mfr_slot int, finish_slot int")
    want = apply(spark, "vocabulary", candidate_tokens=tokens, column_schema=schema, legend=legend)
    same(apply(spark, "vocabulary", slot_counts=counts, column_schema=schema, legend=legend), want)
    assert {r.value for r in want.collect()} >= {"626", "630", "IVE", "SCH"}
    assert "candidate_tokens" not in {n for q in ("vocabulary", "column_schema") for n in upstream(q, frozenset({"slot_counts"}))}


def test_quantity_and_unit_without_a_pattern(spark):
    norms = ["1 EA HINGE 5", "2.5 SET. LOCK", "3 EASEL X", "4 PR-A x", "5 Pr", "6 HINGE", "7 EA", "8 SETS - Y", "9 EA é 5", "10  EA  WIDE", "11 EA é", "12 S", "1.5 Ea. A  B"]
    buckets = spark.createDataFrame([(1, 1, 1, n, f"p1-L{n:02d}", t, t, n, "rows", "row") for n, t in enumerate(norms, 3)], "stream bigint, seq bigint, page bigint, line bigint, anchor string, text string, norm string, pos bigint, bucket string, kind string")
    schema = spark.createDataFrame([(1, -1, -2)], "stream bigint, mfr_slot int, finish_slot int")
    vocabulary = spark.createDataFrame([(1, "mfr", "IVE", "legend")], "stream bigint, role string, value string, origin string")
    got = apply(spark, "slot_values", rule_buckets=buckets, column_schema=schema, vocabulary=vocabulary)
    pattern = r"^(\d+(?:\.[05])?)\s+(?:((?:EA|SET|SETS|PR|Ea|Set|Sets|Pr)(?:-[A-Z])?\.?)\s+)?(\S.*)$"
    part = lambda k: f"regexp_extract(norm, r'{pattern}', {k})"
    want = buckets.selectExpr("anchor", f"CAST({part(1)} AS DOUBLE) AS qty", f"nullif({part(2)}, '') AS unit", f"split({part(3)}, ' +') AS ctoks")
    same(got.select("anchor", "qty", "unit", "ctoks"), want)
    assert "substring_index" in got._jdf.queryExecution().optimizedPlan().toString()


def test_flags_need_neither_the_census_nor_a_stored_baseline(spark, sf_dir):
    """Flags by one pass over the components, against those of given claims, levels and rows."""
    read = upstream("assembly_confidence", frozenset())
    assert "baseline_components" not in read and "anchor_census" not in read
    placed = rows(spark)
    for seq in (5, 7, 11, 13, 17, 29):
        placed = placed.union(rows(spark, seq))
    placed = placed.localCheckpoint()
    stitches = spark.createDataFrame([(1, 13, "p1-L90", "p1-L04", "dropped_tail", "626", "IVE")], STITCHES).localCheckpoint()
    buckets = placed.selectExpr("stream", "seq", "page", "line", "anchor", "'' AS text", "'' AS norm", "pos", "'rows' AS bucket", "'row' AS kind").localCheckpoint()
    components = apply(spark, "baseline_components", rule_rows=placed, stitch_tails=stitches).localCheckpoint()
    want = apply(spark, "component_flags", rule_buckets=buckets, rule_rows=placed, stitch_tails=stitches, baseline_components=components).localCheckpoint()
    got = apply(spark, "component_flags", rule_rows=placed, stitch_tails=stitches)
    same(got, want)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert want.filter("duplicate > 0").count() == 1 and want.filter("multi_row > 0").count() == 1 and {r.level for r in want.collect()} == {"strict", "normalized", "failed"}
    plan = QUERIES["assembly_confidence"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_levels_without_words(spark):
    """Levels by the texts, against those of their words."""
    texts = ["", " ", "X 1", "1 X", " X  1 ", "x, 1", "X1", "X-1", "1-X", "-", "- X 1", "X\t1", "é X 1", "ä", "X 1 1", "1 1 X", "X_1", "a b", "B A", "b- a", "ab"]
    answers = spark.createDataFrame([(1, n, f"p{m}", a, s) for n, a in enumerate(texts) for m, s in enumerate(texts)], "stream bigint, seq bigint, anchor string, answer string, source string").localCheckpoint()
    got = apply(spark, "conservation", provider_answers=answers)
    words = answers.selectExpr("*", f"{tokens(SPARK, 'answer')} AS ta", f"{tokens(SPARK, 'source')} AS ts")
    same(got, words.selectExpr("stream", "seq", "anchor", f"{level(SPARK, 'ta', 'ts')} AS level"))
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_headers_that_begin_with_a_digit(spark):
    texts = ["HW-1", "2 SET #4 HINGE", "3 doors HW GROUP NO. 5 following:", "1 SET HINGE 5BB1", " 4 hardware groups/sets # A7 (B) following :", "Set #9"]
    made = lines(spark, texts).localCheckpoint()
    got = apply(spark, "chunk_blocks", line_roles=apply(spark, "line_roles", lines=made).localCheckpoint())
    same(got, apply(spark, "chunk_blocks", set_headers=apply(spark, "set_headers", lines=made).localCheckpoint()))
    assert [r.family for r in got.sort("line").collect()] == ["hw_bare", None, "assigned_following", None, "assigned_following", "set_hash"]
    assert ", GROUP)" in got._jdf.queryExecution().optimizedPlan().toString()


def test_only_rows_and_leftovers_are_stitched(spark):
    """Prose and notes never reach the window, and stand in no leftover's way."""
    kinds = [("rows", "row", "1 EA HINGE 630-"), ("note_lines", "prose", "prose"), ("unresolved", "orphan", "316"), ("rows", "row", "1 EA LOCK"), ("unresolved", "blank", ""), ("unresolved", "dropped_tail", "626 IVE")]
    buckets = spark.createDataFrame([(1, 1, 1, n, f"p1-L{n:02d}", t, t, n, b, k) for n, (b, k, t) in enumerate(kinds, 3)], "stream bigint, seq bigint, page bigint, line bigint, anchor string, text string, norm string, pos bigint, bucket string, kind string")
    placed = spark.createDataFrame([(1, 1, "p1-L03", "630-", None), (1, 1, "p1-L06", None, None)], "stream bigint, seq bigint, anchor string, finish string, mfr string")
    got = apply(spark, "stitch_tails", rule_buckets=buckets, rule_rows=placed)
    assert sorted((r.anchor, r.row_anchor, r.how, r.finish, r.mfr) for r in got.collect()) == [("p1-L05", "p1-L03", "hyphen_finish", "630-316", None), ("p1-L08", "p1-L06", "dropped_tail", "626", "IVE")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "bucket" in plan[plan.rindex("Window [last") :].split("LogicalRDD")[0].split("Filter", 1)[1]
