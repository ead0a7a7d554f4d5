"""Literal cases of words, records, fingerprints, twins, header components, assembly repairs and jobs."""

import hashlib
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from tabulith.functions import provider
from tabulith.operators import catalog
from tabulith.plans import registry
from tabulith.plans.graph import ORACLE, apply, render
from tabulith.sources import sinks
from tabulith.sources.schedule import DOTTED

COMPONENT = "stream long, seq long, anchor string, qty double, unit string, description string, catalog_number string, mfr string, finish string, tail_anchor string, hyphen_anchor string"
ANSWER = "stream long, seq long, anchor string, rn int, source string, answer string, claimed string, pseudo boolean, pseudo_reason string"


def test_words_that_are_alike_all_stay(spark):
    words = spark.createDataFrame([(1, 1, 3, k, "HINGE", 100.0, 125.0, 30.0, 38.0) for k in (7, 8)], "stream long, page long, line long, word long, text string, x0 double, x1 double, top double, bottom double")
    lines = spark.createDataFrame([(1, 1, 3, "p1-L03", "content", 28.0, 40.0)], "stream long, page long, line long, anchor string, role string, top double, bottom double")
    got = apply(spark, "word_line_assign", words=words, line_roles=lines).collect()
    assert sorted((r.anchor, r.idx, r.text) for r in got) == [("p1-L03", 1, "HINGE"), ("p1-L03", 2, "HINGE")]


def test_exports_are_json_whatever_the_text(spark):
    odd = 'A\\B "q"\n\té'
    parts = spark.createDataFrame([(1, 1, "p10-L03", 1.0, None, odd, None, None, "630", None, None), (1, 1, "p9-L40", 2.0, "EA", "second", "C", "IVE", None, None, None)], COMPONENT)
    sets = spark.createDataFrame([(1, 1, odd, "d", "p9-L01"), (1, 2, "2", None, None)], "stream long, seq long, set_number string, description string, header_anchor string")
    rows = {r.seq: json.loads(r.json) for r in apply(spark, "export_json", baseline_components=parts, set_records=sets).collect()}
    assert rows[1]["set_number"] == odd and rows[2] == {"components": [], "description": None, "header_anchor": None, "set_number": "2"}
    assert [c["anchor"] for c in rows[1]["components"]] == ["p9-L40", "p10-L03"]  # by numbers
    assert rows[1]["components"][1] == {"anchor": "p10-L03", "catalog_number": None, "description": odd, "finish": "630", "mfr": None, "qty": 1.0, "unit": None}
    assert list(rows[1]) == sorted(rows[1]) and list(rows[1]["components"][0]) == sorted(rows[1]["components"][0])


def test_fingerprints_agree_and_are_those_of_the_request(spark):
    prompt = 'p1-L02 | "quoted" \\ and\nnewline é'
    rendered = spark.createDataFrame([(1, 1, prompt, 2)], "stream long, seq long, prompt string, n_lines long")
    relation = apply(spark, "prompt_fingerprint", prompt_render=rendered).first().fingerprint
    column = rendered.select(provider.fingerprint().alias("f")).first().f
    request = {"effort": provider.EFFORT, "max_tokens": provider.MAX_TOKENS, "model": provider.MODEL, "schema": provider.SCHEMA, "system": provider.SYSTEM, "user": prompt}
    plain = hashlib.sha256(json.dumps(request, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()[:32]
    assert relation == column == plain
    other = rendered.select(provider.fingerprint(system="another").alias("f")).first().f
    assert other != plain


def test_stored_answers_are_asked_for_once(spark, tmp_path):
    prompts = spark.createDataFrame([(1, "x | component row a"), (2, "note")], "id int, prompt string")
    path = str(tmp_path / "cache")
    for _ in range(2):
        got = {r.id: r.answer for r in provider.ask_stored(prompts, path).collect()}
        assert got == {1: "x | component row a", 2: ""}
    assert spark.read.parquet(path).count() == 2


def regions(spark, files):
    """files: name -> (pages of the file, first page, hashes of its one region)."""
    rows = [(name, pages, 1, first, i, h) for name, (pages, first, hashes) in files.items() for i, h in enumerate(hashes)]
    return spark.createDataFrame(rows, "file string, pages long, region long, first_page long, place long, hash string")


def test_region_twins(spark):
    def twins(**files):
        return {r.file: (r.twin, r.twin_first, r.twin_last) for r in apply(spark, "region_twins", shipped_regions=regions(spark, files)).collect()}

    assert twins(a=(9, 2, "XYZ"), b=(9, 2, "XYZ")) == {}  # equal regions of equal files
    assert twins(a=(9, 2, "XYZ"), b=(20, 5, "XYZ")) == {"b": ("a", 2, 4)}  # the larger file's is the copy
    assert twins(a=(9, 2, "YZ"), b=(9, 5, "XYZW")) == {"a": ("b", 6, 7)}  # a part of a longer one
    assert twins(a=(9, 1, "XYZW"), b=(9, 1, "XYQ")) == {}
    assert twins(a=(9, 1, "XX"), b=(9, 1, "XYXX")) == {"a": ("b", 3, 4)}
    assert twins(a=(9, 1, "YZ"), c=(30, 7, "XYZ"), b=(30, 1, "XYZ")) == {"a": ("b", 2, 3)}  # the first by name of equal holders
    assert twins(a=(9, 1, "Z")) == {}


def test_a_part_of_its_own_file_is_no_twin(spark):
    rows = [("a", 9, 1, 1, i, h) for i, h in enumerate("XYZ")] + [("a", 9, 2, 6, 0, "Y")]
    frame = spark.createDataFrame(rows, "file string, pages long, region long, first_page long, place long, hash string")
    assert apply(spark, "region_twins", shipped_regions=frame).count() == 0
    more = frame.unionByName(spark.createDataFrame([("b", 90, 1, 11, i, h) for i, h in enumerate("XYZ")], frame.schema))
    got = {(r.file, r.region): (r.twin, r.twin_first) for r in apply(spark, "region_twins", shipped_regions=more).collect()}
    assert got == {("a", 2): ("b", 12), ("b", 1): ("a", 1)}


def test_twin_ids_and_families(spark):
    blocks = spark.createDataFrame([(1, 1, "7", "heading"), (1, 2, "7", "heading"), (2, 1, "7", "set_hash"), (2, 2, "8", "set_hash"), (11, 1, "8", "heading")], "stream long, seq long, set_id string, family string")
    assert [tuple(r) for r in apply(spark, "twin_ids", blocks=blocks).collect()] == [(0, "7", "1,2", 2)]
    assert sorted(map(tuple, apply(spark, "family_counts", blocks=blocks).collect())) == [(1, "heading", 2), (2, "set_hash", 2), (11, "heading", 1)]
    assert [tuple(r) for r in apply(spark, "duplicate_ids", blocks=blocks).collect()] == [(1, "7", 2)]


ZONES = [(1, "mfr", 220.0, 300.0, "header"), (1, "qty", 300.0, 340.0, "header"), (1, "finish", 340.0, None, "header")]


@pytest.mark.parametrize(
    ("words", "want"),
    [
        (
            [("4.6", 72), ("MORTISE", 100), ("HINGE", 140), ("IVES", 220), ("-", 240), ("5BB1", 250), ("5", 299), ("613", 340), ("(OIL", 360), ("RUBBED", 380), ("BRONZE)", 400), ("PER", 430), ("OWNER", 450)],
            (5, "MORTISE HINGE", "IVES", "5BB1", "613 (OIL RUBBED BRONZE)", "PER OWNER"),
        ),
        ([("4.6", 72), ("HINGE", 100), ("5BB1", 250), ("2.0", 310), ("3", 320), ("626", 345)], (2, "HINGE", None, "5BB1", "626", None)),
        ([("4.6", 72), ("PIVOT", 100), ("630", 345), ("see", 370), ("(note)", 390)], (None, "PIVOT", None, None, "630 (note)", "see")),
        ([("4.6", 72), ("3", 310)], None),
    ],
)
def test_header_components(spark, words, want):
    headers = spark.createDataFrame([(1, 9, "4.6", "bare_dotted", i, t, float(x)) for i, (t, x) in enumerate(words)], "stream long, header long, set_id string, family string, idx long, text string, x0 double")
    zones = spark.createDataFrame(ZONES, "stream long, role string, lo double, hi double, origin string")
    got = [(r.qty, r.description, r.mfr, r.catalog_number, r.finish, r.note) for r in apply(spark, "header_component", dotted_headers=headers, dotted_zones=zones).collect()]
    assert got == ([want] if want else [])
    # not in other families, nor with columns that no header word measured
    assert apply(spark, "header_component", dotted_headers=headers.withColumn("family", F.lit("heading")), dotted_zones=zones).count() == 0
    assert apply(spark, "header_component", dotted_headers=headers, dotted_zones=zones.withColumn("origin", F.lit("band"))).count() == 0
    assert set(DOTTED) == {"description", "mfr", "qty", "finish"}


def answers(spark, rows):
    return spark.createDataFrame([(1, 1, a, i + 1, s, t, a, p, "heading" if p else None) for i, (a, s, t, p) in enumerate(rows)], ANSWER)


def test_assembly_falls_back_counts_again_and_demotes(spark):
    given = answers(
        spark,
        [
            ("p1-L01", "HINGE 5BB1", "HINGE 5BB1", False),
            ("p1-L02", "CLOSER 4040 ARM", "CLOSER 4040", False),  # a word lost: the line's own split
            ("p1-L03", "LOCK 9080 626 626", "LOCK 9080 626", False),  # one of two equal words lost, the other went to its column
            ("p1-L04", "HARDWARE BY OTHERS", "HARDWARE BY OTHERS", True),
        ],
    )
    detached = spark.createDataFrame([(1, 1, "p1-L03", "finish", "626", "9080")], "stream long, seq long, anchor string, role string, value string, catalog_number string")
    got = {r.anchor: (r.text, r.level, r.fell_back_to_split_hint, r.conservation_failed) for r in apply(spark, "assembled_components", provider_answers=given, catalog_detach=detached).collect()}
    assert got == {"p1-L01": ("HINGE 5BB1", "strict", False, False), "p1-L02": ("CLOSER 4040 ARM", "failed", True, True), "p1-L03": ("LOCK 9080 626 626", "failed", True, True)}
    out = [tuple(r) for r in apply(spark, "demoted", provider_answers=given).collect()]
    assert out == [(1, 1, "p1-L04", "HARDWARE BY OTHERS", "heading", '{"answer":"HARDWARE BY OTHERS","level":"strict"}')]


def test_counting_again_may_clear_a_failure(spark):
    given = answers(spark, [("p1-L01", "LOCK 9080 626", "LOCK 9080", False), ("p1-L02", "BOLT 9 IVE", "BOLT 9 IVE", False), ("p1-L03", "STOP A", "STOP B IVE", False)])
    moved = [(1, 1, a, "finish", v, None) for a, v in (("p1-L01", "626"), ("p1-L02", "IVE"), ("p1-L03", "IVE"))]
    detached = spark.createDataFrame(moved, "stream long, seq long, anchor string, role string, value string, catalog_number string")
    got = {r.anchor: (r.level, r.new_level) for r in apply(spark, "recounted", provider_answers=given, catalog_detach=detached).collect()}
    assert got == {"p1-L01": ("failed", "strict"), "p1-L02": ("strict", "strict"), "p1-L03": ("failed", "failed")}


def test_border_words_are_cut_out(spark):
    swept = spark.createDataFrame([(1, 1, "p1-L03", "AN or HINGE or laitnedifnoc", "p1-L99"), (1, 2, "p1-L04", "plain", "p1-L98")], "stream long, seq long, anchor string, answer string, also string")
    border = spark.createDataFrame([(1, 1, 99, "p1-L99", "laitnedifnoc or"), (1, 1, 98, "p1-L98", "gone")], "stream long, page long, line long, anchor string, text string")
    got = {r.anchor: r.answer for r in apply(spark, "rotated_excised", swept_answers=swept, rotated_lines=border.drop("text"), border_lines=border).collect()}
    assert got == {"p1-L03": "AN or HINGE", "p1-L04": "plain"}


def test_furniture_against_a_loop(spark):
    rows = [(1, p, 1, f"RUNNING {p}", 30.0 + (p == 2)) for p in range(1, 6)] + [(1, p, 2, "MIDDLE", 400.0) for p in range(1, 6)] + [(1, p, 3, "LOW", 700.0 + 9 * p) for p in range(1, 6)] + [(1, 1, 4, "once", 500.0)]
    lines = spark.createDataFrame([(s, p, n, f"p{p}-L{n:02d}", t, 72.0, y, 100.0, y + 12, None) for s, p, n, t, y in rows], "stream long, page long, line long, anchor string, text string, x0 double, top double, x1 double, bottom double, struck double")
    got = {r.norm: (r.pages, r.y_median, r.y_dev, r.role, r.why) for r in apply(spark, "furniture_groups", lines=lines).collect()}
    assert got == {"RUNNING #": (5, 30.0, 1.0, "page_header", None), "MIDDLE": (5, 400.0, 0.0, None, "stable_repeat_outside_bands")}


def test_every_line_with_glyphs_is_measured(spark):
    lines = spark.createDataFrame([(1, 1, n, f"p1-L{n:02d}", "abcd", 72.0, 20.0 * n, 92.0, 20.0 * n + 12, s) for n, s in ((1, None), (2, 1.0), (3, 0.5))], "stream long, page long, line long, anchor string, text string, x0 double, top double, x1 double, bottom double, struck double")
    assert apply(spark, "glyphs", lines=lines).count() == 12
    got = {r.line: r.struck for r in apply(spark, "struck_fraction", lines=lines).collect()}
    assert got == {2: 1.0, 3: 0.5}


def test_search_and_selection(spark):
    sets = spark.createDataFrame([(1, 1, "Group No. 7", None, "p1-L01"), (12, 2, "8", "Opening TYPE 3", None)], "stream long, seq long, set_number string, description string, header_anchor string")
    assert sorted((r.search, r.stream) for r in apply(spark, "set_search", set_records=sets).collect()) == [("GROUP NO. 7", 1), ("p1-L", 1), ("type 3", 12)]
    assert [r.stream for r in catalog.select_sets(sets, "2").collect()] == [12]
    assert [r.stream for r in catalog.select_sets(sets, seqs=[1, 5]).collect()] == [1]
    assert catalog.select_sets(sets, "1", []).count() == 0 and catalog.select_sets(sets).count() == 2


def test_jobs(spark):
    events = spark.createDataFrame([(i, 1, "click") for i in range(1, 61)] + [(61, 2, "signup"), (62, 2, "view"), (70, 3, "purchase"), (71, None, "view")], "event_id long, user_id long, event_type string")
    got = {r.job: (r.status, r.error) for r in apply(spark, "job_restart", events=events).collect()}
    assert got == {1: ("no_sets", None), 2: ("error", "interrupted by a restart"), 3: ("done", None)}
    assert [r.job for r in apply(spark, "job_listing", events=events).collect()] == [3, 2, 1]
    tail = sorted((r.line, r.event_id) for r in apply(spark, "job_log_tail", events=events).collect() if r.job == 1)
    assert tail == [(n, n) for n in range(21, 61)]


def test_reports_round_trip(spark, tmp_path):
    reports = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "project long, name string, n long")
    sinks.write_report(reports, str(tmp_path / "r"))
    at = str(tmp_path / "r" / "project=2")
    assert sinks.read_report(spark, at) == {"n": 5, "name": "b", "project": 2}
    assert sinks.read_report(spark, str(tmp_path / "r" / "project=1"))["n"] is None
    assert sinks.read_report(spark, str(tmp_path / "none")) == {}


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        applicationId, master = "app-x", "local-cluster[2,1,1024]"

        class _jsc:
            @staticmethod
            def sc():
                class Sc:
                    def getCheckpointDir(self):
                        class Nothing:
                            def isDefined(self):
                                return False

                        return Nothing()

                return Sc()

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError):
        sinks.shared_folder(Session)


def test_nets_have_rows_to_catch(spark, sf_dir):
    """The data make every net of the cut catch something, but for the partition check, which must be empty."""
    for name in ("oversized_blocks", "duplicate_ids", "twin_ids", "set_search", "stale_outputs", "region_twins", "header_component", "demoted", "rotated_excised"):
        assert registry.QUERIES[name](spark, sf_dir).limit(1).count(), name


def test_split_schedules(spark):
    blocks = spark.createDataFrame([(1, 1, "7", False), (1, 2, "9", True), (2, 1, "1", True), (3, 1, "2", False), (12, 1, "3", True)], "stream long, seq long, set_id string, empty boolean")
    lines = spark.createDataFrame([(2, "postamble")], "stream long, part string")
    assert [tuple(r) for r in apply(spark, "split_schedule", blocks=blocks, chunk_blocks=lines).collect()] == [(1, 2, "9")]


def test_clusters_of_the_oracle_are_the_same_fold(spark):
    rows = [(1, 1.0, 1), (1, 2.5, 3), (1, 9.0, 2), (2, 4.0, 7)]
    from tabulith.operators.geometry import x0_clusters, x0_clusters_oracle

    got = sorted(map(tuple, x0_clusters(spark.createDataFrame(rows, "stream long, x0 double, n long")).collect()))
    values = ", ".join(f"({s}, {x}::DOUBLE, {n}::BIGINT)" for s, x, n in rows)
    assert got == sorted(duckdb.sql(x0_clusters_oracle(f"SELECT * FROM (VALUES {values}) t(stream, x0, n)")).fetchall()) == [(1, 2.125, 4), (1, 9.0, 2), (2, 4.0, 7)]


def test_relations_that_several_read_are_computed_once_by_the_oracle():
    assert "AS MATERIALIZED (" in render("component_flags", ORACLE)
