"""Every relation against the oracle's engine, and literal cases of the grammar."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tabulith.operators.geometry import merge_clusters
from tabulith.plans import registry
from tabulith.plans.graph import BORDERS, apply


def plain(x):
    if isinstance(x, float):
        return round(x, 6)
    return tuple(plain(y) for y in x) if isinstance(x, (list, tuple)) else x


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages labels benchmark conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows_as_the_oracle(spark, sf_dir, duck, name):
    got, want = registry.QUERIES[name](spark, sf_dir), duck.sql(registry.SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a = sorted((plain(tuple(r)) for r in got.select(*cols).collect()), key=repr)
    b = sorted((plain(r) for r in want.select(*[f'"{c}"' for c in cols]).fetchall()), key=repr)
    assert a == b


LINE = "stream long, page long, line long, anchor string, text string, x0 double, top double, x1 double, bottom double, struck double"


def lines(spark, texts):
    return spark.createDataFrame([(1, 1, i + 1, f"p1-L{i + 1:02d}", t, 72.0, 36.0 + 16 * i, 300.0, 48.0 + 16 * i, None) for i, t in enumerate(texts)], LINE)


def roles(spark, texts):
    return lines(spark, texts).withColumn("role", F.lit("content"))


@pytest.mark.parametrize(
    ("text", "family", "set_id", "trailer"),
    [
        ("PART 6 - HARDWARE GROUP NO. 103", "group_no", "103", ""),
        ("Hardware Group No. 05 - Not Used", "group_no", "05", "Not Used"),
        ("Set #PR38ICCL", "set_hash", "PR38ICCL", ""),
        ("Set #MISC", "set_hash", "MISC", ""),
        ("Set #U-01", "set_hash", "U-01", ""),
        ("Set: EX-1.0", "set_colon", "EX-1.0", ""),
        ("HW 01", "hw_bare", "01", ""),
        ("HW G01", "hw_bare", "G01", ""),
        ("Heading # 12: (Lobby", "heading", "12", "(Lobby"),
        ("For doors assigned Hardware Group/Set #103 on door schedule, provide the following:", "assigned_following", "103", "on door schedule, provide the following:"),
        ("the hardware sets indicated", None, None, None),
        ("1.1 SUMMARY", None, None, None),
    ],
)
def test_headers(spark, text, family, set_id, trailer):
    row = apply(spark, "set_headers", line_roles=roles(spark, [text])).first()
    assert (row.family, row.set_id, row.trailer) == (family, set_id, trailer)


def test_dotted_headers_need_their_announcement(spark):
    rows = apply(spark, "set_headers", line_roles=roles(spark, ["1.1 HINGES 3"])).collect()
    assert rows[0].family is None
    gated = roles(spark, ["SET HARDWARE TYPE MANUFACTURER", "1.1 HINGES 3"])
    assert [r.set_id for r in apply(spark, "set_headers", line_roles=gated).sort("line").collect()] == [None, "1.1"]


def test_terminator_closes_a_block(spark):
    got = apply(spark, "chunk_blocks", line_roles=roles(spark, ["before", "Set #1", "row", "PART 2 - END OF SECTION 087100", "after", "Set #2"]))
    assert [(r.part, r.seq) for r in got.sort("line").collect()] == [("preamble", None), ("block", 1), ("block", 1), ("postamble", None), ("postamble", None), ("block", 2)]


def test_roles_of_lines(spark):
    texts = ["PART 3 -", "- - -", "QTY DESCRIPTION CATALOG FINISH", "Set #4", "1 HINGE"]
    got = apply(spark, "line_roles", lines=lines(spark, texts)).sort("line").collect()
    assert [r.role for r in got] == ["noise", "noise", "col_hdr", "content", "content"]


def body(spark, texts):
    return roles(spark, ["Set #1", *texts])


@pytest.mark.parametrize(
    ("text", "qty", "unit", "rest"),
    [("3.0 Hinge 5BB1", 3.0, None, "Hinge 5BB1"), ("1 EA-R AUTO OPERATOR 9542", 1.0, "EA-R", "AUTO OPERATOR 9542"), ("2 Ea. Closer", 2.0, "Ea.", "Closer"), ("1 SET-UP KITS", 1.0, None, "SET-UP KITS")],
)
def test_quantities(spark, text, qty, unit, rest):
    row = apply(spark, "qty_split", line_roles=body(spark, [text])).first()
    assert (row.qty, row.unit, row.rest) == (qty, unit, rest)


def test_article_numbers_are_no_quantities(spark):
    assert apply(spark, "qty_split", line_roles=body(spark, ["1.1 SUMMARY", "3.7 DEMONSTRATION"])).count() == 0


def vocabulary(spark):
    values = [("mfr", "LCN"), ("mfr", "IVE"), ("mfr", "HD"), ("mfr", "MANUFACTURER"), ("finish", "691"), ("finish", "630")]
    return spark.createDataFrame([(1, r, v, "legend") for r, v in values], "stream long, role string, value string, origin string")


def schema(spark):
    return spark.createDataFrame([(1, -1, -2)], "stream long, mfr_slot int, finish_slot int")


def run(spark, name, texts):
    return apply(spark, name, line_roles=body(spark, texts), vocabulary=vocabulary(spark), column_schema=schema(spark))


def test_buckets(spark):
    texts = [
        "2 5 25 33", "PROVIDE EACH OPENING WITH:", "Description: Lobby", "Description: Again", "For use on Door #(s):", "134", "137A 210A", "Each to have:", "NOTE: verify", "by owner, all of it in time",
        "1 Single Operator 4040 691 LCN", "1 Single leaf", "900 x 2100", "691 LCN", "316", "Properties: Rated", "this is prose of more than three words", "OPERATION: locked", "1 HINGE 5BB1 691 LCN",
    ]
    got = {r.text: (r.bucket, r.kind) for r in run(spark, "rule_buckets", texts).collect()}
    assert [got[t] for t in texts] == [
        ("door_lines", "door"), ("door_lines", "opener"), ("description", "description"), ("door_lines", "door_header"), ("door_lines", "door_header"), ("door_lines", "door"), ("door_lines", "door"),
        ("note_lines", "note"), ("note_lines", "note_header"), ("note_lines", "note"), ("rows", "row"), ("door_lines", "door"), ("door_lines", "door"), ("unresolved", "dropped_tail"), ("unresolved", "orphan"),
        ("properties", "properties"), ("note_lines", "prose"), ("note_lines", "note_header"), ("note_lines", "note"),
    ]


def test_dropped_tails_and_hyphens_are_stitched(spark):
    got = {r.rest: (r.finish, r.mfr) for r in run(spark, "repaired_rows", ["1 CLOSER 4040 ARM", "691 LCN", "1 HINGE 5BB1 630- IVE", "316", "2 BOLT 9"]).collect()}
    assert got == {"CLOSER 4040 ARM": ("691", "LCN"), "HINGE 5BB1": ("630-316", "IVE"), "BOLT 9": (None, None)}


def test_by_phrases(spark):
    got = {r.rest: r.mfr for r in run(spark, "repaired_rows", ["1 GASKETING BY ALUMINUM DOOR MANUFACTURER", "1 LOCK Furnished by Security Contractor HD"]).collect()}
    assert got == {"GASKETING BY ALUMINUM DOOR MANUFACTURER": None, "LOCK Furnished by Security Contractor": "HD"}


def test_split_hints(spark):
    got = {r.rest: r.split_hint for r in run(spark, "split_hint", ["1 PERMANENT CORE COORDINATE WITH OWNER", "2 HINGE 5BB1 4.5"]).collect()}
    assert got == {"PERMANENT CORE COORDINATE WITH OWNER": None, "HINGE 5BB1 4.5": 1}


def test_trailers_go_on(spark):
    got = apply(spark, "trailer_continuation", line_roles=roles(spark, ["Set #1: (Door", "U1)", "1 HINGE 5"])).collect()
    assert [(r.anchor, r.trailer) for r in got] == [("p1-L02", "(Door U1)")]


def test_clusters_fold_the_weighted_mean(spark):
    df = spark.createDataFrame([([(1.0, 1), (2.5, 3), (9.0, 2)],)], "p array<struct<x:double,n:bigint>>")
    assert [tuple(c) for c in df.select(merge_clusters(F.col("p")).alias("c")).first().c] == [(2.125, 4), (9.0, 2)]


def loop_regions(classes, sparse):
    """Regions by walking the pages one by one."""
    dense = [i for i, s in enumerate(sparse) if not s]
    place = {p: k for k, p in enumerate(dense)}
    strong = [p for p in dense if classes[p] == "strong"]
    spans = []
    for p in strong:
        if spans and place[p] - place[spans[-1][1]] - 1 <= 2:
            spans[-1][1] = p
        else:
            spans.append([p, p])
    for s in spans:
        while place[s[0]] > 0 and classes[dense[place[s[0]] - 1]] == "weak":
            s[0] = dense[place[s[0]] - 1]
        while place[s[1]] + 1 < len(dense) and classes[dense[place[s[1]] + 1]] == "weak":
            s[1] = dense[place[s[1]] + 1]
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a + 1, b + 1) for a, b in out]


def test_regions_against_a_walk(spark):
    import random

    rng = random.Random(5)
    rows, want = [], {}
    for stream in range(60):
        classes = [rng.choices(["strong", "weak", "none"], [3, 2, 4])[0] for _ in range(30)]
        sparse = [c == "none" and rng.random() < 0.4 for c in classes]
        rows += [(stream, i + 1, c, s) for i, (c, s) in enumerate(zip(classes, sparse, strict=True))]
        want[stream] = loop_regions(classes, sparse)
    got = {}
    pages = spark.createDataFrame(rows, "stream long, page long, class string, sparse boolean")
    for r in apply(spark, "regions", page_class=pages).sort("stream", "region").collect():
        got.setdefault(r.stream, []).append((r.first_page, r.last_page))
    assert got == {k: v for k, v in want.items() if v}


def test_nothing_is_lost_in_the_cut(spark, sf_dir):
    assert registry.QUERIES["partition_check"](spark, sf_dir).count() == 0


def test_empty_tables_give_empty_results(spark):
    empty = roles(spark, ["x"]).limit(0)
    for name in ("blocks", "block_spans", "rule_buckets", "repaired_rows", "set_records"):
        assert apply(spark, name, BORDERS, line_roles=empty).count() == 0


def test_pages_that_recur_stay_in_their_runs(spark):
    def runs(**files):
        pages = spark.createDataFrame([(f, i + 1, h) for f, hs in files.items() for i, h in enumerate(hs)], "file string, page long, hash string")
        return sorted((r.first_page, r.last_page, r.twin_first, r.pages) for r in apply(spark, "duplicate_regions", page_hash=pages).collect())

    assert runs(a="XYXZ", b="XYXZ") == [(1, 1, 3, 1), (1, 4, 1, 4), (3, 3, 1, 1)]
    # X also comes earlier in the twin
    assert runs(a="XYZ", b="XQXYZ") == [(1, 1, 1, 1), (1, 3, 3, 3)]


def test_header_words_vote_with_their_own_edges(spark):
    # stream 1: the header is line 1; stream 2: a running header with glued words; stream 3: two labels only
    heads = spark.createDataFrame(
        [(1, 1, 1, "Qty Description Finish", 30.0, 40.0, "col_hdr"), (1, 2, 3, "Qty Description Finish", 60.0, 70.0, "col_hdr"), (2, 1, 1, "QTY.FINISH MFR", 30.0, 40.0, "page_header"), (3, 1, 1, "FINISH MFR", 30.0, 40.0, "content")],
        "stream long, page long, line long, text string, top double, bottom double, role string",
    )
    words = spark.createDataFrame(
        [(1, 1, "Qty", 50.0, 65.0, 31.0, 39.0), (1, 1, "Finish", 401.5, 430.0, 31.0, 39.0), (1, 1, "FINISH", 9.0, 39.0, 50.0, 60.0), (1, 2, "Qty", 50.0, 65.0, 61.0, 69.0), (1, 2, "Finish", 403.0, 430.0, 61.0, 69.0)]
        + [(2, 1, "QTY.FINISH", 100.0, 150.0, 31.0, 39.0), (2, 1, "MFR", 300.0, 315.0, 31.0, 39.0), (3, 1, "MFR", 300.0, 315.0, 31.0, 39.0)],
        "stream long, page long, text string, x0 double, x1 double, top double, bottom double",
    )
    got = sorted(map(tuple, apply(spark, "header_anchor_vote", words=words, line_roles=heads).collect()))
    assert got == [(1, "finish", 401.5, 1), (1, "qty", 50.0, 2), (2, "finish", 120.0, 1), (2, "mfr", 300.0, 1), (2, "qty", 100.0, 1)]


def test_every_stream_votes(spark, sf_dir):
    streams = lambda name: {r.stream for r in registry.QUERIES[name](spark, sf_dir).select("stream").distinct().collect()}
    assert streams("header_anchor_vote") == streams("role_counts")


def test_every_document_is_a_page_of_a_book_once(spark):
    docs = spark.createDataFrame([(i, None if i == 7 else f"text {i}") for i in range(200)], "doc_id long, text string")
    pages = apply(spark, "book_pages", lines=lines(spark, ["x"]), documents=docs).filter("kind = 'filler'").collect()
    assert sorted(r.text for r in pages) == sorted(f"text {i}" for i in range(200) if i != 7)
    assert all(int(r.text.split()[1]) % 20 == r.stream for r in pages)


def test_titles_look_for_a_reference_below_and_on_the_next_page(spark):
    title, refer = "HARDWARE SETS", "Refer to Section 08 71 00"
    long = "\n".join(["x" * 40] * 7)
    books = [
        ([f"text\n{title}", f"{refer}"], "stub"),  # at the foot of a page
        ([f"{title}\n{refer}"], "stub"),
        ([f"{title}\n" + "a\n" * 6 + refer], "stub"),
        ([f"{title}\n" + "a\n" * 7 + refer], "unreconciled"),  # the eighth line below
        ([f"{refer}\n{title}"], "unreconciled"),  # above the title
        ([f"{title}\n{long}", refer], "unreconciled"),  # the lines below are long enough
        ([title, "x" * 398 + " " + refer], "unreconciled"),  # past the 400th character
        ([title, "no", refer], "unreconciled"),  # the page after the next
    ]
    pages = spark.createDataFrame([(k, i + 1, "filler", t) for k, (texts, _) in enumerate(books) for i, t in enumerate(texts)], "stream long, page long, kind string, text string")
    floor = spark.createDataFrame([], "stream long, first_page long, last_page long, accepted boolean")
    got = {(r.stream, r.page): r.verdict for r in apply(spark, "title_reconcile", book_pages=pages, region_floor=floor).collect()}
    assert got == {(k, 1): verdict for k, (_, verdict) in enumerate(books)}
