"""Serving: anchors and boxes, search, listings, exports, uploads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.operators.assemble import totals
from tabulith.plans.graph import relation

PAGE_WIDTH, PAGE_HEIGHT, PAD = 612, 792, 2
UPLOAD_BYTES = 400 * 1024 * 1024


@relation("lines")
def anchor_codec(d, lines):
    """Anchors taken apart and put together again; they sort by numbers, not as text."""
    page, line = f"CAST({d.cut('anchor', '^p([0-9]+)-L([0-9]+)$', 1)} AS BIGINT)", f"CAST({d.cut('anchor', '^p([0-9]+)-L([0-9]+)$', 2)} AS BIGINT)"
    return f"SELECT stream, anchor, {page} AS page, {line} AS line, anchor = {d.anchor(page, line)} AS whole FROM {lines}"


@relation("baseline_components", "lines")
def anchor_boxes(d, components, lines):
    """The boxes of a component's lines, in its anchors' order; anchors without a line have none."""
    one = lambda place, column: f"SELECT stream, seq, anchor AS component, {place} AS place, {column} AS anchor FROM {components} WHERE {column} IS NOT NULL"
    return f"""
  SELECT a.stream, a.seq, a.component, a.place, a.anchor, l.page, l.x0, l.top, l.x1, l.bottom
  FROM ({one(1, 'anchor')} UNION ALL {one(2, 'tail_anchor')} UNION ALL {one(3, 'hyphen_anchor')}) a JOIN {lines} l ON l.stream = a.stream AND l.anchor = a.anchor"""


@relation("anchor_boxes")
def bbox_percent(d, boxes):
    """Boxes as percents of the page, two points wider on each side."""
    return f"""
  SELECT stream, component, place, round((x0 - {PAD}) / {PAGE_WIDTH} * 100, 3) AS left_pct, round((top - {PAD}) / {PAGE_HEIGHT} * 100, 3) AS top_pct,
    round((x1 - x0 + {2 * PAD}) / {PAGE_WIDTH} * 100, 3) AS width_pct, round((bottom - top + {2 * PAD}) / {PAGE_HEIGHT} * 100, 3) AS height_pct FROM {boxes}"""


@relation("pages")
def slug(d, pages):
    """File-name forms of a url: with underscores, and trimmed and cut to 48 characters."""
    form = d.swap("url", "[^A-Za-z0-9._-]+", "_")
    return f"SELECT page_id, {form} AS stem, coalesce(nullif(substring({d.swap(form, '^[._-]+|[._-]+$', '')}, 1, 48), ''), 'upload') AS upload FROM {pages} WHERE url IS NOT NULL"


SEARCHES = ["type 3", "GROUP NO. 7", "p1-L", "not there"]


@relation("set_records")
def set_search(d, sets):
    """Sets whose number, description or header holds a text, whatever its case; a row for each text that finds the set."""
    found = f"instr(lower(coalesce(set_number, '') || ' ' || coalesce(description, '') || ' ' || coalesce(header_anchor, '')), lower(search)) > 0"
    cell = d.explode_from(f"(SELECT *, {d.list(*map(d.text, SEARCHES))} AS searches FROM {sets}) s", "searches", "search", "place")
    return f"SELECT search, stream, seq, set_number FROM {cell} WHERE {found}"


def select_sets(sets: DataFrame, project: str | None = None, seqs: list[int] | None = None) -> DataFrame:
    """Sets of the projects whose name (stream) contains a text, and of the given numbers; None lets all through."""
    out = sets if project is None else sets.filter(F.col("stream").cast("string").contains(project))
    return out if seqs is None else out.filter(F.col("seq").isin(*seqs))


@relation("set_records", "file_verdict", "assembly_summary", "region_twins", spark=("assembly_confidence",), spared=("assembly_summary",))
def catalog_streams(d, sets, verdicts, summary, twins, confidence):
    """A listing of streams: corpus and uploads (every seventh), their sizes, the confidence of their components, whether a region of theirs is a copy, and their place in their project's list (ten streams)."""
    if d.name == "spark" and summary == "assembly_summary":  # not given, so the listing needs no prompts
        summary = f"({totals(sets, confidence)})"
    return f"""
  SELECT stream, origin, n_sets, n_components, n_empty, high, medium, low, verdict, duplicate, row_number() OVER (PARTITION BY origin, {d.div('stream', '10')} ORDER BY duplicate, stream) AS place
  FROM (
    SELECT s.stream, CASE WHEN s.stream % 7 = 6 THEN 'upload' ELSE 'corpus' END AS origin, s.n_sets, s.n_components, s.n_empty, s.high, s.medium, s.low, v.verdict, t.file IS NOT NULL AS duplicate
    FROM {summary} s LEFT JOIN {verdicts} v ON v.stream = s.stream LEFT JOIN (SELECT DISTINCT file FROM {twins}) t ON t.file = {d.string('s.stream')}) q"""


@relation("catalog_streams", spark=("set_records", "region_twins"), spared=("catalog_streams",))
def catalog_stats(d, streams, sets, twins):
    """Totals with and without streams that repeat others."""
    if d.name == "spark" and streams == "catalog_streams":  # not given, so sets and copies tell the sums
        streams = f"(SELECT s.*, t.file IS NOT NULL AS duplicate FROM ({totals(sets)}) s LEFT JOIN (SELECT DISTINCT file FROM {twins}) t ON t.file = {d.string('s.stream')}) q"
    return f"""
  SELECT count(*) AS n_streams, CAST(sum(n_sets) AS BIGINT) AS n_sets, CAST(sum(n_components) AS BIGINT) AS n_components,
    CAST(sum(CASE WHEN duplicate THEN 0 ELSE n_sets END) AS BIGINT) AS n_sets_once, CAST(sum(CASE WHEN duplicate THEN 0 ELSE n_components END) AS BIGINT) AS n_components_once FROM {streams}"""


@relation("baseline_components", "set_records")
def export_json(d, components, sets):
    """A JSON text a set, keys in order, nulls written; components in the order of their anchors (by numbers, not as text)."""
    number = lambda k: f"CAST({d.cut('anchor', '^p([0-9]+)-L([0-9]+)$', k)} AS BIGINT)"
    columns = ("anchor", "catalog_number", "description", "finish", "mfr", "qty", "unit")
    item = d.record(**{c: c for c in columns})
    kinds = ", ".join(f"{c}: {'DOUBLE' if c == 'qty' else 'STRING'}" for c in columns)
    none = d.none(f"STRUCT<{kinds}>" if d.name == "spark" else f"STRUCT({kinds.replace(':', '')})")
    return f"""
  SELECT s.stream, s.seq, {d.json(d.record(components=f'coalesce(c.items, {none})', description='s.description', header_anchor='s.header_anchor', set_number='s.set_number'))} AS json
  FROM {sets} s LEFT JOIN (SELECT stream, seq, {d.gather(item, f"{number(1)} * 10000 + {number(2)}")} AS items FROM {components} GROUP BY stream, seq) c ON c.stream = s.stream AND c.seq = s.seq"""


@relation("catalog_streams", spark=("set_records", "file_verdict"), spared=("catalog_streams",))
def project_report(d, streams, sets, verdicts):
    """One JSON document a project (ten streams): its streams in order, and their totals."""
    if d.name == "spark" and streams == "catalog_streams":  # not given, so sets and verdicts tell the rest
        streams = f"(SELECT s.*, v.verdict FROM ({totals(sets)}) s LEFT JOIN {verdicts} v ON v.stream = s.stream) q"
    item = d.record(n_components="n_components", n_sets="n_sets", stream="stream", verdict="verdict")
    return f"""
  SELECT project, {d.json(d.record(n_components='n_components', n_sets='n_sets', streams='items'))} AS report
  FROM (SELECT {d.div('stream', '10')} AS project, CAST(sum(n_components) AS BIGINT) AS n_components, CAST(sum(n_sets) AS BIGINT) AS n_sets, {d.gather(item, 'stream')} AS items FROM {streams} GROUP BY {d.div('stream', '10')}) q"""


@relation("catalog_streams", "orders")
def stale_outputs(d, streams, orders):
    """Products of an earlier run, whose books had fifty customers, that this run did not write."""
    return f"""
  SELECT 'stream-' || {d.string(d.div('o_custkey', '50'))} || '.jsonl' AS file FROM {orders}
  EXCEPT SELECT 'stream-' || {d.string('stream')} || '.jsonl' FROM {streams}"""


@relation("documents")
def upload_validate(d, documents):
    """Uploads and why they are refused: the suffix, the first bytes, the size, or nothing in them."""
    name = f"'f' || {d.string('doc_id')} || CASE WHEN doc_id % 4 = 0 THEN '.txt' ELSE '.pdf' END"
    body = "CASE WHEN doc_id % 50 = 1 THEN '' WHEN doc_id % 3 = 0 THEN coalesce(text, '') ELSE '%PDF-1.7' || coalesce(text, '') END"
    return f"""
  SELECT doc_id, name, CAST(length(body) AS BIGINT) AS n, CASE WHEN NOT lower(name) LIKE '%.pdf' THEN 'not_a_pdf_name' WHEN body = '' THEN 'empty' WHEN substring(body, 1, 5) <> '%PDF-' THEN 'no_pdf_magic' WHEN length(body) > {UPLOAD_BYTES} THEN 'too_large' ELSE 'accepted' END AS verdict
  FROM (SELECT doc_id, {name} AS name, {body} AS body FROM {documents}) q"""
