"""Cutting the content into blocks at set headers, and the nets that watch the cut."""

from __future__ import annotations

from tabulith.functions import grammar as g
from tabulith.plans.graph import relation


@relation("line_roles")
def set_headers(d, roles):
    """Content lines with family, set_id and trailer where they are set headers; the dotted family only in streams that announce it."""
    text = "trim(text)"
    families = [(name, p, "") for name, p in g.FAMILIES] + [(g.WIDE_FAMILY[0], g.WIDE_FAMILY[1], "wide AND ")]
    case = lambda group: "CASE " + " ".join(f"WHEN {gate}{d.has(text, p)} THEN {d.cut(text, p, group)}" for _, p, gate in families) + " END"
    family = f"CASE {' '.join(f"WHEN {gate}{d.has(text, p)} THEN '{name}'" for name, p, gate in families)} END"
    announced = d.has("text", g.WIDE_COLUMN_HEADER) if d.name == "oracle" else f"upper(substring(text, 1, 3)) = 'SET' AND {d.has('text', g.WIDE_COLUMN_HEADER)}"
    lines = f"(SELECT r.*, coalesce(w.wide, false) AS wide FROM {roles} r LEFT JOIN (SELECT stream, {d.any(announced)} AS wide FROM {roles} GROUP BY stream) w ON w.stream = r.stream) a"
    if d.name == "spark":  # in the order of the cut's window, so that lines are read and sorted once
        lines = f"(SELECT *, coalesce(bool_or({announced}) OVER (PARTITION BY stream ORDER BY page, line ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), false) AS wide FROM {roles}) a"
    named = f"""SELECT *, {family} AS family, {case(1)} AS set_id, {case(2)} AS tail
    FROM {lines}
    WHERE role = 'content'"""
    if d.name == "spark":  # patterns for lines with a keyword only, and a line's family once
        some = f"CASE WHEN wide OR {d.within('upper(text)', g.FAMILY_WORDS)} THEN {family} END"
        part = lambda group: "CASE family " + " ".join(f"WHEN '{name}' THEN {d.cut(text, p, group)}" for name, p, _ in families) + " END"
        named = f"SELECT *, {part(1)} AS set_id, {part(2)} AS tail FROM (SELECT *, {some} AS family FROM {lines} WHERE role = 'content') f"
    return f"""
  SELECT stream, page, line, anchor, text, x0, top, x1, bottom, family, set_id, {d.swap('trim(tail)', g.TRAILER_JOINER, '')} AS trailer
  FROM (
    {named}) q"""


def numbered_headers(d, roles: str, order: str, ends: str) -> str:
    """set_headers of Spark's own line_roles with heads and last_event, by one window: what a dotted header changes is counted beside the rest, and holds where the stream announces it."""
    whole = order.replace("ROWS UNBOUNDED PRECEDING", "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING")
    name, (wide, _) = g.WIDE_FAMILY
    family = f"CASE {' '.join(f"WHEN {d.has('trim(text)', p)} THEN '{n}'" for n, p in g.FAMILIES)} END"
    part = lambda k: "CASE family " + " ".join(f"WHEN '{n}' THEN {d.cut('trim(text)', p, k)}" for n, p in [*g.FAMILIES, g.WIDE_FAMILY]) + " END"
    digit = "(trim(text) >= '0' AND trim(text) < ':')"  # a header that begins with a digit is of the family that names a group within its line
    event = lambda opens: d.last(f"CASE WHEN {opens} THEN 'open' WHEN ends THEN 'close' END", order)
    return f"""
      SELECT *, {d.swap(f'trim({part(2)})', g.TRAILER_JOINER, '')} AS trailer, {part(1)} AS set_id
      FROM (
        SELECT stream, page, line, anchor, text, x0, top, x1, bottom, coalesce(named, CASE WHEN wide AND dotted THEN '{name}' END) AS family,
          n_named + CASE WHEN wide THEN n_dotted ELSE 0 END AS heads, CASE WHEN wide THEN wide_event ELSE event END AS last_event
        FROM (
          SELECT *, coalesce(bool_or(announced) OVER ({whole}), false) AS wide, CAST(sum(CASE WHEN named IS NOT NULL THEN 1 ELSE 0 END) OVER ({order}) AS BIGINT) AS n_named,
            CAST(sum(CASE WHEN named IS NULL AND dotted THEN 1 ELSE 0 END) OVER ({order}) AS BIGINT) AS n_dotted, {event('named IS NOT NULL')} AS event, {event('named IS NOT NULL OR dotted')} AS wide_event
          FROM (
            SELECT stream, page, line, anchor, text, x0, top, x1, bottom, role = 'content' AS content, upper(substring(text, 1, 3)) = 'SET' AND {d.has('text', g.WIDE_COLUMN_HEADER)} AS announced,
              CASE WHEN role = 'content' AND (NOT {digit} OR contains(upper(text), 'GROUP')) AND {d.within('upper(text)', g.FAMILY_WORDS)} THEN {family} END AS named,
              coalesce(role = 'content' AND contains(substring(trim(text), 2, 2), '.') AND {d.has('trim(text)', wide)}, false) AS dotted, role = 'content' AND {ends} AS ends
            FROM {roles}) r) w
        WHERE content) f"""


@relation("set_headers", spark=("line_roles",), spared=("set_headers",))
def chunk_blocks(d, headers, roles):
    """Every content line with its part (preamble, block, postamble) and its block's number in the stream."""
    order = "PARTITION BY stream ORDER BY page, line ROWS UNBOUNDED PRECEDING"
    ends = d.has("trim(text)", g.TERMINATOR)
    if d.name == "spark":  # the pattern for lines only that have its word
        ends = f"({d.within('upper(text)', ['SECTION'])} AND {ends})"
    numbered = f"""
    SELECT *, CAST(sum(CASE WHEN family IS NOT NULL THEN 1 ELSE 0 END) OVER ({order}) AS BIGINT) AS heads,
      {d.last(f"CASE WHEN family IS NOT NULL THEN 'open' WHEN {ends} THEN 'close' END", order)} AS last_event
    FROM {headers}"""
    if d.name == "spark" and headers == "set_headers":  # not given, so one window does for headers and blocks
        numbered = numbered_headers(d, roles, order, ends)
    return f"""
  SELECT stream, page, line, anchor, text, x0, top, x1, bottom, family, set_id, trailer,
    CASE WHEN heads = 0 THEN 'preamble' WHEN last_event = 'close' THEN 'postamble' ELSE 'block' END AS part,
    CASE WHEN heads > 0 AND last_event = 'open' THEN heads END AS seq
  FROM ({numbered}) q"""


@relation("chunk_blocks")
def blocks(d, lines):
    """A row a block: header, size, whether it is only a header, first and last anchor."""
    return f"""
  SELECT stream, seq, max(family) AS family, max(set_id) AS set_id, max(trailer) AS trailer, count(*) AS n_lines, count(*) = 1 AS empty,
    min_by(anchor, page * 10000 + line) AS anchor_first, max_by(anchor, page * 10000 + line) AS anchor_last, min_by(text, page * 10000 + line) AS header_text
  FROM {lines} WHERE part = 'block' GROUP BY stream, seq"""


@relation("chunk_blocks")
def block_spans(d, lines):
    """Line range and box of a block on each of its pages."""
    return f"""
  SELECT stream, seq, page, min(line) AS first_line, max(line) AS last_line, min(x0) AS x0, min(top) AS top, max(x1) AS x1, max(bottom) AS bottom
  FROM {lines} WHERE part = 'block' GROUP BY stream, seq, page"""


@relation("block_spans", "content_view")
def block_members(d, spans, content):
    """Lines by the span that holds them: an equi-join on the page, then the range."""
    return f"""
  SELECT s.stream, s.seq, c.page, c.line, c.anchor FROM {spans} s JOIN {content} c ON c.stream = s.stream AND c.page = s.page AND c.line BETWEEN s.first_line AND s.last_line"""


@relation("chunk_blocks")
def preamble_split(d, lines):
    """Lines that no block owns, and on which side of the blocks they lie."""
    return f"SELECT stream, page, line, anchor, text, part FROM {lines} WHERE part <> 'block'"


@relation("blocks")
def oversized_blocks(d, blocks):
    """Blocks of more than three times their stream's median of lines, in streams of five blocks or more."""
    return f"""
  SELECT b.stream, b.seq, b.set_id, b.n_lines, m.med FROM {blocks} b
  JOIN (SELECT stream, median(n_lines) AS med, count(*) AS n FROM {blocks} GROUP BY stream) m ON m.stream = b.stream
  WHERE n >= {g.OVERSIZE_BLOCKS} AND b.n_lines > {g.OVERSIZE_FACTOR} * med"""


@relation("blocks")
def duplicate_ids(d, blocks):
    """Set ids that occur more than once in a stream."""
    return f"SELECT stream, set_id, count(*) AS n FROM {blocks} GROUP BY stream, set_id HAVING count(*) > 1"


@relation("blocks")
def family_counts(d, blocks):
    """Blocks of each header family in a stream."""
    return f"SELECT stream, family, count(*) AS n FROM {blocks} GROUP BY stream, family"


@relation("blocks")
def twin_ids(d, blocks):
    """Set ids that several streams of a project (ten streams) have, with those streams."""
    project = d.div("stream", "10")
    return f"""
  SELECT project, set_id, {d.join(d.gather(d.string('stream'), 'stream'), ',')} AS streams, count(*) AS n FROM (SELECT DISTINCT {project} AS project, set_id, stream FROM {blocks}) q
  GROUP BY project, set_id HAVING count(*) > 1"""


@relation("block_members", "blocks", "lines")
def block_texts(d, members, blocks, lines):
    """The lines of empty blocks as anchors with their first 80 characters: what the census shows of them."""
    return f"""
  SELECT m.stream, m.seq, m.anchor, substring(l.text, 1, 80) AS text FROM {members} m JOIN {blocks} b ON b.stream = m.stream AND b.seq = m.seq AND b.empty
  JOIN {lines} l ON l.stream = m.stream AND l.anchor = m.anchor"""


@relation("chunk_blocks", "blocks")
def chunk_nets(d, lines, blocks):
    """What may have slipped through the cut, a stream."""
    return f"""
  SELECT l.stream, n_content_lines, coalesce(n_blocks, 0) AS n_blocks, coalesce(n_empty, 0) AS n_empty, suspect_headers, preamble_qty_rows, coalesce(n_blocks, 0) = 0 AS alarm
  FROM (
    SELECT stream, count(*) AS n_content_lines,
      count(CASE WHEN family IS NULL AND {d.has('text', g.SUSPECT)} THEN 1 END) AS suspect_headers,
      count(CASE WHEN part = 'preamble' AND ({d.has('text', g.QTY_UNIT_LINE)} OR {d.has('text', g.QTY_BARE_LINE)}) THEN 1 END) AS preamble_qty_rows
    FROM {lines} GROUP BY stream) l
  LEFT JOIN (SELECT stream, count(*) AS n_blocks, count(CASE WHEN empty THEN 1 END) AS n_empty FROM {blocks} GROUP BY stream) b ON b.stream = l.stream"""


@relation("blocks", "chunk_blocks")
def split_schedule(d, blocks, lines):
    """Consecutive streams of a project where the first ends with an empty block and has no postamble: a schedule cut in two."""
    return f"""
  SELECT stream, next_stream, set_id FROM (
    SELECT b.stream, b.set_id, b.empty, lead(b.stream) OVER (PARTITION BY {d.div('b.stream', '10')} ORDER BY b.stream) AS next_stream, coalesce(p.n, 0) AS post
    FROM (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY seq DESC) AS back FROM {blocks}) b
    LEFT JOIN (SELECT stream, count(*) AS n FROM {lines} WHERE part = 'postamble' GROUP BY stream) p ON p.stream = b.stream
    WHERE back = 1) q
  WHERE empty AND post = 0 AND next_stream IS NOT NULL"""


@relation("chunk_blocks", "content_view")
def partition_check(d, lines, content):
    """Content lines that the parts lose or hold twice: must be empty."""
    return f"""
  SELECT c.stream, c.anchor, count(l.anchor) AS n FROM {content} c LEFT JOIN {lines} l ON l.stream = c.stream AND l.page = c.page AND l.line = c.line
  GROUP BY c.stream, c.anchor HAVING count(l.anchor) <> 1"""
