"""Documents as pages: a thousand numbers of a source are a file, a document one of its pages.

Books are pages of files in order, with signals and classes; schedules are mixed in, so that every
page class occurs: a stream's pages become a file in which every ninth page is followed by filler.
Files and streams are made from keys, of one size however large the tables are, so that no window grows with them.
"""

from __future__ import annotations

from tabulith.plans.graph import relation


def numbered(d, documents: str, *columns: str) -> str:
    """file, page (from 1, in the file), doc_id and columns, of rows with doc_id and source."""
    block = d.div("doc_id", "1000")
    return f"""
  SELECT coalesce(source, '') || '-' || {d.string(block)} AS file, row_number() OVER (PARTITION BY source, {block} ORDER BY doc_id) AS page, doc_id, {', '.join(columns)}
  FROM {documents}"""


@relation("documents", name="scan_pages")
def scan_pages(d, documents):
    """A page a document: file, page, text, chars."""
    return numbered(d, documents, "text", "CAST(length(coalesce(text, '')) AS BIGINT) AS chars")


@relation("documents", name="lines_scan")
def lines_scan(d, documents):
    """Lines of a document that are not blank, numbered from 1."""
    cell = d.explode_from(f"(SELECT doc_id, {d.split('text', chr(92) + 'n')} AS parts FROM {documents} WHERE text IS NOT NULL) s", "parts", "text", "place")
    return f"""
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS line, text
  FROM {cell} WHERE {d.has('text', '[^ \\t\\n\\x0B\\f\\r]')}"""


@relation("lines", "documents", query=False)
def book_pages(d, lines, documents):
    """Pages of books: each stream's pages as text, every document with text once as filler after a ninth page, weak and sparse pages, and closing sections.

    A page's place in its book is nine times its turn, so that fillers go between pages; by stream, one to four of them stand together. A thousand documents go into twenty books."""
    run = "(stream % 4 + 1)"
    book = f"doc_id % 20 + 20 * {d.div('doc_id', '1000')}"
    filler = f"""SELECT {d.integer(book)} AS stream, doc_id, text, row_number() OVER (PARTITION BY {book} ORDER BY doc_id) AS turn FROM {documents} WHERE text IS NOT NULL"""
    body = d.join(d.gather("text", "line"), "\n") if d.name == "oracle" else "array_join(transform(array_sort(collect_list(struct(line AS o, text AS v))), x -> x.v), '\\n')"
    newline = "chr(10)"
    body = body.replace("'\n'", newline) if d.name == "oracle" else body
    return f"""
  SELECT stream, row_number() OVER (PARTITION BY stream ORDER BY place, kind) AS page, kind, text
  FROM (
    SELECT stream, page * 9 AS place, 'schedule' AS kind, {body} AS text FROM {lines} GROUP BY stream, page
    UNION ALL SELECT stream, (turn - turn % {run}) * 81 + 1 + turn % {run}, 'filler', text FROM ({filler}) f
    UNION ALL SELECT stream, turn * 81 + 3, 'sparse', 'Door Hardware' FROM ({filler}) f
    UNION ALL SELECT stream, turn * 81 + 4, 'weak', 'Set #' || {d.string('turn')} || ' continued' FROM ({filler}) f WHERE turn % 3 = 0
    UNION ALL SELECT stream, max(page) * 9 + 1, 'closing', 'END OF SECTION 087100' FROM {lines} WHERE stream % 2 = 0 GROUP BY stream) q"""
