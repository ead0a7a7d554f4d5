"""Locating schedules: page signals, classes, regions of pages, and the nets around them."""

from __future__ import annotations

from tabulith.functions import grammar as g
from tabulith.plans.graph import relation
from tabulith.sources.documents import numbered

SPACE = r"[ \t\n\x0B\f\r]"


def column_words(d, text: str, words: list[str]) -> str:
    return d.size(d.distinct(d.shared(d.every(f"upper({text})", "[A-Z]+"), d.list(*map(d.text, words)))))


@relation("book_pages")
def page_signals(d, pages):
    """Eight measures a page: counts of headers, finishes and section numbers, and of lines of four kinds."""
    lines = d.where(d.split("text", r"\n"), "l", d.has("l", r"[^ \t\n\x0B\f\r]"))
    count = lambda test: f"CAST({d.size(d.where('ls', 'l', test))} AS BIGINT)"
    return f"""
  SELECT stream, page, kind,
    CAST({d.times('text', g.SET_HEADER)} AS BIGINT) AS set_hdr,
    {count(column_words(d, 'l', g.PAGE_COLUMN_WORDS) + ' >= 3')} AS col_hdr,
    {count(d.has('l', g.QTY_UNIT_LINE))} AS qty_unit,
    {count(d.has('l', g.QTY_BARE_LINE))} AS qty_bare,
    {count(d.has('l', g.WIDE_QTY))} AS wide_qty,
    CAST({d.times('text', g.FINISH_TOKEN)} AS BIGINT) AS finish,
    CAST({d.times('text', g.SECTION_08)} AS BIGINT) AS sec_08_7x,
    CAST(length(text) AS BIGINT) AS chars,
    CAST(length(trim(text)) AS BIGINT) AS stripped
  FROM (SELECT *, {lines} AS ls FROM {pages}) q"""


@relation("page_signals")
def page_class(d, signals):
    """strong, weak or none; whether the list rules alone say strong; whether the page is sparse."""
    return f"""
  SELECT *,
    CASE WHEN chars < {g.IMAGE_ONLY_CHARS} THEN 'none' WHEN list_class = 'strong' OR wide THEN 'strong' ELSE list_class END AS class,
    stripped < {g.SPARSE_CHARS} AND set_hdr + col_hdr + qty_unit + qty_bare + wide_qty + finish = 0 AS sparse
  FROM (
    SELECT *, col_hdr >= 1 AND wide_qty >= 3 AS wide,
      CASE WHEN col_hdr >= 1 AND qty_unit + qty_bare >= 2 THEN 'strong'
        WHEN set_hdr >= 1 AND (qty_unit + qty_bare >= 3 OR finish >= 3) THEN 'strong'
        WHEN qty_unit >= 5 THEN 'strong'
        WHEN qty_bare >= 5 AND finish >= 5 THEN 'strong'
        WHEN set_hdr >= 1 THEN 'weak' ELSE 'none' END AS list_class
    FROM {signals}) q"""


@relation("page_class")
def regions(d, classes):
    """Runs of strong pages over gaps of at most two pages that aren't sparse, reaching over adjacent weak pages, merged where they touch.

    Gaps and islands over the dense numbers of the pages that aren't sparse."""
    return f"""
  SELECT stream, row_number() OVER (PARTITION BY stream ORDER BY min(lo)) AS region, min(lo) AS first_page, max(hi) AS last_page
  FROM (
    SELECT *, sum(CASE WHEN lo <= reach + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY stream ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS merged
    FROM (
      SELECT *, max(hi) OVER (PARTITION BY stream ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM (
        SELECT i.stream, coalesce(b.first_page, i.lo) AS lo, coalesce(a.last_page, i.hi) AS hi
        FROM (
          SELECT stream, min(page) AS lo, max(page) AS hi, min(dense) AS dlo, max(dense) AS dhi
          FROM (
            SELECT *, sum(CASE WHEN dense - before - 1 > {g.MAX_GAP} OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY stream ORDER BY page ROWS UNBOUNDED PRECEDING) AS island
            FROM (SELECT *, lag(dense) OVER (PARTITION BY stream ORDER BY page) AS before FROM (
              SELECT stream, page, class, row_number() OVER (PARTITION BY stream ORDER BY page) AS dense FROM {classes} WHERE NOT sparse) n
              WHERE class = 'strong') s) t
          GROUP BY stream, island) i
        LEFT JOIN (
          SELECT stream, run, min(page) AS first_page, max(page) AS last_page, min(dense) AS dlo, max(dense) AS dhi
          FROM (SELECT *, dense - row_number() OVER (PARTITION BY stream ORDER BY page) AS run FROM (
            SELECT stream, page, class, row_number() OVER (PARTITION BY stream ORDER BY page) AS dense FROM {classes} WHERE NOT sparse) n
            WHERE class = 'weak') w GROUP BY stream, run) b ON b.stream = i.stream AND b.dhi = i.dlo - 1
        LEFT JOIN (
          SELECT stream, run, min(page) AS first_page, max(page) AS last_page, min(dense) AS dlo, max(dense) AS dhi
          FROM (SELECT *, dense - row_number() OVER (PARTITION BY stream ORDER BY page) AS run FROM (
            SELECT stream, page, class, row_number() OVER (PARTITION BY stream ORDER BY page) AS dense FROM {classes} WHERE NOT sparse) n
            WHERE class = 'weak') w GROUP BY stream, run) a ON a.stream = i.stream AND a.dlo = i.dhi + 1) e) r) m
  GROUP BY stream, merged"""


@relation("regions", "page_class")
def region_floor(d, regions, classes):
    """Sums of a region's signals, and whether it is accepted or for what reason not."""
    total = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("set_hdr", "col_hdr", "qty_unit", "qty_bare", "finish"))
    return f"""
  SELECT *,
    CASE WHEN accepted THEN NULL WHEN set_hdr = 0 AND dialect <> 'wide_table' THEN 'no_set_header'
      WHEN set_hdr = 0 THEN 'few_column_headers' ELSE 'no_schedule_signal' END AS reason
  FROM (
    SELECT *, (set_hdr >= 1 AND (finish >= 1 OR qty_unit >= 1 OR col_hdr >= 1)) OR (col_hdr >= 3 AND dialect = 'wide_table') AS accepted
    FROM (
      SELECT r.stream, r.region, r.first_page, r.last_page, {total},
        count(CASE WHEN class = 'strong' THEN 1 END) AS strong_pages, count(CASE WHEN class = 'weak' THEN 1 END) AS weak_pages,
        CASE WHEN {d.all_of("class <> 'strong' OR (list_class <> 'strong' AND wide)")} THEN 'wide_table' ELSE 'list' END AS dialect
      FROM {regions} r JOIN {classes} c ON c.stream = r.stream AND c.page BETWEEN r.first_page AND r.last_page
      GROUP BY r.stream, r.region, r.first_page, r.last_page) q) q"""


@relation("regions", "page_class")
def region_dialect(d, regions, classes):
    """wide_table where every strong page of the region failed the list rules and passed the wide rule."""
    return f"""
  SELECT r.stream, r.region, CASE WHEN {d.all_of("class <> 'strong' OR (list_class <> 'strong' AND wide)")} THEN 'wide_table' ELSE 'list' END AS dialect
  FROM {regions} r JOIN {classes} c ON c.stream = r.stream AND c.page BETWEEN r.first_page AND r.last_page GROUP BY r.stream, r.region"""


@relation("region_floor")
def dense_rejections(d, floor):
    """Rejected regions that are dense with finishes and quantities all the same."""
    return f"""
  SELECT stream, region, first_page, last_page, finish, qty_unit + qty_bare AS qty, reason FROM {floor}
  WHERE NOT accepted AND last_page - first_page + 1 >= {g.DENSE_PAGES} AND finish >= {g.DENSE_FINISH} AND qty_unit + qty_bare >= {g.DENSE_QTY}"""


@relation("book_pages", "region_floor")
def suspect_pages(d, pages, floor):
    """The first header-like line of each page outside all accepted regions; the first eight pages of a stream are samples."""
    cell = d.explode_from(f"(SELECT p.stream, p.page, {d.split('p.text', chr(92) + 'n')} AS parts FROM {pages} p LEFT ANTI JOIN {floor} f ON f.stream = p.stream AND f.accepted AND p.page BETWEEN f.first_page AND f.last_page) s", "parts", "text", "place")
    if d.name == "oracle":
        cell = cell.replace("LEFT ANTI JOIN", "ANTI JOIN")
    return f"""
  SELECT stream, page, text, row_number() OVER (PARTITION BY stream ORDER BY page) <= 8 AS sample
  FROM (SELECT stream, page, place, substring(trim(text), 1, 80) AS text, row_number() OVER (PARTITION BY stream, page ORDER BY place) AS rn FROM {cell} WHERE {d.has('text', g.SUSPECT)}) q
  WHERE rn = 1"""


@relation("book_pages")
def csi_footers(d, pages):
    """Section number and page number of each page's first short line that ends in both."""
    cell = d.explode_from(f"(SELECT stream, page, {d.split('text', chr(92) + 'n')} AS parts FROM {pages}) s", "parts", "text", "place")
    return f"""
  SELECT stream, page, {d.swap(d.cut('text', g.CSI_FOOTER, 1), SPACE + '+', '')} AS code, CAST({d.cut('text', g.CSI_FOOTER, 2)} AS BIGINT) AS footer_page
  FROM (SELECT stream, page, trim(text) AS text, row_number() OVER (PARTITION BY stream, page ORDER BY place) AS rn
    FROM {cell} WHERE length(trim(text)) BETWEEN 1 AND {g.CSI_FOOTER_CHARS} AND {d.has('trim(text)', g.CSI_FOOTER)}) q
  WHERE rn = 1"""


@relation("region_floor", "csi_footers", "book_pages")
def region_tail(d, floor, footers, pages):
    """Accepted regions that go on to a page with END OF SECTION: pages after the region whose footers count on from its last page's, at most fifteen."""
    return f"""
  SELECT stream, region, last_page, code, min(eos_page) AS new_last_page
  FROM (
    SELECT f.stream, f.region, f.last_page, c.code, p.page AS eos_page,
      count(n.page) AS met
    FROM {floor} f
    JOIN {footers} c ON c.stream = f.stream AND c.page = f.last_page
    JOIN {pages} p ON p.stream = f.stream AND p.page > f.last_page AND p.page <= f.last_page + {g.TAIL_PAGES} AND {d.has('p.text', g.END_OF_SECTION)}
    LEFT JOIN {footers} n ON n.stream = f.stream AND n.code = c.code AND n.page > f.last_page AND n.page <= p.page AND n.page - n.footer_page = c.page - c.footer_page
    WHERE f.accepted
    GROUP BY f.stream, f.region, f.last_page, c.code, p.page) q
  WHERE met >= eos_page - last_page - 1
  GROUP BY stream, region, last_page, code"""


@relation("page_class", "region_floor")
def file_verdict(d, classes, floor):
    """What a file as a whole is."""
    return f"""
  SELECT c.stream, n_pages, image_only, coalesce(n_accepted, 0) AS n_accepted,
    CASE WHEN coalesce(n_accepted, 0) > 0 THEN 'sets_region_found' WHEN image_only = n_pages THEN 'image_only_no_text' ELSE 'no_sets' END AS verdict
  FROM (SELECT stream, count(*) AS n_pages, count(CASE WHEN chars < {g.IMAGE_ONLY_CHARS} THEN 1 END) AS image_only FROM {classes} GROUP BY stream) c
  LEFT JOIN (SELECT stream, count(CASE WHEN accepted THEN 1 END) AS n_accepted FROM {floor} GROUP BY stream) f ON f.stream = c.stream"""


@relation("file_verdict")
def project_alarm(d, verdicts):
    """Projects (ten files each) of which no file has an accepted region."""
    return f"""
  SELECT {d.div('stream', '10')} AS project, count(*) AS files, max(n_accepted) = 0 AS alarm FROM {verdicts} GROUP BY {d.div('stream', '10')}"""


@relation("documents")
def page_hash(d, documents):
    """The first 16 hex digits of the SHA-1 of a page's text with white space collapsed; made before pages are numbered, so that no text is shuffled."""
    hashed = f"(SELECT doc_id, source, substring({d.sha1(f'trim({d.swap("text", SPACE + "+", " ")})')}, 1, 16) AS hash FROM {documents}) h"
    return f"SELECT doc_id, file, page, hash FROM ({numbered(d, hashed, 'hash')}) p WHERE hash IS NOT NULL"


@relation("page_hash")
def duplicate_regions(d, hashes):
    """Runs of pages of one file that another file holds in the same order: maximal diagonals of equal hashes, every page of a hash that recurs with every page of it in the other file."""
    return f"""
  SELECT file, twin, min(page) AS first_page, max(page) AS last_page, min(other) AS twin_first, count(*) AS pages
  FROM (
    SELECT *, page - row_number() OVER (PARTITION BY file, twin, other - page ORDER BY page) AS run
    FROM (SELECT a.file, b.file AS twin, a.page, b.page AS other FROM {hashes} a JOIN {hashes} b ON a.hash = b.hash AND a.file < b.file) m) q
  GROUP BY file, twin, other - page, run"""


@relation("book_pages", "region_floor")
def title_reconcile(d, pages, floor):
    """The first title line of each page: answered by a region that begins within six pages, else referred (in the seven lines below, and where these are short at the head of the next page), downstream or unreconciled."""
    ahead = f"lead(substring(text, 1, {g.REFER_AHEAD})) OVER (PARTITION BY stream ORDER BY page)"
    cell = d.explode_from(f"(SELECT stream, page, {ahead} AS ahead, {d.split('text', chr(92) + 'n')} AS parts FROM {pages}) s", "parts", "text", "place")
    below = d.join(d.part("parts", "place + 2", str(g.REFER_LINES)), " ")
    return f"""
  SELECT t.stream, t.page, t.title,
    CASE WHEN {d.any(f'f.last_page >= t.page AND f.first_page - t.page <= {g.TITLE_PAGES}')} THEN 'answered'
      WHEN {d.any(d.has('t.below', g.REFER))} THEN 'stub'
      WHEN {d.any('f.first_page > t.page')} THEN 'downstream' ELSE 'unreconciled' END AS verdict
  FROM (
    SELECT stream, page, title, rn, CASE WHEN length(below) < {g.REFER_SHORT} THEN below || ' ' || coalesce(ahead, '') ELSE below END AS below
    FROM (SELECT stream, page, ahead, {below} AS below, trim(text) AS title, row_number() OVER (PARTITION BY stream, page ORDER BY place) AS rn FROM {cell} WHERE {d.has('text', g.SETS_TITLE)}) q) t
  LEFT JOIN {floor} f ON f.stream = t.stream AND f.accepted
  WHERE rn = 1
  GROUP BY t.stream, t.page, t.title"""


@relation("book_pages", "region_floor", query=False)
def shipped_regions(d, pages, floor):
    """The pages of accepted regions with their hashes, by file (a stream's book); every fourth book is shipped once more, with a page less or (every eighth) with thirty pages before it, and of others four pages."""
    hashes = f"""
      SELECT p.stream, f.region, p.page - f.first_page AS place, f.first_page, substring({d.sha1(f'trim({d.swap("p.text", SPACE + "+", " ")})')}, 1, 16) AS hash
      FROM {pages} p JOIN {floor} f ON f.stream = p.stream AND f.accepted AND p.page BETWEEN f.first_page AND f.last_page"""
    size = f"SELECT stream, count(*) AS n FROM {pages} GROUP BY stream"
    return f"""
  SELECT {d.string('h.stream')} AS file, n.n AS pages, h.region, h.first_page, h.place, h.hash FROM ({hashes}) h JOIN ({size}) n ON n.stream = h.stream
  UNION ALL
  SELECT 'again-' || {d.string('h.stream')}, n.n + CASE WHEN h.stream % 8 = 1 THEN 30 ELSE -1 END, h.region, h.first_page + CASE WHEN h.stream % 8 = 1 THEN 30 ELSE 0 END, h.place, h.hash FROM ({hashes}) h JOIN ({size}) n ON n.stream = h.stream WHERE h.stream % 4 = 1
  UNION ALL
  SELECT 'head-' || {d.string('h.stream')}, CAST(4 AS BIGINT), h.region, CAST(1 AS BIGINT), h.place - 1, h.hash FROM ({hashes}) h WHERE h.stream % 4 = 3 AND h.place BETWEEN 1 AND 4"""


@relation("shipped_regions", query=False)
def region_sequences(d, regions):
    """Regions with the sequence of their pages' hashes; regions with equal sequences are one content."""
    return f"""
  SELECT *, {d.sha1(d.join('hashes', ' '))} AS content
  FROM (SELECT file, pages, region, min(first_page) AS first_page, count(*) AS n, {d.gather('hash', 'place')} AS hashes FROM {regions} GROUP BY file, pages, region) q"""


@relation("region_sequences")
def region_twins(d, keyed):
    """Regions whose sequence of pages another file's region holds: a longer one as a part, or an equal one in a file of fewer pages (of two equal ones the larger file's is the copy). The twin named is the holder in the smallest file, then the first by name.

    A content meets others by a hash of its first pages (three, or all it has), once a content and not once a file; holders are kept by the two least files, so that nothing gathers a content's files."""
    cell = d.explode_from(f"(SELECT content, n, hashes, {d.range('0', 'n - 1')} AS parts FROM contents) c", "parts", "place", "k")
    size = d.explode_from(f"(SELECT content, n, hashes, place, {d.list('1', '2', '3')} AS sizes FROM (SELECT content, n, hashes, place FROM {cell}) p) s", "sizes", "size", "k2")
    least = f"min({d.record(pages='pages', file='file', first_page='first_page')})"
    kind = "AS" if d.name == "spark" else "AS MATERIALIZED"
    return f"""
  WITH contents {kind} (SELECT content, min(n) AS n, min(hashes) AS hashes FROM {keyed} GROUP BY content),
  first_holder {kind} (SELECT content, {least} AS one FROM {keyed} GROUP BY content),
  second_holder {kind} (SELECT k.content, {least} AS two FROM {keyed} k JOIN first_holder f ON f.content = k.content AND k.file <> f.one.file GROUP BY k.content),
  parts {kind} (SELECT content, n, hashes, place, size, {d.sha1(d.join(d.part('hashes', 'place + 1', 'size'), ' '))} AS start FROM (SELECT content, n, hashes, place, size FROM {size}) s WHERE place + size <= n),
  inside {kind} (
    SELECT a.content, p.content AS holder, min(p.place) AS place FROM contents a JOIN parts p ON p.size = least(a.n, 3) AND p.start = {d.sha1(d.join(d.part('a.hashes', '1', 'least(a.n, 3)'), ' '))} AND p.n > a.n AND p.place + a.n <= p.n
    WHERE {d.join(d.part('p.hashes', 'p.place + 1', 'a.n'), ' ')} = {d.join('a.hashes', ' ')} GROUP BY a.content, p.content),
  twins {kind} (
    SELECT k.file, k.region, k.n, h.one AS twin, CAST(0 AS BIGINT) AS place FROM {keyed} k JOIN first_holder h ON h.content = k.content AND h.one.pages < k.pages AND h.one.file <> k.file
    UNION ALL
    SELECT k.file, k.region, k.n, CASE WHEN h.one.file = k.file THEN s.two ELSE h.one END, CAST(i.place AS BIGINT) FROM {keyed} k JOIN inside i ON i.content = k.content JOIN first_holder h ON h.content = i.holder LEFT JOIN second_holder s ON s.content = i.holder
    WHERE h.one.file <> k.file OR s.two IS NOT NULL)
  SELECT file, region, CAST(n AS BIGINT) AS pages, best.twin.file AS twin, best.twin.first_page + best.place AS twin_first, best.twin.first_page + best.place + n - 1 AS twin_last
  FROM (SELECT file, region, n, min({d.record(twin='twin', place='place')}) AS best FROM twins GROUP BY file, region, n) b"""
