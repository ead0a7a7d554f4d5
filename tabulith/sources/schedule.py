"""Schedules rendered from orders, line items and parts: a book of sets as positioned lines.

An order is a hardware set, its line items are component rows. A stream is a book of 75 customers, so
that streams stay of one size however large the tables are. Every page has a running header, a column
header, 40 content lines and a footer. Keys decide on the irregular lines: descriptions, door lists, heads,
notes, outline shells, dropped tails, hyphenated finishes, struck lines, set numbers that recur, blocks of many
notes, and books that end with a bare header.
"""

from __future__ import annotations

from tabulith.plans.graph import relation

CUSTOMERS, LINES = 75, 40
COLUMNS = {"qty": 72, "unit": 90, "description": 120, "catalog": 270, "finish": 440, "mfr": 500}

#: The words of the column header, which every page has as its second line, and their edges.
HEADER = {"QTY": COLUMNS["qty"], "DESCRIPTION": COLUMNS["description"], "CATALOG": COLUMNS["catalog"], "NUMBER": COLUMNS["catalog"] + 40, "FINISH": COLUMNS["finish"], "MFR": COLUMNS["mfr"]}

#: Columns of schedule_rows that words are made of.
CELLS = ["l_partkey", "qty", "unit", "catalog", "finish", "mfr", "description", "dropped"]

LEGEND = [
    "Section 087100 general notes for the work of this book",
    "Manufacturers:",
    "IVE Ives",
    "SCH Schlage",
    "LCN Closers by LCN",
    "VON Von Duprin",
    "ZER Zero International",
    "Finish List:",
    "626 Satin Chromium Plated",
    "630 Satin Stainless Steel",
    "32D Satin Stainless",
    "US26D Satin Chrome",
    "Options",
    "RX Request to exit",
    "EL Electric latch",
    "Quantities are given for each opening",
    "Hardware Sets:",
    "AB After the schedule begins",
]


@relation("orders", "lineitem", "part", query=False)
def schedule_rows(d, orders, lineitem, part):
    finish = d.list(*map(d.text, ["626", "630", "32D", "US26D"]))
    maker = d.list(*map(d.text, ["IVE", "SCH", "LCN", "VON", "ZER"]))
    joined = f"{orders} JOIN {lineitem} ON o_orderkey = l_orderkey JOIN {part} ON l_partkey = p_partkey"
    if d.name == "spark":  # the order's key last, by which rows are then numbered
        joined = f"{lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {orders} ON o_orderkey = l_orderkey"
    return f"""
  SELECT {d.div('o_custkey', str(CUSTOMERS))} AS stream, o_orderkey,
    row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate) AS rn,
    l_partkey, l_suppkey,
    {d.string(d.integer('l_quantity'))} AS qty,
    CASE l_returnflag WHEN 'N' THEN ' EA' WHEN 'R' THEN ' SET' ELSE '' END AS unit,
    upper(p_name) AS description,
    {d.string('p_size')} || 'B' || {d.string('l_partkey % 97')} AS catalog,
    CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 17 = 0 THEN '630-' ELSE {d.at(finish, 'l_suppkey % 4 + 1')} END AS finish,
    CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN 'Q' || {d.string('l_partkey')} ELSE {d.at(maker, 'l_suppkey % 5 + 1')} END AS mfr,
    l_partkey % 13 = 0 OR ({d.div('o_custkey', str(CUSTOMERS))} % 10 = 9 AND l_partkey % 4 <> 0) AS dropped, l_partkey % 23 = 0 AS twice
  FROM {joined}"""


@relation("orders", "lineitem", "schedule_rows", query=False)
def schedule_lines(d, orders, lineitem, rows):
    key = d.string("o_orderkey")
    stream = d.div("o_custkey", str(CUSTOMERS))
    no_cells = cells = ""
    if d.name == "spark":  # a row's first line brings its cells, so that words need no join
        no_cells, cells = ", NULL", f", CASE sub WHEN 0 THEN {d.record(**{k: k for k in CELLS})} END"
    extra = lambda section, text, test: f"SELECT {stream} AS stream, o_orderkey, {section} AS section, 0 AS rn, 0 AS sub, {text} AS text, CAST(NULL AS BIGINT) AS partkey{no_cells} FROM {orders} WHERE {test}"
    listed = d.list(*map(d.text, LEGEND))
    legend = d.explode_from(f"(SELECT *, {listed} AS parts FROM (SELECT DISTINCT {stream} AS stream FROM {orders}) s WHERE stream % 3 = 0) s", "parts", "text", "place")
    many = d.explode_from(f"(SELECT {stream} AS stream, o_orderkey, {d.range('1', '45')} AS parts FROM {orders} WHERE o_orderkey % 149 = 9) m", "parts", "part", "place")
    tail = "coalesce(' ' || finish, '') || coalesce(' ' || mfr, '')"
    row = f"qty || unit || ' ' || description || ' ' || catalog || CASE WHEN dropped THEN '' ELSE CASE WHEN twice THEN coalesce(' ' || finish, '') ELSE '' END || {tail} END"
    more, has_more = f"CASE WHEN dropped THEN ltrim({tail}) ELSE '316' END", "CASE WHEN dropped THEN finish IS NOT NULL AND mfr IS NOT NULL ELSE finish = '630-' AND mfr IS NULL END"
    components = f"""SELECT stream, o_orderkey, 10, CAST(rn AS INT), 0, {row}, l_partkey FROM {rows}
  UNION ALL
  SELECT stream, o_orderkey, 10, CAST(rn AS INT), 1, {more}, l_partkey FROM {rows}
  WHERE {has_more}"""
    if d.name == "spark":  # both lines of a row at once, so that rows are joined and numbered once
        components = f"SELECT stream, o_orderkey, 10, CAST(rn AS INT), sub, CASE sub WHEN 0 THEN {row} ELSE {more} END, l_partkey{cells} FROM {rows} LATERAL VIEW explode(CASE WHEN {has_more} THEN array(0, 1) ELSE array(0) END) t_sub AS sub"
    return f"""
  SELECT {stream} AS stream, o_orderkey, 0 AS section, 0 AS rn, 0 AS sub,
    'Hardware Group No. ' || CASE WHEN o_orderkey % 43 = 7 THEN '7' ELSE {key} END || CASE WHEN n IS NULL THEN ' - Not Used' WHEN o_orderkey % 41 = 0 THEN ': (Door' ELSE '' END AS text, CAST(NULL AS BIGINT) AS partkey{no_cells and no_cells + ' AS cells'}
  FROM {orders} LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM {lineitem} GROUP BY l_orderkey) c ON o_orderkey = l_orderkey
  UNION ALL {extra(1, "'U' || " + key + " || ')'", 'o_orderkey % 41 = 0')}
  UNION ALL {extra(2, "'Description: Opening type ' || " + d.string('o_orderkey % 9'), 'o_orderkey % 3 = 0')}
  UNION ALL {extra(3, "'Description: Repeated ' || " + d.string('o_orderkey % 9'), 'o_orderkey % 27 = 0')}
  UNION ALL {extra(4, "'For use on Door #(s):'", 'o_orderkey % 7 = 1')}
  UNION ALL {extra(5, d.string('100 + o_orderkey % 50') + " || 'A ' || " + d.string('200 + o_orderkey % 50'), 'o_orderkey % 7 = 1')}
  UNION ALL {extra(6, "'Each to have:'", 'o_orderkey % 7 = 1')}
  UNION ALL {extra(7, d.string('o_orderkey % 50'), 'o_orderkey % 7 = 2')}
  UNION ALL {extra(8, "'PROVIDE EACH SINGLE DOOR WITH THE FOLLOWING:'", 'o_orderkey % 7 = 2')}
  UNION ALL {extra(9, "'Properties: Rated ' || " + d.string('o_orderkey % 90') + " || ' MIN'", 'o_orderkey % 10 = 3')}
  UNION ALL
  {components}
  UNION ALL {extra(11, "'1 GASKETING BY ALUMINUM DOOR'", 'o_orderkey % 12 = 5')}
  UNION ALL SELECT {stream}, o_orderkey, 11, 1, 0, 'RM ADJ', CAST(NULL AS BIGINT){no_cells} FROM {orders} WHERE o_orderkey % 12 = 5
  UNION ALL {extra(12, "'NOTE: verify with owner'", 'o_orderkey % 6 = 4')}
  UNION ALL {extra(13, "'coordinate all work with the electrical trade'", 'o_orderkey % 6 = 4')}
  UNION ALL {extra(14, "'OPERATION: door normally closed and locked'", 'o_orderkey % 5 = 0')}
  UNION ALL {extra(15, "'2 free egress at all times'", 'o_orderkey % 5 = 0')}
  UNION ALL SELECT stream, o_orderkey, 14, CAST(part AS INT), 1, 'verify opening ' || {d.string('part')} || ' in the field with care', CAST(NULL AS BIGINT){no_cells} FROM {many}
  UNION ALL SELECT {stream}, 900000000000, 17, 0, 0, 'Hardware Group No. 9999', CAST(NULL AS BIGINT){no_cells} FROM {orders} WHERE {stream} % 4 = 2 GROUP BY {stream}
  UNION ALL SELECT stream, -1, place, 0, 0, text, CAST(NULL AS BIGINT){no_cells} FROM {legend}
  UNION ALL {extra(16, "'PART ' || " + d.string('o_orderkey % 9 + 1') + " || ' -'", 'o_orderkey % 31 = 3')}"""


@relation("schedule_lines", query=False)
def placed_lines(d, lines):
    return f"""
  SELECT *, {d.div('pos - 1', str(LINES))} + 1 AS page, (pos - 1) % {LINES} + 3 AS line
  FROM (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY o_orderkey, section, rn, sub) AS pos FROM {lines}) q"""


@relation("placed_lines", query=False)
def lines(d, placed):
    """The line stream: stream, page, line, anchor, text, bbox as x0, top, x1, bottom, and struck (share, or null)."""
    struck = "CASE WHEN o_orderkey % 97 = 0 AND section = 10 THEN 1.0D WHEN o_orderkey % 89 = 0 AND section = 10 THEN 0.5D END"
    struck = struck if d.name == "spark" else struck.replace("1.0D", "CAST(1.0 AS DOUBLE)").replace("0.5D", "CAST(0.5 AS DOUBLE)")
    header, columns, footer = f"'DOOR HARDWARE ' || {d.string('stream % 3 + 1')} || ' SUBMITTAL'", f"'{' '.join(HEADER)}'", f"'Door Hardware 087100 - ' || {d.string('page')}"
    pages = f"(SELECT stream, page FROM {placed} GROUP BY stream, page) p"
    every = f"""
    SELECT stream, page, line, text, {struck} AS struck FROM {placed}
    UNION ALL SELECT stream, page, 1, {header}, NULL FROM {pages}
    UNION ALL SELECT stream, page, 2, {columns}, NULL FROM {pages}
    UNION ALL SELECT stream, page, 44, {footer}, NULL FROM {pages}"""
    if d.name == "spark":  # a page's first line brings its running lines, so that lines are placed once
        every = f"""
    SELECT stream, page, at AS line, CASE at WHEN 1 THEN {header} WHEN 2 THEN {columns} WHEN 44 THEN {footer} ELSE text END AS text, CASE WHEN at = line THEN {struck} END AS struck
    FROM {placed} LATERAL VIEW explode(CASE WHEN line = 3 THEN array(line, 1, 2, 44) ELSE array(line) END) t_at AS at"""
    return f"""
  SELECT CAST(stream AS BIGINT) AS stream, CAST(page AS BIGINT) AS page, CAST(line AS BIGINT) AS line, {d.anchor('page', 'line')} AS anchor, text,
    CAST(72 AS DOUBLE) AS x0, CAST(20 + 16 * line AS DOUBLE) AS top, CAST(72 + 5 * length(text) AS DOUBLE) AS x1, CAST(32 + 16 * line AS DOUBLE) AS bottom, struck
  FROM ({every}) q"""


@relation("placed_lines", "schedule_rows", query=False, spark=("lines",))
def words(d, placed, rows, lines):
    """Words of component rows and of column headers with their edges; word tells the words of a page apart. A few rows are shifted, every fifth stream is ragged, and every fifth page's header stands a point to the right."""
    kinds = [
        (COLUMNS["qty"], "qty"),
        (COLUMNS["unit"], "nullif(ltrim(unit), '')"),
        (COLUMNS["catalog"], "catalog"),
        (COLUMNS["finish"], "CASE WHEN NOT dropped THEN finish END"),
        (COLUMNS["mfr"], "CASE WHEN NOT dropped THEN mfr END"),
        (COLUMNS["description"], d.at(d.split("description", " "), "1")),
    ]
    rows_placed = f"""p.stream, p.page, p.line, r.l_partkey, r.qty, r.unit, r.catalog, r.finish, r.mfr, r.description, r.dropped, {d.list(*map(str, range(len(kinds))))} AS parts
      FROM {rows} r JOIN {placed} p ON p.stream = r.stream AND p.o_orderkey = r.o_orderkey AND p.rn = r.rn AND p.section = 10 AND p.sub = 0"""
    if d.name == "spark" and (placed, rows) == ("placed_lines", "schedule_rows"):  # not given, so the rows' cells are with the lines
        rows_placed = f"stream, page, line, cells.*, {d.list(*map(str, range(len(kinds))))} AS parts FROM {placed} WHERE section = 10 AND sub = 0"
    choose = lambda k: "CASE kind " + " ".join(f"WHEN {i} THEN {x[k]}" for i, x in enumerate(kinds)) + " END"
    cell = d.explode_from(
        f"(SELECT {rows_placed}) c",
        "parts", "kind", "place",
    )
    edges = "CASE text " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in HEADER.items()) + " END"
    pages = f"{placed} GROUP BY stream, page"
    if d.name == "spark" and placed == "placed_lines":  # not given, so every page has its column header among the lines
        pages = f"{lines} WHERE line = 2"
    header = d.explode_from(f"(SELECT stream, page, {d.list(*map(d.text, HEADER))} AS parts FROM {pages}) h", "parts", "text", "place")
    return f"""
  SELECT stream, page, line, CAST(word AS BIGINT) AS word, text, x0, x0 + CAST(5 * length(text) AS DOUBLE) AS x1, top, bottom FROM (
  SELECT CAST(stream AS BIGINT) AS stream, CAST(page AS BIGINT) AS page, CAST(line AS BIGINT) AS line, line * 16 + kind AS word, text,
    CAST(edge AS DOUBLE) + CASE WHEN stream % 5 = 0 THEN CAST(l_partkey % 23 AS DOUBLE) WHEN l_partkey % 29 = 0 AND edge = {COLUMNS['finish']} THEN CAST(-40 AS DOUBLE) WHEN l_partkey % 20 = 0 THEN CAST(0.3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS x0,
    CAST(22 + 16 * line AS DOUBLE) AS top, CAST(30 + 16 * line AS DOUBLE) AS bottom
  FROM (SELECT stream, page, line, l_partkey, kind, {choose(0)} AS edge, {choose(1)} AS text FROM {cell}) q
  WHERE text IS NOT NULL
  UNION ALL
  SELECT CAST(stream AS BIGINT), CAST(page AS BIGINT), CAST(2 AS BIGINT), 32 + place, text, CAST({edges} AS DOUBLE) + CASE WHEN page % 5 = 0 THEN 1 ELSE 0 END, CAST(54 AS DOUBLE), CAST(62 AS DOUBLE) FROM {header}) w"""


#: A dotted book's columns: left edges of a set header's first component.
DOTTED = {"description": 100, "mfr": 220, "qty": 300, "finish": 340}


@relation("orders", query=False)
def dotted_headers(d, orders):
    """Set headers of books whose first component stands on the header line itself (every sixth order): the words, with their places and edges."""
    name = d.string("o_orderkey % 9 + 1") + " || '.' || " + d.string("o_orderkey % 10")
    finish = "CASE o_orderkey % 3 WHEN 0 THEN '613 (OIL RUBBED BRONZE) PER OWNER' WHEN 1 THEN '630 (STAINLESS)' ELSE '626' END"
    text = f"{name} || ' MORTISE HINGE ' || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'IVES - ' END || '5BB1 4.5 ' || {d.string('o_orderkey % 8 + 1')} || ' ' || {finish}"
    cell = d.explode_from(f"(SELECT {d.div('o_custkey', str(CUSTOMERS))} AS stream, o_orderkey, {name} AS set_id, {d.split(text, ' ')} AS parts FROM {orders} WHERE o_orderkey % 6 = 0) c", "parts", "text", "place")
    blob = "CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 4 END"
    return f"""
  SELECT CAST(stream AS BIGINT) AS stream, o_orderkey AS header, set_id, 'bare_dotted' AS family, CAST(place AS BIGINT) AS idx, text,
    CAST(CASE WHEN place = 0 THEN 72 WHEN place <= 2 THEN {DOTTED['description']} + 40 * (place - 1) WHEN place < 3 + {blob} THEN {DOTTED['mfr']} + 18 * (place - 3) WHEN place = 3 + {blob} THEN {DOTTED['qty']} - place % 2 ELSE {DOTTED['finish']} + 24 * (place - 4 - {blob}) END AS DOUBLE) AS x0
  FROM {cell}"""


@relation("dotted_headers", query=False)
def dotted_zones(d, headers):
    """The columns of dotted books, as their column header words measure them."""
    zone = lambda role, hi: f"SELECT stream, '{role}' AS role, CAST({DOTTED[role]} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi, 'header' AS origin FROM {headers} GROUP BY stream"
    return f"{zone('mfr', DOTTED['qty'])} UNION ALL {zone('qty', DOTTED['finish'])} UNION ALL {zone('finish', 'NULL')}"
