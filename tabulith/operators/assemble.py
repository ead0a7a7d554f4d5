"""Assembling sets: prompts and their cache, answers, and what reconciles answers with the lines they came from."""

from __future__ import annotations

from tabulith.functions.provider import EFFORT, MAX_TOKENS, MODEL, SCHEMA, SYSTEM
from tabulith.operators.rules import hint, repaired
from tabulith.plans.graph import relation

UNITS = ["EA", "EA.", "EA-R", "Ea", "Ea.", "SET", "SETS", "PR", "PRS", "PAIR", "PAIRS", "EACH"]


def tokens(d, text: str) -> str:
    """Words of a text, an empty one having none."""
    return d.where(d.split(f"trim({text})", " +"), "t", "t <> ''")


def norm_tokens(d, words: str) -> str:
    return d.where(d.map(words, "t", f"lower({d.swap('t', '[^0-9A-Za-z_]+', '')})"), "t", "t <> ''")


@relation("repaired_rows", "split_hint", spark=("rule_rows", "stitch_tails"))
def baseline_components(d, rows, hints, placed, stitches):
    """A component a row without any model: description and catalog number cut at the first word with a digit."""
    toks = tokens(d, "rest")
    cut = f"(split_hint IS NULL OR split_hint <= 0 OR split_hint > {d.size('toks')})"
    both = f"SELECT r.*, h.split_hint, {toks.replace('rest', 'r.rest')} AS toks FROM {rows} r JOIN {hints} h ON h.stream = r.stream AND h.seq = r.seq AND h.anchor = r.anchor"
    if d.name == "spark" and (rows, hints) == ("repaired_rows", "split_hint"):  # not given, so a row brings its words
        return cut_rows(d, repaired(d, placed, stitches, ", r.rest_toks"))
    return f"""
  SELECT stream, seq, anchor, qty, unit, nullif(CASE WHEN {cut} THEN rest ELSE {d.join(d.part('toks', '1', 'coalesce(split_hint, 0)'), ' ')} END, '') AS description,
    nullif(CASE WHEN {cut} THEN '' ELSE {d.join(d.part('toks', 'coalesce(split_hint, 0) + 1', d.size('toks')), ' ')} END, '') AS catalog_number, mfr, finish, tail_anchor, hyphen_anchor
  FROM ({both}) q"""


def cut_rows(d, rows: str) -> str:
    """baseline_components of repaired rows with their rest_toks, for Spark: where a rest has its words at single spaces, the words before the first one with a digit are found in it by one pattern."""
    plain = "NOT contains(rest, '  ') AND NOT startswith(rest, ' ') AND NOT endswith(rest, ' ') AND length(rest) - length(replace(rest, ' ', '')) + 1 = size(rest_toks)"
    toks, place = tokens(d, "rest"), hint(d)
    cut = f"({place} IS NULL OR {place} <= 0 OR {place} > size({toks}))"
    return f"""
  SELECT stream, seq, anchor, qty, unit, nullif(CASE WHEN plain AND lead = '' THEN rest WHEN plain THEN lead WHEN {cut} THEN rest ELSE {d.join(d.part(toks, '1', place), ' ')} END, '') AS description,
    nullif(CASE WHEN plain AND lead = '' THEN '' WHEN plain THEN substring(rest, length(lead) + 2) WHEN {cut} THEN '' ELSE {d.join(d.part(toks, f'{place} + 1', f'size({toks})'), ' ')} END, '') AS catalog_number, mfr, finish, tail_anchor, hyphen_anchor
  FROM (SELECT *, {plain} AS plain, {d.cut('rest', '(?s)^([^0-9]*) [^ ]*[0-9]', 1)} AS lead FROM ({rows}) r) q"""


@relation("rule_buckets", "rule_rows")
def prompt_render(d, buckets, rows):
    """The lines of a block that a model is asked about, in reading order, one text a block."""
    body = f"b.anchor || ' | ' || CASE WHEN b.bucket = 'rows' THEN 'component row (mfr=' || coalesce(r.mfr, 'None') || ' finish=' || coalesce(r.finish, 'None') || ') | rest: ' || {d.join('r.rest_toks', ' ')} ELSE b.kind || ' | ' || b.text END"
    lines = d.gather("body", "pos")
    listing = f"array_join({lines}, '\\n')" if d.name == "spark" else f"array_to_string({lines}, chr(10))"
    return f"""
  SELECT stream, seq, {listing} AS prompt, count(*) AS n_lines FROM (
    SELECT b.stream, b.seq, b.pos, {body} AS body FROM {buckets} b LEFT JOIN {rows} r ON r.stream = b.stream AND r.seq = b.seq AND r.anchor = b.anchor
    WHERE b.bucket IN ('rows', 'note_lines', 'unresolved') AND b.kind <> 'blank') q
  GROUP BY stream, seq"""


@relation("prompt_render")
def prompt_fingerprint(d, prompts):
    """The first 32 hex digits of the SHA-256 of a request's JSON, keys in order; functions.provider.fingerprint gives the same."""
    request = d.json(d.record(effort=d.text(EFFORT), max_tokens=str(MAX_TOKENS), model=d.text(MODEL), schema=d.text(SCHEMA), system=d.text(SYSTEM), user="prompt"))
    return f"SELECT stream, seq, n_lines, substring({d.sha256(request)}, 1, 32) AS fingerprint FROM {prompts}"


@relation("prompt_fingerprint", query=False)
def answer_cache(d, prints):
    """Answers of an earlier run: every third block's."""
    return f"SELECT fingerprint, 'end_turn' AS stop_reason, n_lines * 12 AS output_tokens FROM {prints} WHERE seq % 3 = 0"


@relation("prompt_fingerprint", "answer_cache")
def llm_cache_join(d, prints, cache):
    """Requests with their cached answers; only misses would reach a provider."""
    return f"""
  SELECT p.stream, p.seq, p.fingerprint, c.fingerprint IS NOT NULL AS hit, c.output_tokens FROM {prints} p
  LEFT JOIN (SELECT fingerprint, min(output_tokens) AS output_tokens FROM {cache} GROUP BY fingerprint) c ON c.fingerprint = p.fingerprint"""


@relation("baseline_components", query=False)
def provider_answers(d, components):
    return answered(d, components)


def answered(d, components: str, more: str = "") -> str:
    """Answers as a provider gives them, with the faults that providers have, by block number: words lost, recased or joined, anchors made up or claimed twice, headings taken for components."""
    source = "trim(coalesce(description, '') || ' ' || coalesce(catalog_number, ''))"
    return f"""
  SELECT stream, seq, anchor, rn, source,
    CASE WHEN seq % 11 = 0 THEN {d.swap('source', ' [^ ]+$', '')} WHEN seq % 7 = 0 THEN lower(source) || ',' WHEN seq % 5 = 0 THEN replace(source, ' ', '-') ELSE source END AS answer,
    CASE WHEN seq % 17 = 0 AND rn = 1 THEN 'p0-L00' WHEN seq % 13 = 0 THEN coalesce(before, anchor) ELSE anchor END AS claimed,
    seq % 29 = 0 AND rn = 1 AS pseudo, CASE WHEN seq % 29 = 0 AND rn = 1 THEN 'heading' END AS pseudo_reason{more}
  FROM (SELECT stream, seq, anchor{more}, {source} AS source, row_number() OVER (PARTITION BY stream, seq ORDER BY anchor) AS rn, lag(anchor) OVER (PARTITION BY stream, seq ORDER BY anchor) AS before FROM {components}) q"""


def level(d, answer: str, source: str) -> str:
    """How well the words of an answer, an array, hold those of its lines."""
    bag = lambda x: d.join(d.sorted(x), " ")
    a, s = norm_tokens(d, answer), norm_tokens(d, source)
    return f"CASE WHEN {bag(answer)} = {bag(source)} THEN 'strict' WHEN {bag(a)} = {bag(s)} OR {d.join(a, '')} = {d.join(s, '')} THEN 'normalized' ELSE 'failed' END"


def without(d, words: str, value: str) -> str:
    """An array of words without the last one that equals value, if one does."""
    back = f"coalesce({d.back_place(words, value)}, 0)"
    n = d.size(words)
    return f"CASE WHEN {back} > 0 THEN {d.concat(d.part(words, '1', f'{n} - {back}'), d.part(words, f'{n} - {back} + 2', f'{back} - 1'))} ELSE {words} END"


def count_of(d, words: str, value: str) -> str:
    return d.size(d.where(words, "t", f"t = {value}"))


@relation("provider_answers", "catalog_detach")
def recounted(d, answers, detached):
    """Conservation of the components whose catalog number gave a word up to its column, counted again without that word: out of the answer where it is in it, and out of its lines where they then have it more often."""
    return f"""
  SELECT stream, seq, anchor, role, {level(d, 'ta', 'ts')} AS level, {level(d, 'out', 'src')} AS new_level
  FROM (
    SELECT *, CASE WHEN {count_of(d, 'ts', 'value')} > {count_of(d, 'out', 'value')} THEN {without(d, 'ts', 'value')} ELSE ts END AS src
    FROM (
      SELECT a.stream, a.seq, a.anchor, m.role, m.value, a.ta, a.ts, {without(d, 'a.ta', 'm.value')} AS out
      FROM (SELECT stream, seq, anchor, {tokens(d, 'answer')} AS ta, {tokens(d, 'source')} AS ts FROM {answers}) a JOIN {detached} m ON m.stream = a.stream AND m.seq = a.seq AND m.anchor = a.anchor) q) q"""


@relation("provider_answers", "conservation", "recounted")
def assembled_components(d, answers, levels, again):
    """What is delivered: the answer, or the baseline split of its line where words were lost (the level is then what counting again says, and the failure stays marked unless that cleared it). Pseudo components are demoted, not delivered."""
    return f"""
  SELECT a.stream, a.seq, a.anchor, CASE WHEN l.level = 'failed' THEN a.source ELSE a.answer END AS text, coalesce(r.new_level, l.level) AS level,
    l.level = 'failed' AS fell_back_to_split_hint, l.level = 'failed' AND coalesce(r.new_level, 'failed') = 'failed' AS conservation_failed
  FROM {answers} a JOIN {levels} l ON l.stream = a.stream AND l.seq = a.seq AND l.anchor = a.anchor
  LEFT JOIN (SELECT stream, seq, anchor, min(new_level) AS new_level FROM {again} GROUP BY stream, seq, anchor) r ON r.stream = a.stream AND r.seq = a.seq AND r.anchor = a.anchor
  WHERE NOT a.pseudo"""


@relation("provider_answers", "conservation")
def demoted(d, answers, levels):
    """Components that the provider took for headings or instructions, with the reason and what they would have been."""
    return f"""
  SELECT a.stream, a.seq, a.anchor, a.source AS text, a.pseudo_reason AS reason, {d.json(d.record(answer='a.answer', level='l.level'))} AS was
  FROM {answers} a JOIN {levels} l ON l.stream = a.stream AND l.seq = a.seq AND l.anchor = a.anchor WHERE a.pseudo"""


@relation("provider_answers", "rotated_lines", "border_lines", "lines", query=False)
def swept_answers(d, answers, rotated, border, lines):
    """Answers that swept a word of the page's border up: the first border line of the page is claimed too, and its words end the text."""
    return f"""
  SELECT a.stream, a.seq, a.anchor, a.answer || ' ' || b.text AS answer, b.anchor AS also
  FROM (SELECT * FROM {answers} WHERE seq % 3 = 1) a JOIN {lines} l ON l.stream = a.stream AND l.anchor = a.anchor
  JOIN (SELECT stream, page, min(line) AS line FROM {rotated} GROUP BY stream, page) r ON r.stream = l.stream AND r.page = l.page
  JOIN {border} b ON b.stream = r.stream AND b.page = r.page AND b.line = r.line"""


@relation("swept_answers", "rotated_lines", "border_lines")
def rotated_excised(d, swept, rotated, border):
    """Swept answers without the border: the anchor is dropped, and each of its line's words is cut once from the text that holds it."""
    state = lambda word, left: d.record(word=word, rest=left)
    folded = d.fold("gone", state("''", "toks"), "a", "w", state("w.word", without(d, "a.rest", "w.word")))
    gone = d.map(tokens(d, "line_text"), "t", state("t", d.none("STRING")))
    return f"""
  SELECT stream, seq, anchor, {d.join('folded.rest', ' ')} AS answer, 1 AS rotated_lines_dropped
  FROM (SELECT stream, seq, anchor, {folded} AS folded FROM (
    SELECT s.stream, s.seq, s.anchor, {tokens(d, 's.answer')} AS toks, {gone.replace('line_text', 'b.text')} AS gone
    FROM {swept} s JOIN {rotated} r ON r.stream = s.stream AND r.anchor = s.also JOIN {border} b ON b.stream = s.stream AND b.anchor = s.also) q) q"""


@relation("provider_answers")
def conservation(d, answers):
    """Whether an answer holds the words of its lines: strict as bags, normalized (case and punctuation aside, or joined up), or failed."""
    if d.name == "spark":
        return graded(d, answers)
    return f"""
  SELECT stream, seq, anchor, {level(d, 'ta', 'ts')} AS level FROM (SELECT stream, seq, anchor, {tokens(d, 'answer')} AS ta, {tokens(d, 'source')} AS ts FROM {answers}) t"""


def graded(d, answers: str, more: str = "") -> str:
    """conservation for Spark, by the texts: equal ones hold the same words, bags are compared only where they are of one length, and words joined up are the text without the rest."""
    bag = lambda x: f"array_join(sort_array(split(trim({x}), ' +')), ' ')"
    bare = lambda x, rest: f"lower({d.swap(x, f'[^0-9A-Za-z_{rest}]+', '')})"
    both = lambda of: f"{of('answer')} = {of('source')}"
    return f"""
  SELECT stream, seq, anchor, CASE WHEN answer = source THEN 'strict' WHEN {both(lambda x: f"length(replace({x}, ' ', ''))")} AND {both(bag)} THEN 'strict'
      WHEN {both(lambda x: bare(x, ''))} THEN 'normalized' WHEN {both(lambda x: f"length({bare(x, '')})")} AND {both(lambda x: bag(bare(x, ' ')))} THEN 'normalized' ELSE 'failed' END AS level{more}
  FROM {answers}"""


@relation("provider_answers")
def multiset_diff(d, answers):
    """Words that an answer lost or added, with how many of each: a difference of bags."""
    one = lambda text, sign: f"SELECT stream, seq, anchor, token, {sign} AS n FROM {d.explode_from(f'(SELECT stream, seq, anchor, {tokens(d, text)} AS parts FROM {answers}) s_{text}', 'parts', 'token', 'place')}"
    return f"""
  SELECT stream, seq, anchor, token, CAST(sum(n) AS BIGINT) AS surplus FROM ({one('answer', '1')} UNION ALL {one('source', '-1')}) q
  GROUP BY stream, seq, anchor, token HAVING sum(n) <> 0"""


@relation("rule_buckets", "provider_answers")
def anchor_census(d, buckets, answers):
    """Every line that had to be claimed, and every claim: kept by its first claimant, duplicate, phantom, or missed."""
    need = f"SELECT stream, seq, anchor FROM {buckets} WHERE bucket IN ('rows', 'note_lines', 'unresolved') AND kind <> 'blank'"
    return f"""
  SELECT a.stream, a.seq, a.claimed AS anchor, a.rn AS claimant, CASE WHEN n.anchor IS NULL THEN 'phantom_anchor' WHEN a.nth > 1 THEN 'duplicate_anchor' ELSE 'kept' END AS status
  FROM (SELECT *, row_number() OVER (PARTITION BY stream, seq, claimed ORDER BY rn) AS nth FROM {answers}) a LEFT JOIN ({need}) n ON n.stream = a.stream AND n.seq = a.seq AND n.anchor = a.claimed
  UNION ALL
  SELECT n.stream, n.seq, n.anchor, NULL, 'llm_missed_line' FROM ({need}) n LEFT JOIN (SELECT DISTINCT stream, seq, claimed FROM {answers}) a ON a.stream = n.stream AND a.seq = n.seq AND a.claimed = n.anchor WHERE a.claimed IS NULL"""


@relation("repaired_rows", "split_hint", query=False, spark=("rule_rows", "stitch_tails"))
def claimed_rows(d, rows, hints, placed, stitches):
    """Components with what was claimed for them, how well the answer holds their words, and whether they were stitched: one pass, without storing the baseline. Read by Spark only."""
    made = f"(SELECT *, tail_anchor IS NOT NULL OR hyphen_anchor IS NOT NULL AS stitched FROM ({baseline_components(d, rows, hints, placed, stitches)}) b) c"
    return graded(d, f"({answered(d, made, ', stitched')}) a", ", claimed, stitched")


@relation("anchor_census", "conservation", "repaired_rows", spark=("claimed_rows",), spared=("anchor_census", "conservation", "repaired_rows"), unless=("anchor_census", "conservation", "repaired_rows", "split_hint", "baseline_components", "provider_answers"))
def component_flags(d, census, levels, rows, claimed):
    """Flags of a component: claims that failed, words that were lost, rows that were stitched."""
    failed = ""
    if claimed is not None:  # a component's own line had to be claimed, so no phantom has its anchor, and all claims of it but one are duplicates
        grades = d.list("'strict'", "'normalized'", "'failed'")
        claim = lambda anchor, grade, claims, stitched: d.record(anchor=anchor, grade=grade, claims=claims, stitched=stitched)
        own = lambda claims: claim("anchor", f"array_position({grades}, level)", claims, "CASE WHEN stitched THEN 1 ELSE 0 END")
        both = d.explode(f"CASE WHEN claimed = anchor THEN {d.list(own('1'))} ELSE {d.list(own('0'), claim('claimed', '0L', '1', '0'))} END", "c")
        return f"""
  SELECT stream, seq, anchor, {d.at(grades, 'grade')} AS level, CAST(0 AS BIGINT) AS phantom, greatest(claims - 1, 0) AS duplicate, multi_row, grade = 3 AS fell_back_to_split_hint
  FROM (
    SELECT stream, seq, c.anchor AS anchor, max(c.grade) AS grade, sum(c.claims) AS claims, max(c.stitched) AS multi_row
    FROM (SELECT stream, seq, c FROM {claimed} {both}) e GROUP BY stream, seq, c.anchor) g
  WHERE grade > 0"""
    if d.name == "spark":  # claims that were kept and lines without one count for nothing
        failed = " WHERE status IN ('phantom_anchor', 'duplicate_anchor')"
    return f"""
  SELECT r.stream, r.seq, r.anchor, l.level, coalesce(c.phantom, 0) AS phantom, coalesce(c.duplicate, 0) AS duplicate,
    CASE WHEN r.tail_anchor IS NOT NULL OR r.hyphen_anchor IS NOT NULL THEN 1 ELSE 0 END AS multi_row, l.level = 'failed' AS fell_back_to_split_hint
  FROM {rows} r JOIN {levels} l ON l.stream = r.stream AND l.seq = r.seq AND l.anchor = r.anchor
  LEFT JOIN (SELECT stream, seq, anchor, count(CASE WHEN status = 'phantom_anchor' THEN 1 END) AS phantom, count(CASE WHEN status = 'duplicate_anchor' THEN 1 END) AS duplicate FROM {census}{failed} GROUP BY stream, seq, anchor) c
    ON c.stream = r.stream AND c.seq = r.seq AND c.anchor = r.anchor"""


@relation("component_flags")
def assembly_confidence(d, flags):
    return f"SELECT stream, seq, anchor, CASE WHEN level = 'failed' OR phantom + duplicate > 0 THEN 'low' WHEN level = 'normalized' OR multi_row > 0 THEN 'medium' ELSE 'high' END AS confidence FROM {flags}"


@relation("tail_words", "vocabulary", "column_bands", "slot_zones")
def slot_evidence(d, tails, vocab, bands, zones):
    """What speaks for the word at an empty column: the vocabulary, the column's band, or a bounded zone."""
    return f"""
  SELECT t.stream, t.seq, t.anchor, t.role, t.text,
    CASE WHEN v.value IS NOT NULL THEN 'vocabulary' WHEN abs(t.x0 - b.x0) <= b.tol THEN 'column' WHEN z.hi IS NOT NULL AND t.x0 >= z.lo AND t.x0 < z.hi THEN 'column' END AS evidence
  FROM {tails} t LEFT JOIN {vocab} v ON v.stream = t.stream AND v.role = t.role AND v.value = t.text
  LEFT JOIN {bands} b ON b.stream = t.stream AND b.role = t.role LEFT JOIN {zones} z ON z.stream = t.stream AND z.role = t.role
  WHERE t.value IS NULL"""


@relation("tail_words", "slot_zones")
def slot_veto(d, tails, zones):
    """Accepted values that stand more than ten points outside a zone made from a band."""
    return f"""
  SELECT t.stream, t.seq, t.anchor, t.role, t.value FROM {tails} t JOIN {zones} z ON z.stream = t.stream AND z.role = t.role AND z.origin = 'band'
  WHERE t.value IS NOT NULL AND t.text = t.value AND NOT (t.x0 >= z.lo - 10 AND t.x0 < coalesce(z.hi, 1e9) + 10)"""


@relation("repaired_rows", "zone_words", "rule_rows")
def zone_fill(d, rows, words, placed):
    """Empty columns that hold exactly one different word of their zone on the row's line."""
    return f"""
  SELECT r.stream, r.seq, r.anchor, w.role, min(w.text) AS value FROM {rows} r
  JOIN {placed} p ON p.stream = r.stream AND p.seq = r.seq AND p.anchor = r.anchor
  JOIN {words} w ON w.stream = p.stream AND w.page = p.page AND w.line = p.line
  WHERE CASE w.role WHEN 'mfr' THEN r.mfr IS NULL WHEN 'finish' THEN r.finish IS NULL ELSE r.unit IS NULL AND w.text IN ({d.words(UNITS)}) END
  GROUP BY r.stream, r.seq, r.anchor, w.role HAVING count(DISTINCT w.text) = 1"""


@relation("block_spans", "blocks")
def set_location(d, spans, blocks):
    """A set's pages, lines and box."""
    return f"""
  SELECT b.stream, b.seq, b.set_id, min(s.page) AS first_page, max(s.page) AS last_page, CAST(sum(s.last_line - s.first_line + 1) AS BIGINT) AS lines, min(s.x0) AS x0, min(s.top) AS top, max(s.x1) AS x1, max(s.bottom) AS bottom
  FROM {blocks} b JOIN {spans} s ON s.stream = b.stream AND s.seq = b.seq GROUP BY b.stream, b.seq, b.set_id"""


@relation("rule_buckets")
def set_notes(d, buckets):
    """Notes of a set in reading order, joined."""
    return f"SELECT stream, seq, count(*) AS n, {d.join(d.gather('text', 'pos'), ' | ')} AS notes FROM {buckets} WHERE bucket = 'note_lines' GROUP BY stream, seq"


@relation("blocks", "rule_buckets", "baseline_components", "stitch_tails", "trailer_continuation", spared=("baseline_components",))
def set_records(d, blocks, buckets, components, stitches, continued):
    """A row a set: number, description (its own, else the header's trailer), and what it holds."""
    count = lambda name, test: f"count(CASE WHEN {test} THEN 1 END) AS {name}"
    value = d.cut("norm", r"(?i)^Description\s*:\s*(.*)$", 1)
    return f"""
  SELECT b.stream, b.seq, b.set_id AS set_number, b.family, b.anchor_first AS header_anchor, coalesce(nullif(p.description, ''), nullif(coalesce(t.trailer, b.trailer), '')) AS description,
    coalesce(p.n_components, 0) AS n_components, coalesce(p.n_doors, 0) AS n_doors, coalesce(p.n_notes, 0) AS n_notes, coalesce(p.n_properties, 0) AS n_properties, coalesce(p.n_unresolved, 0) - coalesce(s.n, 0) AS n_unassigned, b.empty
  FROM {blocks} b
  LEFT JOIN (SELECT stream, seq, max(CASE WHEN bucket = 'description' THEN {value} END) AS description, {count('n_components', "bucket = 'rows'")}, {count('n_doors', "bucket = 'door_lines'")},
      {count('n_notes', "bucket = 'note_lines'")}, {count('n_properties', "bucket = 'properties'")}, {count('n_unresolved', "bucket = 'unresolved'")} FROM {buckets} GROUP BY stream, seq) p ON p.stream = b.stream AND p.seq = b.seq
  LEFT JOIN (SELECT stream, seq, count(*) AS n FROM {stitches} GROUP BY stream, seq) s ON s.stream = b.stream AND s.seq = b.seq
  LEFT JOIN {continued} t ON t.stream = b.stream AND t.seq = b.seq"""


def totals(sets: str, confidence: str | None = None) -> str:
    """Sets and components of a stream, and with a confidence how many of each."""
    out = f"(SELECT stream, count(*) AS n_sets, CAST(sum(n_components) AS BIGINT) AS n_components, count(CASE WHEN empty THEN 1 END) AS n_empty FROM {sets} GROUP BY stream) s"
    if confidence is None:
        return f"SELECT * FROM {out}"
    return f"""SELECT s.stream, s.n_sets, s.n_components, s.n_empty, coalesce(c.high, 0) AS high, coalesce(c.medium, 0) AS medium, coalesce(c.low, 0) AS low FROM {out}
  LEFT JOIN (SELECT stream, count(CASE WHEN confidence = 'high' THEN 1 END) AS high, count(CASE WHEN confidence = 'medium' THEN 1 END) AS medium, count(CASE WHEN confidence = 'low' THEN 1 END) AS low FROM {confidence} GROUP BY stream) c ON c.stream = s.stream"""


@relation("set_records", "assembly_confidence", "llm_cache_join")
def assembly_summary(d, sets, confidence, cache):
    """Totals of a stream: sets, components, confidence, and calls that the cache saved."""
    return f"""
  SELECT s.stream, s.n_sets, s.n_components, s.n_empty, coalesce(c.high, 0) AS high, coalesce(c.medium, 0) AS medium, coalesce(c.low, 0) AS low, coalesce(l.calls, 0) AS calls, coalesce(l.hits, 0) AS hits
  FROM (SELECT stream, count(*) AS n_sets, CAST(sum(n_components) AS BIGINT) AS n_components, count(CASE WHEN empty THEN 1 END) AS n_empty FROM {sets} GROUP BY stream) s
  LEFT JOIN (SELECT stream, count(CASE WHEN confidence = 'high' THEN 1 END) AS high, count(CASE WHEN confidence = 'medium' THEN 1 END) AS medium, count(CASE WHEN confidence = 'low' THEN 1 END) AS low FROM {confidence} GROUP BY stream) c ON c.stream = s.stream
  LEFT JOIN (SELECT stream, count(*) AS calls, count(CASE WHEN hit THEN 1 END) AS hits FROM {cache} GROUP BY stream) l ON l.stream = s.stream"""
