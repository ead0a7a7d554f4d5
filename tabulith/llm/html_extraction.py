"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass classifies each block on its own: by
link density (characters in links), length, and stop-word density over short lists for several
languages. Blocks in boilerplate containers (navigation, headers, footers, asides, forms, containers whose
class or id names adverts, notices, comments and the like) are bad; outside an article, and on an article
itself, such a name counts only if the container holds no more than half of the text of the page's articles, or
of the page where it has none. In an article, links make a block bad only if it is short and all link. Where the
page's long blocks fit none of the languages, length and links alone decide. The second pass gives every ambiguous
block (short, or nearly good) the label of its nearest decided neighbours in page order: that of both if
they agree, else that of the nearer one by characters between; where a page marks its article, blocks of
the article look only at its good blocks, and are good if there is none.

Edges: null or empty html gives the empty text; markup that is never closed ends with the page;
character references are decoded, once; repeated rows each get their text; nothing is cut off; an empty table
gives an empty result. Very long pages and deep nesting cost in proportion to their length. Columns of pages named
text or n_chars are replaced, html is left out, others are carried along whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.llm.common import boxed, small_batches, unboxed

SHORT, LONG = 70, 200  # characters
STOP_LOW, STOP_HIGH = 0.10, 0.20  # shares of stop words
LINKS = 0.33

#: Function words of English, German, French, Spanish, Italian, Portuguese, Dutch, Swedish and Polish.
STOP_WORDS = frozenset(
    "the of and to a in is it that was for on are as with be at by this from or an not but which they we you he she his her has have had were been their its will would can if so"
    " der die das und ist in den von zu mit sich des auf für nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch"
    " le la les de des un une et est en du que qui dans pour par sur pas au plus ce il elle avec ne se sont aux ou leur mais cette"
    " el los las y del que en un una por con no para es al lo como más su sus se o pero este esta entre"
    " il lo gli i di da in con per non che è sono una dei delle della nel alla più anche come ma ha si del al"
    " o os as do da dos das em no na não um uma com se por mais ao ou seu sua foi são também pelo"
    " de het een van en in is dat op te zijn met voor niet aan er om ook als bij maar uit nog naar dan door over"
    " och att det som en på är av för med den till inte har ett om var jag men vi från så kan"
    " i w na z że się nie do jest to o jak po co ale przez od dla za są był być tym już tylko oraz ze".split()
)
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video textarea select option datalist".split())
BOILER = frozenset("nav header footer aside form menu button dialog fieldset label".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"sidebar|side|widget|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|copyright|comments?|commentlist|disqus|replies|respond|share|sharing|social|related|recommended|pagination|pager|tags|toolbar)(?=$|[\s_-])",
    re.I,
)
#: In an article, its own heading is none of these.
HEADING = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?=$|[\s_-])", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form menu alert dialog".split())
#: A closing tag of these ends the open paragraph, too; a paragraph ends at the next block.
SPACES = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    linked: int  # characters within links
    bad: bool  # in a boilerplate container
    main: bool  # in the page's article
    marked: tuple[int, ...] = ()  # containers around it whose name is boilerplate, if they don't hold most of the text
    label: str = ""


def cut_blocks(page: str) -> list[Block]:
    blocks: list[Block] = []
    pieces: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool, int]] = []  # open containers: (tag, bad, main, number if its name is to be judged by its share of the text)
    opened, bads, mains, marks = Counter(), 0, 0, []  # of the open containers: how many of each tag, bad ones, articles, numbers
    numbers = 0
    link = False
    at = 0

    def flush():
        nonlocal linked
        text = SPACES.sub(" ", "".join(pieces)).strip()
        if text:
            blocks.append(Block(text, min(linked, len(text)), bads > 0, mains > 0, tuple(marks)))
        pieces.clear()
        linked = 0

    def take(raw: str):
        nonlocal linked
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if link:
                linked += len(SPACES.sub(" ", text).strip())

    def leave(i: int):
        """Close the i-th open container."""
        nonlocal bads, mains
        tag, bad, main, number = stack.pop(i)
        opened[tag] -= 1
        bads -= bad
        mains -= main
        if number:
            marks.remove(number)

    n = len(page)
    while at < n:
        found = TOKEN.search(page, at)
        if not found:
            take(page[at:])
            break
        take(page[at : found.start()])
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            if name in BLOCK or name in MAIN:
                flush()
            if name == "a":
                link = False
            if opened[name]:
                while stack[-1][0] != name:
                    leave(-1)
                leave(-1)
                link = link and name in ("p", "span")  # a link that was never closed ends with its container
            continue
        if name in SILENT:
            if found[3].endswith("/"):
                continue
            if name == "head":  # its children are silent by themselves; a page may never close it
                continue
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name in BLOCK:
            flush()
        if name == "a":
            link = True
        if name in VOID or found[3].endswith("/"):
            continue
        if name in BOILER or name in MAIN or name in ("div", "section", "ul", "ol", "table", "td", "p", "span", "li", "dl", "figure"):
            inside = mains > 0
            number = 0
            bad = name in BOILER and not (inside and name == "header")
            if not bad and found[3]:
                for key, *values in ATTRIBUTE.findall(found[3]):
                    value = next((v for v in values if v), "")
                    if inside:
                        value = HEADING.sub("", value)
                    if key.lower() == "role":
                        bad = bad or value.lower() in ROLES
                    elif MARKED.search(value):
                        if inside and name not in MAIN:
                            bad = True
                        elif not number:
                            numbers += 1
                            number = numbers
            if name == "p" and opened["p"]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"))
            stack.append((name, bad, name in MAIN, number))
            opened[name] += 1
            bads += bad
            mains += name in MAIN
            if number:
                marks.append(number)
    flush()
    judge_marked(blocks)
    return blocks


def judge_marked(blocks: list[Block]) -> None:
    """Blocks in containers of a boilerplate name are bad, unless the container holds most of the text of articles, or of the page without one."""
    counted = [b for b in blocks if not b.bad]
    counted = [b for b in counted if b.main] or counted
    total, held = 0, Counter()
    for b in counted:
        total += len(b.text)
        for k in b.marked:
            held[k] += len(b.text)
    for b in blocks:
        b.bad = b.bad or any(2 * held[k] <= total for k in b.marked)


def stop_words(text: str) -> tuple[int, int]:
    words = text.split()
    return sum(w.strip(".,;:!?\"'()").lower() in STOP_WORDS for w in words), len(words)


def known_language(blocks: list[Block]) -> bool:
    """Whether the long blocks that may be text have the stop words of one of the languages."""
    counts = [stop_words(b.text) for b in blocks if not b.bad and len(b.text) >= SHORT and b.linked <= LINKS * len(b.text)]
    return sum(s for s, _ in counts) >= STOP_LOW * sum(n for _, n in counts)


def first_pass(block: Block, known: bool) -> str:
    """good, bad, or an ambiguous label: short, near."""
    if block.bad:
        return "bad"
    size = len(block.text)
    if block.linked > LINKS * size and (not block.main or (size < SHORT and block.linked == size)) or block.text[0] == "©":
        return "bad"
    if size < SHORT:
        return "short"
    if not known:
        return "good" if size >= LONG else "near"
    found, n = stop_words(block.text)
    stops = found / n
    if stops >= STOP_HIGH:
        return "good" if size >= LONG else "near"
    if stops >= STOP_LOW:
        return "near"
    return "near" if block.main else "bad"


def second_pass(blocks: list[Block]) -> None:
    """Ambiguous blocks take the label of the nearest decided neighbours."""
    n = len(blocks)
    ends = [0]
    for b in blocks:
        ends.append(ends[-1] + len(b.text))
    decided = [b.label if b.label in ("good", "bad") else "" for b in blocks]
    article = any(b.main for b in blocks)
    for main in (True, False):
        # an article's boilerplate and lists of links say nothing about the text between them
        own = [i for i in range(n) if blocks[i].main and decided[i] != "bad"] if main else list(range(n))
        before, last = {}, -1
        for i in own:
            before[i] = last
            if decided[i]:
                last = i
        after, nxt = {}, -1
        for i in reversed(own):
            after[i] = nxt
            if decided[i]:
                nxt = i
        for i in own:
            if decided[i] or blocks[i].main != main:
                continue
            left, right = before[i], after[i]
            if left < 0 and right < 0:
                blocks[i].label = "good" if main else ("bad" if article else ("good" if blocks[i].label == "near" else "bad"))
            elif left < 0 or right < 0:
                blocks[i].label = decided[max(left, right)]
            elif decided[left] == decided[right]:
                blocks[i].label = decided[left]
            else:
                near = left if ends[i] - ends[left + 1] <= ends[right] - ends[i + 1] else right
                blocks[i].label = decided[near]


def main_text(page: str | None) -> str:
    """The page's good blocks, in page order, joined by spaces."""
    blocks = cut_blocks(page or "")
    known = known_language(blocks)
    for b in blocks:
        b.label = first_pass(b, known)
    second_pass(blocks)
    marked = any(b.main and b.label == "good" for b in blocks)
    return " ".join(b.text for b in blocks if b.label == "good" and (b.main or not marked))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with html replaced by text, the main text, and n_chars, its number of code points."""

    def extracted(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column("_html").to_pylist()]
            row = batch.column("_row")
            yield pa.RecordBatch.from_arrays([row, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["_row", "_text", "_chars"])

    shaped = boxed(small_batches(pages), _html=F.col(html))
    row = shaped.schema["_row"].dataType.simpleString()
    out = shaped.mapInArrow(extracted, f"_row {row}, _text string, _chars long")
    return unboxed(out, [c for c in pages.columns if c != html], text=F.col("_text"), n_chars=F.col("_chars"))
