"""Patterns and thresholds of the schedule grammar.

The values are fixed: results depend on them to the letter. A pattern with a second spelling is a pair
(java, re2), where RE2 has no look-ahead.
"""

# Page signals.
QTY_UNITS = r"(?:EA|EACH|PRS?|PAIRS?|SETS?|LF|FT)"
QTY_UNIT_LINE = rf"(?i)^\s*\d{{1,3}}\s+{QTY_UNITS}\b"
QTY_BARE_LINE = r"^\s*\d{1,3}\s+[A-Za-z(]"
SET_ID = r"[A-Z]{0,3}-?\d{1,4}[A-Z]{0,3}"
SET_KEYWORD = r"(?:(?:HW|HDW|HARDWARE)\s+(?:SETS?|GROUPS?)|HEADING|SET)"
SET_KEYWORD_LOOSE = r"(?:(?:HW|HDW|HARDWARE)\s+(?:SETS?|GROUPS?)|SET)"
#: One of these is in every text that SET_HEADER finds, upper-cased.
SET_HEADER_WORDS = ["SET", "GROUP", "HEADING", "HW", "HDW"]
SET_HEADER = (
    rf"(?im)\b{SET_KEYWORD_LOOSE}\s*(?:NO\.?|NUMBER|#)?\s*[:#]?\s*{SET_ID}\b"
    rf"|\bHEADING\s*(?:NO\.?)?\s*[:#]\s*{SET_ID}\b"
    rf"|\b{SET_KEYWORD}\s*(?:NO\.?|#)\s*[A-Z]{{2,10}}\b"
    rf"|^[ \t]*(?:HW|HDW)\s*[-#:]?\s*{SET_ID}\b"
)
FINISH_TOKEN = r"\b(?:US\d{1,2}[A-Z]?|6\d{2}|C\d{2}D|\d{2}D)\b"
WIDE_QTY = r"(?:^|\s)(?:\d{1,3}|--)\s+(?:6\d{2}\b|US\d{1,2}[A-Z]?\b|BLACK\b)"
SECTION_08 = r"\b08\s*[- ]?\s*7\d\s*[- ]?\s*\d{2}\b|\b087\d{3}\b"
PAGE_COLUMN_WORDS = ["QTY", "QUANTITY", "DESCRIPTION", "CATALOG", "MODEL", "PRODUCT", "FINISH", "MFR", "MANUFACTURER", "NOTES"]
FILE_HINT = r"(?i)08[\s._-]?7\d|hardware"
SUSPECT = r"(?i)^\s*(?:PART\s+\d{1,3}\s*[-–]\s*)?(?:HARDWARE\s+(?:SETS?|GROUPS?)|(?:HW|HDW)\s+SETS?|HEADING|SET|GROUP)\s*(?:NO\.?|#|:)\s*[A-Za-z0-9]"
SETS_TITLE = (
    r"(?i)^\s*(?:\d+(?:\.\d+)*\s+|[A-Z]\.\s+|PART\s+\d+\s*[-–]\s*)?"
    r"(?:(?:DOOR\s+)?HARDWARE\s+(?:SETS?|GROUPS?|SCHEDULE)|SCHEDULE\s+OF\s+(?:FINISH(?:ING)?\s+)?HARDWARE|FINISH(?:ING)?\s+HARDWARE\s+SCHEDULE)\s*:?\s*$"
)
REFER = r"(?i)\brefer\w*\s+to\b|\bsee\s+(?:section|division)\b"
END_OF_SECTION = r"(?i)\bEND\s+OF\s+SECTION\b"
CSI_FOOTER = r"\b(\d{2}\s?\d{2}\s?\d{2})\s*[-–—]\s*(\d{1,3})\s*$"
CSI_FOOTER_CHARS = 60
TAIL_PAGES = 15
IMAGE_ONLY_CHARS = 30
SPARSE_CHARS = 400
MAX_GAP = 2
DENSE_PAGES, DENSE_FINISH, DENSE_QTY = 3, 20, 50
TITLE_PAGES = 6
REFER_LINES, REFER_SHORT, REFER_AHEAD = 7, 200, 400

# Line roles.
ROLE_COLUMN_WORDS = ["QTY", "QUANTITY", "DESCRIPTION", "CATALOG", "MODEL", "PRODUCT", "FINISH", "MFR", "MANUFACTURER", "NOTES", "NUMBER", "NO"]
PART_SHELL = r"(?i)^\s*PART\s+\d{1,3}\s*[-–—]\s*$"
ROLES = ["page_header", "page_footer", "col_hdr", "noise", "struck", "content"]
STRUCK_ROLE, STRUCK_REPORT = 0.95, 0.30
FURNITURE_SHARE, FURNITURE_DEVIATION, TOP_BAND, BOTTOM_BAND, FURNITURE_PAGES, SUSPECT_SHARE = 0.6, 3.0, 0.10, 0.85, 3, 0.3
STRIKE_HEIGHT, STRIKE_WIDTH, STRIKE_LOW, STRIKE_HIGH, STRIKE_OVERLAP, STRIKE_STORED = 1.6, 4.0, 0.30, 0.70, 0.5, 0.05

# Set headers.
PART_PREFIX = r"(?:PART\s+\d{1,3}\s*[-–—]\s*)?"
_HYPHENED = r"[A-Z]{1,3}-\d{1,4}(?:\.\d{1,3})?[A-Z]{0,3}"
HEADER_ID = (rf"(?:{_HYPHENED}|(?=[A-Z0-9.]*\d)[A-Z0-9]+(?:\.[A-Z0-9]+)*|[A-Z]{{2,10}})", rf"(?:{_HYPHENED}|[A-Z0-9]*\d[A-Z0-9]*(?:\.[A-Z0-9]+)*|[A-Z]{{2,10}})")
NUMBER_ID = (r"(?=[A-Z0-9.]*\d)[A-Z0-9]+(?:\.[A-Z0-9]+)*", r"[A-Z0-9]*\d[A-Z0-9]*(?:\.[A-Z0-9]+)*")


def _pair(before: str, ids: tuple[str, str], after: str) -> tuple[str, str]:
    return tuple(f"(?i){before}({i}){after}" for i in ids)


FAMILIES = [
    ("group_no", _pair(rf"^{PART_PREFIX}(?:HW|HDW|HARDWARE)\s+GROUPS?(?:\s*/\s*SETS?)?\s*(?:NO\.?|NUMBER|#)\s*[:#]?\s*", HEADER_ID, r"\b\s*(.*)$")),
    ("set_hash", _pair(r"^SET\s*#\s*", HEADER_ID, r"\b\s*(.*)$")),
    ("heading", _pair(r"^HEADING\s*#\s*", HEADER_ID, r"\b\s*(.*)$")),
    ("set_colon", _pair(r"^SET\s*(?:NO\.?|NUMBER)?\s*:\s*", HEADER_ID, r"\b\s*(.*)$")),
    ("hw_set", _pair(rf"^{PART_PREFIX}(?:HW|HDW|HARDWARE)\s+SETS?\s+(?:NO\.?|NUMBER|#)\s*[:#]?\s*", HEADER_ID, r"\b\s*(.*)$")),
    ("hw_bare", _pair(r"^(?:HW|HDW)\s*[-#:]?\s*", NUMBER_ID, r"\b\s*(.*)$")),
    ("assigned_following", _pair(r"^.*?(?:HW|HDW|HARDWARE)\s+GROUPS?(?:\s*/\s*SETS?)?\s*(?:NO\.?|NUMBER|#)\s*[:#]?\s*", HEADER_ID, r"\b(.*\bfollowing\s*:)\s*$")),
]
#: One of these is in every header of a family, upper-cased.
FAMILY_WORDS = ["GROUP", "SET", "HEADING", "HW", "HDW"]
WIDE_FAMILY = ("bare_dotted", (r"^(\d{1,2}\.\d{1,2})\s+(?=[A-Z(])(.*)$", r"^(\d{1,2}\.\d{1,2})\s+([A-Z(].*)$"))
WIDE_COLUMN_HEADER = r"(?i)^SET\s+HARDWARE\s+TYPE\b"
TRAILER_JOINER = r"^[:,\-–—]+\s*"
TERMINATOR = rf"(?i)^{PART_PREFIX}END\s+OF\s+SECTION\b"
OVERSIZE_FACTOR, OVERSIZE_BLOCKS = 3, 5

# Component candidates, slots and legends.
PRIVATE_USE = r"[\x{e000}-\x{f8ff}]"
PART_LEAD = r"(?i)^PART\s+\d{1,3}\s*[-–—]\s*"
CANDIDATE_LABEL = r"(?i)^(?:OPERATION\s*:|Description\s*:|Opening Description\s*:|Properties\s*:|Notes?\s*:|For use on Door|Doors?\s*:|Provide each\b.*:$)"
ITEM_NUMBER = r"(?i)^Item\s*#\d+\b"
LEAF_COUNT = r"(?i)^\d+\s+(?:Pair|Single)\b"
LEAF_OPERATOR = r"(?i)^\d+\s+(?:Pair|Single)\b\s+Operator\b"
DIMENSION = r"^\d{3,4}(?:,\s*\d{3,4})*\s*x\s*\d{3,4}\b"
CANDIDATE_QTY = r"^(\d+(?:\.[05])?)\s+(.*)$"
CANDIDATE_UNITS = ["EA", "SET", "SETS", "PR"]
ALPHA_WORD = r"^[A-Za-z][A-Za-z/&.,'-]{2,}$"
MFR_SHAPE = r"^(?:[A-Z]{2,4}\d{0,2}|B/O)$"
FINISH_SHAPE = r"^(?:US)?\d{1,4}[A-Z]{0,3}-?(?:/(?:US)?\d{1,4}[A-Z]{0,3})?$|^C\d{2}[A-Z]?$"
FINISH_WORDS = ["A", "AA", "BK", "BLK", "BSP", "CA", "EB", "EN", "GRY", "PT", "STST", "US"]
LEGEND_HIGH, SHARE_FLOOR, SHAPE_HIGH, HIGH_ROWS = 0.80, 0.50, 0.70, 50
LEGEND_PAGES = 6
KEYWORD_MFR = r"(?i)\b(?:abbreviations?|manufacturer(?:'s)?s?)\b"
KEYWORD_FINISH = r"(?i)\bfinish(?:es)?\b"
KEYWORD_OPTION = r"(?i)\boptions?\b"
KEYWORD_LEGEND = r"(?i)\blegend\b"
SCHEDULE_BEGINS = r"(?i)\bhardware\s+(?:sets?|groups?)\b\s*:?\s*$"
ARTICLE = r"(?i)^(?:\d+[.)]|PART\s+\d)"
CODE_ROW = (r"^(?:\d{1,2}\.\s+)?([A-Z0-9](?:[A-Z0-9/]|-(?=[A-Z0-9])){1,7})\s*[-–—]?\s+(\S.*)$", r"^(?:\d{1,2}\.\s+)?([A-Z0-9](?:[A-Z0-9/]|-[A-Z0-9]){1,7})\s*[-–—]?\s+(\S.*)$")
PAGES_SUFFIX = r"\s*\(Pgs?\s+[\d\s-]+\)$"
HEADER_CHARS, HEADER_WORDS, ROW_CHARS, CAPS_NAME, TABLE_CODES, ROW_GAP = 45, 6, 90, 12, 4, 8

# Rows.
COMPONENTS_OPENER = r"(?i)^PROVIDE\s+EACH\b.*:\s*$"
OPEN_DOOR_USE = r"(?i)^For use on Door\s*#?\(?s?\)?\s*:"
OPEN_DOORS = r"(?i)^Doors?\s*:"
OPEN_NOTES = r"(?i)^NOTES?\s*:"
OPEN_OPERATION = r"(?i)^OPERATION\s*:"
OPEN_DESCRIPTION = r"(?i)^Description\s*:\s*(.*)$"
OPEN_PROPERTIES = r"(?i)^(?:Opening\s+Description|Properties)\s*:\s*(.*)$"
BARE_QTY = r"^\d+$"
DOOR_LIST = r"^\d{1,4}[A-Z]{0,2}(?:\s+\d{1,4}[A-Z]{0,2})*$"
EACH_TO_HAVE = r"(?i)^Each\s+to\s+have\s*:?\s*$"
BY_WORD = r"^[A-Za-z][A-Za-z./&'-]*$"
ROLE_NOUNS = ["MANUFACTURER", "MFR", "SUPPLIER", "CONTRACTOR", "CONSULTANT", "PROVIDER", "OWNER", "OTHERS", "VENDOR", "INSTALLER", "DIVISION"]
QTY_LED = r"^(\d+(?:\.[05])?)\s+(?:((?:EA|SET|SETS|PR|Ea|Set|Sets|Pr)(?:-[A-Z])?\.?)\s+)?(\S.*)$"
VOCABULARY_COUNT, NAME_COUNT, ORPHAN_TOKENS, ORPHAN_CHARS = 2, 3, 3, 30
MFR_NAME = r"^[A-Z][a-z][A-Za-z&'-]+$"
STOP_TOKENS = ["AND", "AS", "BY", "FOR", "IN", "OF", "ON", "OR", "PER", "THE", "TO", "WITH"]
FINISH_VALUE = r"^(?:\d{2,3}|\d{2}[A-Z]{1,2}|\d{3}[A-Z]|US\d{1,2}[A-Z]?|C\d{2}[A-Z]?)$"
DESCRIPTION_WORD = r"[A-Za-z]{3,}"
BAND_TOLERANCE, BAND_ROWS, BAND_SHARE = 2.0, 3, 0.9
