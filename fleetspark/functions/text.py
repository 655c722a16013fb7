"""Text parsing with native regex functions (stay inside whole-stage codegen).

Patterns are Java regex; each is also valid RE2, so the DuckDB oracle can use
the very same text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Patterns of the engine status report, as the reference uses
# them (group numbers as noted).  These must match for equal results.
# ---------------------------------------------------------------------------
MONITOR_TIME = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \d+ INNODB MONITOR OUTPUT"
RESERVATION_COUNT = r"OS WAIT ARRAY INFO: reservation count (\d+)"
SIGNAL_COUNT = r"OS WAIT ARRAY INFO: signal count (\d+)"
RW_SHARED = r"RW-shared spins (\d+), rounds \d+, OS waits (\d+)"
RW_EXCL = r"RW-excl spins (\d+), rounds \d+, OS waits (\d+)"
DEADLOCK_TIME = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \d+\n\*\*\*"
TX_QUERY = r"MySQL thread id \d+[^\n]*\n([^\n]+)"
DEADLOCK_VICTIM = r"WE ROLL BACK TRANSACTION \((\d+)\)"
TRX_ID_COUNTER = r"Trx id counter (\d+)"
HISTORY_LENGTH = r"History list length (\d+)"
FILE_IO_RATE = r"(\d+\.?\d*) reads/s, \d+ avg bytes/read, (\d+\.?\d*) writes/s, (\d+\.?\d*) log writes/s"
LOG_SEQUENCE = r"Log sequence number\s+(\d+)"
LOG_FLUSHED = r"Log flushed up to\s+(\d+)"
LAST_CHECKPOINT = r"Last checkpoint at\s+(\d+)"
BP_SIZE = r"Buffer pool size\s+(\d+)"
BP_FREE = r"Free buffers\s+(\d+)"
BP_DATABASE = r"Database pages\s+(\d+)"
BP_MODIFIED = r"Modified db pages\s+(\d+)"
BP_HIT_RATE = r"Buffer pool hit rate (\d+) / (\d+)"
BP_RW_RATE = r"(\d+\.?\d*) reads/s, (\d+\.?\d*) creates/s, (\d+\.?\d*) writes/s"
QUERIES_INSIDE = r"(\d+) queries inside InnoDB, (\d+) queries in queue"
ROW_OPS_RATE = r"(\d+\.?\d*) inserts/s, (\d+\.?\d*) updates/s, (\d+\.?\d*) deletes/s, (\d+\.?\d*) reads/s"
UNSIGNED = r"\d+\.?\d*"
DEADLOCK_MARK = "LATEST DETECTED DEADLOCK"
DEADLOCK_START = "LATEST DETECTED DEADLOCK\n"
DEADLOCK_END = "\nTRANSACTIONS\n"

# ---------------------------------------------------------------------------
# Statement fingerprint (our definition): the tokens of a lower-cased statement.
# Three passes, each of which reads over the tokens that it leaves as they are:
# comments, then strings, then numbers.  \G ties each match to the one before,
# so that no pass looks into a token.  Where a statement has no comments and no
# back-quotes (PLAIN_...) there is less to read over.
# Possessive quantifiers keep Java's matcher from recursing over long literals.
# ---------------------------------------------------------------------------
FP_COMMENT = r"/\*[\s\S]*?(?:\*/|\z)|--(?:[ \t\r][^\n]*|\n|\z)|#[^\n]*"
FP_STRING = r"""(?:'(?:[^'\\]++|\\[\s\S]|'')*+(?:'|\\?\z)|"(?:[^"\\]++|\\[\s\S]|"")*+(?:"|\\?\z))"""
FP_NUMBER = r"(?:0x[0-9a-f]+|0b[01]+|(?:[0-9]+(?:\.[0-9]+)*|\.[0-9]+)(?:e[-+]?[0-9]+)?)\b"
FP_QUOTED_NAME = r"`[^`]*+(?:`|\z)"
FP_LETTER = r"[a-z0-9_$@\x{80}-\x{10FFFF}]"
FP_NAME = rf"[a-z_$@\x{{80}}-\x{{10FFFF}}]{FP_LETTER}*+(?:\.{FP_LETTER}++)*+"
FP_SIGNS = r"[^a-z0-9_$@\x{80}-\x{10FFFF}`.]++"
FP_COMMENTS = rf"""\G(?:((?:[^'"`/#-]++|{FP_STRING}|{FP_QUOTED_NAME}|/(?!\*)|-(?!-(?:\s|\z)))++)|{FP_COMMENT})"""
FP_STRINGS = rf"""\G((?:[^'"`xbn]++|{FP_QUOTED_NAME}|[xbn](?!')|(?<={FP_LETTER})[xbn])*+)[xbn]?{FP_STRING}"""
FP_NUMBERS = rf"\G((?:{FP_NAME}|{FP_SIGNS}|{FP_QUOTED_NAME}|(?!{FP_NUMBER})(?:[0-9]*{FP_NAME}|[\s\S]))*+){FP_NUMBER}"
PLAIN_STRINGS = rf"""\G((?:[^'"xbn]++|[xbn](?!')|(?<={FP_LETTER})[xbn])*+)[xbn]?{FP_STRING}"""
PLAIN_NUMBERS = rf"\G((?:[^0-9.]++|(?<={FP_LETTER})[.0-9]|(?<={FP_LETTER}\.)[0-9]|(?!{FP_NUMBER})[.0-9])*+){FP_NUMBER}"
FP_LIST = r"\(\s*[-+]?\?(?:\s*,\s*[-+]?\?)*+\s*\)"
FP_LISTS = rf"{FP_LIST}(?:\s*,\s*{FP_LIST})*+"
FP_SPACE = r"\G((?:\S++| (?!\s))*+)\s++"
FP_ENDS = " ;"

# Slow-log record parts.
SLOW_USER_HOST = r"# User@Host: ([^\n]*)"
SLOW_TIMING_LINE = r"# Query_time:[^\n]*"
SLOW_QUERY_TIME = r"# Query_time: ([0-9.]+)"
SLOW_LOCK_TIME = r"Lock_time: ([0-9.]+)"
SLOW_ROWS_SENT = r"Rows_sent: (\d+)"
SLOW_ROWS_EXAMINED = r"Rows_examined: (\d+)"
SLOW_HEADER_LINES = r"^(?:#[^\n]*\n|SET timestamp=\d+;\n|use [^\n]*;\n)++"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_bigint(digits: Column) -> Column:
    """Digits -> BIGINT; a number above the range is its largest value; NULL if there are none."""
    most = F.lit((1 << 63) - 1)
    return F.when(digits != "", F.coalesce(digits.try_cast("bigint"), most))


def extract_long(text, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` (a digit group) as BIGINT, 0 when absent."""
    return F.coalesce(to_bigint(F.regexp_extract(_c(text), pattern, group)), F.lit(0).cast("bigint"))


def extract_double(text, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` as DOUBLE, 0 when absent."""
    return F.coalesce(F.regexp_extract(_c(text), pattern, group).try_cast("double"), F.lit(0.0))


def section_between(text, start: str, end: str) -> Column:
    """What stands between the first ``start`` and the next ``end`` after it.

    '' without ``start``; the rest of the text without ``end``.
    """
    after = F.split(_c(text), _literal(start), 2)
    return F.coalesce(F.split(F.try_element_at(after, F.lit(2)), _literal(end), 2)[0], F.lit(""))


def _literal(words: str) -> str:
    return "\\Q" + words + "\\E"


def fingerprint(sql) -> Column:
    """Normalise a statement.

    Lower-cased, its tokens from left to right: comments become a space; strings
    (either quote, doubled or escaped quotes inside, x'..', b'..' and n'..') and
    numbers (decimal, with exponent, hexadecimal, binary) become ?; back-quoted
    and other names stay, digits in them too.  A literal or comment without an
    end reaches to the end of the statement.  Then lists of literals become
    (?+), lists of such lists one (?+), white space one space; outer space and
    ';' at the end go.
    """
    s = F.lower(_c(sql))
    plain = F.regexp_replace(F.regexp_replace(s, PLAIN_STRINGS, "$1?"), PLAIN_NUMBERS, "$1?")
    # what the first pass keeps ends at a comment or at the end, so the space after it stands for the comment
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, FP_COMMENTS, "$1 "), FP_STRINGS, "$1?"), FP_NUMBERS, "$1?")
    special = _c(sql).contains("`") | _c(sql).contains("#") | _c(sql).contains("--") | _c(sql).contains("/*")
    s = F.regexp_replace(F.when(special, bare).otherwise(plain), FP_LISTS, "(?+)")
    return F.rtrim(F.ltrim(F.regexp_replace(s, FP_SPACE, "$1 ")), F.lit(FP_ENDS))


def cut_bytes(text, n: int) -> Column:
    """The longest start of a text that has at most ``n`` bytes in UTF-8 and whole characters.

    At most ``n`` characters can fit; of those as many are dropped as make the
    rest fit, found over the ``n + 1`` possible lengths only for texts that are
    too long in bytes.
    """
    t = F.left(_c(text), F.lit(n))
    fits = F.filter(F.sequence(F.lit(0), F.length(t)), lambda k: F.octet_length(F.left(t, k)) <= n)
    return F.when(F.octet_length(t) <= n, t).otherwise(F.left(t, F.array_max(fits)))


def first_match_in_lines(lines, pattern: str, literal: str) -> Column:
    """Whole first match of a single-line ``pattern`` that always contains
    ``literal`` ('' if none), searched only in the lines holding ``literal``.

    Every match lies within one line and contains ``literal``, so the first
    match among those lines (kept in order) is the first match of the whole
    text.  Patterns that start with a digit group cost a regex attempt at
    every digit of the text; this keeps them to one or two short lines.
    """
    kept = F.filter(_c(lines), lambda line: line.contains(literal))
    return F.regexp_extract(F.array_join(kept, "\n"), pattern, 0)
