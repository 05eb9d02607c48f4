"""Column-level helpers: every one is a built-in Spark expression (JVM side, inside
whole-stage codegen), never a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``str.strip()`` removes the Unicode White_Space set plus the four
# information separators U+001C..U+001F; ``(?U)\s`` in Java is White_Space.
_WS = r"[\s\x1c-\x1f]"
BLANK_PATTERN = rf"(?U)^{_WS}*$"

# Integer text both ``int()`` and a SQL bigint cast take: optional sign, digits
# with single underscores between them, ASCII whitespace around (padding with other
# Unicode spaces is refused by the cast, so such a record is rejected).
_ASCII_WS = r"[ \t\n\x0b\x0c\r]"
INTEGER_TEXT_PATTERN = rf"^{_ASCII_WS}*[+-]?[0-9]+(_[0-9]+)*{_ASCII_WS}*$"
INTEGER_EDGE_WS_PATTERN = rf"^{_ASCII_WS}+|{_ASCII_WS}+$"

_OFFSET = r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)"
ISO_TIMESTAMP_PATTERN = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}:\d{2}"
    # one space may come before the offset, except after a fraction of fewer
    # than six digits
    rf"(?::\d{{2}}(?:\.\d+(?:(?<=\d{{6}}) ?{_OFFSET}|{_OFFSET})?| ?{_OFFSET})?| ?{_OFFSET})?"
    r")?$"
)
_MINUTES_ONLY = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(?= ?[Z+-])"
_PLAIN_SHAPE = "0000-00-00T00:00:00"
_SPACE_BEFORE_OFFSET = r" (?=(?:Z|[+-][\d:.]+)$)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column) -> Column:
    """True when the text is empty or whitespace only (Unicode aware).  A text that
    begins with a printing ASCII character is told without the pattern."""
    t = col_(c)
    return F.when(F.ascii(t).between(0x21, 0x7E), F.lit(False)).otherwise(t.rlike(BLANK_PATTERN))


def iso_utc(text: str | Column) -> Column:
    """TIMESTAMP_NTZ in UTC of an ISO-8601 text of the accepted shapes, NULL otherwise
    (also for impossible dates or times, offsets over 18 hours, and results outside
    years 1 to 9999).  A text without an offset is taken as UTC, as the session zone
    is UTC (``session.REQUIRED_CONF``).  Fractions beyond microseconds are truncated."""
    t = col_(text)
    # the common shape needs no pattern; the cast refuses year 0 only beyond it
    plain = (F.translate(t, "123456789", "000000000") == F.lit(_PLAIN_SHAPE)) & ~t.startswith("0000")
    # the cast wants seconds before an offset, and no space there
    full = F.regexp_replace(F.regexp_replace(t, _MINUTES_ONLY, "$1:00"), _SPACE_BEFORE_OFFSET, "")
    utc = full.try_cast("timestamp").cast("timestamp_ntz")
    other = F.when(t.rlike(ISO_TIMESTAMP_PATTERN), utc)
    return F.when(plain, t.try_cast("timestamp_ntz")).when(F.year(other).between(1, 9999), other)


def hour_band(ts: str | Column) -> Column:
    """Hour band 0-23 of a timestamp, as BIGINT (as stored in gold)."""
    return F.hour(col_(ts)).cast("long")


def event_date(ts: str | Column) -> Column:
    return col_(ts).cast("date")


def round2(x: str | Column) -> Column:
    """``ROUND(x, 2)`` on doubles computed as round(x*100)/100 so that halves are
    decided on the binary value (1.005 -> 1.0), like SQL engines that round the
    scaled double."""
    return F.round(col_(x) * F.lit(100.0), 0) / F.lit(100.0)


def rating_pct(audiencia: str | Column, universo: str | Column) -> Column:
    """Rating% = audience * 100 / universe; 0.0 when the universe is 0."""
    a, u = col_(audiencia), col_(universo)
    return F.when(u > 0, a.cast("double") * F.lit(100.0) / u.cast("double")).otherwise(F.lit(0.0))


def share_pct(audiencia: str | Column, total: str | Column) -> Column:
    """Share% = channel audience * 100 / band audience; NULL for a dark band."""
    a, t = col_(audiencia), col_(total)
    return F.when(t > 0, a.cast("double") * F.lit(100.0) / t.cast("double"))


def audit_time(value) -> Column:
    """The caller's run time as a TIMESTAMP_NTZ literal (NULL when absent).  Goes
    through ISO text so the wall clock is kept exactly, whatever the time zones of
    the Python process and the session."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    if hasattr(value, "isoformat"):
        value = value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def channel_list(text: str | Column) -> Column:
    """Parse ``"A, B,"`` into ``["A", "B"]``: split on commas, trim, drop empties
    and repeated names (first occurrence kept)."""
    parts = F.transform(F.split(col_(text), ","), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != F.lit("")))


def parse_channel_list(text: str | None) -> list[str] | None:
    """Driver-side twin of :func:`channel_list` for a command-line argument."""
    if text is None:
        return None
    return unique([p.strip() for p in text.split(",") if p.strip()])


def unique(values: Iterable[str]) -> list[str]:
    seen: dict[str, None] = {}
    for v in values:
        seen.setdefault(v, None)
    return list(seen)
