"""Time parsing, display and bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import ARCHIVE_BUCKET_MS

# Formats of the post timestamp. The weekday is skipped when
# parsing because it carries no information.
CREATED_AT_PARTS = r"^\s*\S+\s+([A-Za-z]{3})[A-Za-z]*\s+(\d{1,4})\s+(\d{1,4}):(\d{1,4}):(\d{1,4})\s+([+-]\d{4})\s+(\d{4})"
CREATED_AT_WRITE = "EEE MMM dd HH:mm:ss +0000 yyyy"
DISPLAY_FORMAT = "MMMM dd yyyy, HH:mm:ss.SSS"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_created_at(s: str | Column) -> Column:
    """``Tue Oct 22 20:33:43 +0000 2019`` -> epoch milliseconds (NULL if unparsable).

    Lenient: one-digit days are fine and numbers beyond their range roll over
    (``Oct 32`` is November 1, ``25:00:00`` one o'clock the next day).
    """
    def part(k: int) -> Column:
        return F.regexp_extract(_c(s), CREATED_AT_PARTS, k)

    start = F.try_to_timestamp(F.concat_ws(" ", F.initcap(part(1)), F.lit("01 00:00:00"), part(6), part(7)), F.lit("MMM dd HH:mm:ss Z yyyy"))
    day, hour, minute, second = (part(k).try_cast("bigint") for k in (2, 3, 4, 5))
    return F.unix_millis(start) + ((day - 1) * 86_400 + hour * 3_600 + minute * 60 + second) * 1_000


def format_created_at(ts: str | Column) -> Column:
    """Timestamp -> the post's ``created_at`` text (UTC)."""
    return F.date_format(_c(ts), CREATED_AT_WRITE)


def display_time(ms: str | Column) -> Column:
    """Epoch ms -> ``October 22 2019, 20:33:43.000`` (session zone, UTC)."""
    return F.date_format(F.timestamp_millis(_c(ms)), DISPLAY_FORMAT)


def event_time(ms: str | Column) -> Column:
    """Epoch ms -> TIMESTAMP, usable by windows and watermarks."""
    return F.timestamp_millis(_c(ms))


def bucket_ms(ms: str | Column, width_ms: int = ARCHIVE_BUCKET_MS) -> Column:
    """Epoch ms truncated to a multiple of ``width_ms`` (archive directory key).

    ``%`` keeps the sign of the dividend, so this truncates toward zero like
    integer division does.
    """
    m = _c(ms).cast("bigint")
    return m - (m % F.lit(int(width_ms)).cast("bigint"))
