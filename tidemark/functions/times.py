"""Month names and numbers, and timestamps written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of the log files.
LOG_TIME_PATTERN = "yyyy-M-d HH:mm:ss"
MONTH_NAME_PATTERN = "MMMM"
SERVER_TIME_PATTERN = "MMM d HH:mm:ss z yyyy"


def parse_log_time(text: Column, pattern: str = LOG_TIME_PATTERN, strict: bool = True) -> Column:
    """Timestamp from text; text that does not fit raises, or gives null if not ``strict``."""
    if strict:
        return F.to_timestamp(text, pattern)
    return F.try_to_timestamp(text, F.lit(pattern))


def parse_server_time(text: Column) -> Column:
    """Timestamp from text such as ``Tue Mar 05 16:24:07 GMT 2019``, or null.

    Spark does not parse names of weekdays, and the date does not need them.
    """
    return F.try_to_timestamp(F.substring(F.trim(text), 5, 100), F.lit(SERVER_TIME_PATTERN))


def month_name(month: Column) -> Column:
    """Month name (``April``) of a month number."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), MONTH_NAME_PATTERN)


def month_number(name: Column) -> Column:
    """Month number (4) of a month name."""
    return F.month(F.to_date(F.concat(F.lit("2000 1 "), name), f"yyyy d {MONTH_NAME_PATTERN}"))
