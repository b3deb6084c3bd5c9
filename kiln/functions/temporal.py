"""Tolerant timestamp parsing and compact-date normalisation.

All functions return ``Column`` expressions, so they stay inside whole-stage
codegen and are pushed around by Catalyst like any built-in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats used by the reference's data.
DATE_FORMAT = "MM/dd/yyyy"
DATETIME_12H_FORMAT = "MM/dd/yyyy hh:mm:ss a"
COMPACT_FORMAT = "MMddHHmm"
COMPACT_WIDTH = 8
COMPACT_YEAR = "2010"
COMPACT_WITH_YEAR_FORMAT = "yyyyMMddHHmm"


def parse_timestamp(text: Column | str, fmt: str) -> Column:
    """Text to a wall-clock timestamp (``timestamp_ntz``); bad text gives NULL.

    ``try_to_timestamp`` parses in the session zone and the cast back to
    ``timestamp_ntz`` uses the same zone, so the wall clock written in the
    text survives whatever ``spark.sql.session.timeZone`` is.
    """
    c = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def format_timestamp(ts: Column | str, fmt: str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, fmt)


def compact_date_text(date_value: Column | str) -> Column:
    """``MMddHHmm`` text from a value whose leading zero may be lost.

    CSV inference reads ``01010600`` as the integer 1010600; padding the text
    form back to eight characters restores it.  Longer input is cut to eight
    characters by ``lpad``.
    """
    c = F.col(date_value) if isinstance(date_value, str) else date_value
    return F.lpad(c.cast("string"), COMPACT_WIDTH, "0")


def compact_to_timestamp(date_value: Column | str, year: str = COMPACT_YEAR) -> Column:
    """``MMddHHmm`` (text or number) plus a fixed year -> ``timestamp_ntz``."""
    return parse_timestamp(F.concat(F.lit(year), compact_date_text(date_value)), COMPACT_WITH_YEAR_FORMAT)


def year_of(ts: Column | str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.year(c)


def month_from_text(text: Column | str) -> Column:
    """Leading two characters of a date text as an int month (NULL if not a number).

    The reference writes ``SUBSTRING(date, 0, 2)``; Spark treats position 0 as
    1, so this is ``substring(text, 1, 2)``.
    """
    c = F.col(text) if isinstance(text, str) else text
    return F.substring(c, 1, 2).try_cast("int")
