"""Text expressions: whitespace collapse (T3) and pack-size extraction (T9)."""

from pyspark.sql import Column, functions as F

from ..constants import PACK_SIZE_PATTERN, WHITESPACE_RUN_JAVA


def collapse_whitespace(c: Column) -> Column:
    """Each run of whitespace becomes one space; the ends are not trimmed.

    Null stays null.  Runs on the whole text inside generated code.
    """
    return F.regexp_replace(c, WHITESPACE_RUN_JAVA, " ")


def pack_size_text(subtitle: Column) -> Column:
    """The matched pack-size text ('' when nothing matches, null for null)."""
    return F.regexp_extract(subtitle, PACK_SIZE_PATTERN, 0)


def pack_size(subtitle: Column) -> Column:
    """Pack size as DOUBLE; text that does not parse ('' or '0,75') is null.

    Casting trims the space the pattern captures, so ' 750' and '750 ' read.
    """
    return pack_size_text(subtitle).try_cast("double")
