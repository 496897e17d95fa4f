"""Conversions between date text, epoch milliseconds (UTC) and path parts.

Everything is a Column expression. Date patterns are parsed with an explicit
``Z`` appended, so parsing does not depend on the session time zone; formatting
uses the session zone, which every job here sets to UTC.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"

# Pattern of each date part a table can be partitioned by.
DATE_PARTS = {"yy": "yyyy", "mm": "MM", "dd": "dd", "hh": "HH", "mn": "mm"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parse_millis(text: Column, fmt: str) -> Column:
    """Epoch ms of ``text`` read as UTC wall-clock time, null when it does not fit.

    An offset in the text only has to be well formed: the local date and time
    are what count.
    """
    if fmt.endswith("X"):
        utc = F.regexp_replace(text, r"(?:Z|[+-]\d{2}(?:\d{2})?)$", "Z")
        return F.unix_millis(F.try_to_timestamp(utc, F.lit(fmt)))
    return F.unix_millis(F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(fmt + "X")))


def iso_to_millis(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (blank or ``T``) to epoch ms; any fraction is cut off."""
    text = F.regexp_replace(F.trim(F.regexp_replace(_col(c), r"\..*$", "")), " ", "T")
    return _parse_millis(text, ISO_SECONDS)


def utc_millis(c: Column | str, formats: str | Sequence[str], strict: bool = False) -> Column:
    """Date text to epoch ms.

    A single pattern keeps its milliseconds and never fails unless ``strict``.
    A list of patterns first tries the ISO form (whole seconds), then each
    pattern, and fails on text that fits none; blank text is null unless
    ``strict``. Text that is already a number passes through in every form.
    """
    raw = _col(c)
    text = F.trim(raw)
    number = raw.try_cast("bigint")
    if isinstance(formats, str):
        millis = F.coalesce(_parse_millis(text, formats), number)
        if not strict:
            return millis
        message = F.concat(F.lit("not a date: "), F.coalesce(raw, F.lit("null")))
        return F.coalesce(millis, F.raise_error(message).cast("bigint"))

    tries = [iso_to_millis(raw), *(_parse_millis(text, f) for f in formats), number]
    message = F.concat(F.lit("no known form of a date: "), F.coalesce(raw, F.lit("null")), F.lit(f"; known: {', '.join(formats)}"))
    millis = F.coalesce(*tries, F.raise_error(message).cast("bigint"))
    return millis if strict else F.when(raw.isNotNull() & (raw != ""), millis)


def millis_to_text(c: Column | str, fmt: str = ISO_SECONDS) -> Column:
    """Epoch ms to date text."""
    return F.date_format(F.timestamp_millis(_col(c)), fmt)


def date_path(c: Column | str) -> Column:
    """ISO date-time text to ``yyyy/MM/dd``; null when it is not one."""
    ts = F.try_to_timestamp(_col(c))
    return F.when(_col(c).rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"), F.date_format(ts, "yyyy/MM/dd"))


def is_valid_date(c: Column | str) -> Column:
    """Whether the text is an ISO-8601 date or date-time (``T`` between them, no blanks)."""
    return F.try_to_timestamp(_col(c)).isNotNull() & ~F.coalesce(_col(c).rlike(r"\s"), F.lit(True))


def reformat_date(c: Column | str, source: str, target: str) -> Column:
    """Date text from one pattern to another; null when it does not fit."""
    return F.date_format(F.try_to_timestamp(_col(c), F.lit(source)), target)


def safe_int(c: Column | str, default: int = -1) -> Column:
    """Text to int, ``default`` when it is not one."""
    return F.coalesce(_col(c).try_cast("int"), F.lit(default))


def date_part(c: Column | str, part: str) -> Column:
    """Zero-padded text of one date part (``yy``, ``mm``, ``dd``, ``hh``, ``mn``)."""
    if part not in DATE_PARTS:
        raise ValueError(f"unknown date part {part!r}, expected one of {sorted(DATE_PARTS)}")
    return F.date_format(_col(c), DATE_PARTS[part])
