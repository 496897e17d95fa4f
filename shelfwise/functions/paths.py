"""Folder names for dates and date ranges."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class FolderNames(NamedTuple):
    """Date patterns of the year, month and day folders."""

    year: str
    month: str
    day: str


KEYED_FORMATS = FolderNames("'yy='yyyy", "'mm='MM", "'dd='dd")
PLAIN_FORMATS = FolderNames("yyyy", "MM", "dd")


def make_path(base: str, *more: str) -> str:
    """Join path parts with single slashes."""
    path = base
    for part in more:
        path = f"{path.removesuffix('/')}/{part.removeprefix('/')}"
    return path


def format_path(name: str, date: dt.date) -> str:
    """Fill year, month and day into a printf-style name; other names stay as they are."""
    return name % (date.year, date.month, date.day) if "%" in name else name


def cloud_path_parts(c: Column | str) -> list[Column]:
    """Container, account and prefix of a ``wasb(s)`` path; null when it is not one."""
    path = F.col(c) if isinstance(c, str) else c
    # The account is the first label of the host; neither part can hold a slash or an at sign.
    shape = r"^wasbs?://(?<box>[^@/]+)@(?<owner>[^@/.]+)\.blob\.core\.windows\.net/(?<rest>.*)$"
    return [
        F.when(path.rlike(shape), F.regexp_extract(path, shape, i)).alias(name)
        for i, name in enumerate(("container", "account", "prefix"), start=1)
    ]


def _folder(base: str, date: Column, formats: FolderNames, day: bool) -> Column:
    names = formats if day else formats[:2]
    folder = F.concat(F.lit(base.removesuffix("/") + "/"), F.date_format(date, "/".join(names)))
    return folder if day else F.concat(folder, F.lit("/*"))


def _ordered_dates(from_ms: Column, to_ms: Column) -> tuple[Column, Column]:
    day = lambda ms: F.to_date(F.timestamp_millis(ms))
    return day(F.least(from_ms, to_ms)), day(F.greatest(from_ms, to_ms))


def day_paths(base: str, from_ms: Column, to_ms: Column, formats: FolderNames = KEYED_FORMATS) -> Column:
    """Folders covering a time range, both ends included.

    The first and the last month are listed day by day, every month strictly
    between them as one ``*`` folder. Swapped bounds are put in order.
    """
    first, last = _ordered_dates(from_ms, to_ms)
    first_month, last_month = F.trunc(first, "month"), F.trunc(last, "month")
    inner_first, inner_last = F.add_months(first_month, 1), F.add_months(last_month, -1)
    no_dates = F.array().cast("array<date>")
    months = F.when(inner_first <= inner_last, F.sequence(inner_first, inner_last, F.expr("interval 1 month")))
    days = lambda dates: F.transform(dates, lambda d: _folder(base, d, formats, day=True))
    whole = F.transform(F.coalesce(months, no_dates), lambda d: _folder(base, d, formats, day=False))
    return F.when(first_month == last_month, days(F.sequence(first, last))).otherwise(
        F.concat(days(F.sequence(first, F.last_day(first))), whole, days(F.sequence(last_month, last))))


def month_paths(base: str, from_ms: Column, to_ms: Column, formats: FolderNames = KEYED_FORMATS) -> Column:
    """One ``*`` folder per month touched by a time range."""
    first, last = _ordered_dates(from_ms, to_ms)
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return F.transform(months, lambda d: _folder(base, d, formats, day=False))


def month_globs(prefix: str, today: dt.date, months: int, suffix: str = "dd=*/") -> list[str]:
    """Globs of the current month and of the ``months`` months before it."""
    return [
        f"{prefix}yy={y:04d}/mm={m:02d}/{suffix}" for y, m in months_back(today, months)
    ]


def months_back(today: dt.date, months: int) -> list[tuple[int, int]]:
    """(year, month) of the current month and of the ``months`` months before it."""
    index = today.year * 12 + today.month - 1
    return [((index - i) // 12, (index - i) % 12 + 1) for i in range(months + 1)]


def days_back(end: dt.date, days: int) -> list[dt.date]:
    """``end`` and the days before it, ``days`` in all."""
    return [end - dt.timedelta(days=i) for i in range(days)]
