"""Reading the part of a date-partitioned folder that a time range needs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import KEYED_FORMATS, PLAIN_FORMATS, FolderNames, day_paths, days_back, months_back
from .feeds import FEEDS, load_parquet, load_text


class NoDataError(FileNotFoundError):
    """No folder of the requested range exists."""


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths or globs that match at least one file or folder."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for text in paths:
        path = jvm.org.apache.hadoop.fs.Path(text)
        statuses = path.getFileSystem(conf).globStatus(path)
        if statuses is not None and len(statuses) > 0:
            found.append(text)
    return found


def range_paths(
    spark: SparkSession, base: str, from_ms: int, to_ms: int, formats: FolderNames = KEYED_FORMATS
) -> list[str]:
    """Existing folders of a time range; the list grows with the months, not with the data."""
    bounds = (F.lit(from_ms).cast("bigint"), F.lit(to_ms).cast("bigint"))
    wanted = spark.range(1).select(day_paths(base, *bounds, formats)).first()[0]
    found = existing_paths(spark, wanted)
    if not found:
        raise NoDataError(f"no data under {base} between {from_ms} and {to_ms}")
    return found


def _number(name: str) -> Column:
    return F.col(name).cast("int")


def _day_number() -> Column:
    return _number("yy") * 10000 + _number("mm") * 100 + _number("dd")


def _day_key(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _utc_day(ms: int) -> dt.date:
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).date()


def load_range(spark: SparkSession, base: str, from_ms: int, to_ms: int, feed: str | None = None,
               required: bool = False) -> DataFrame:
    """Parquet rows of ``yy=/mm=/dd=`` folders whose day lies in the range, both ends included.

    The predicate is on partition columns only, so Spark lists and reads just
    the folders it needs. With a ``feed`` its dates become epoch ms; ``required`` makes an empty range an error.
    """
    low, high = sorted((_utc_day(from_ms), _utc_day(to_ms)))
    rows = load_parquet(spark, feed, base) if feed else spark.read.parquet(base)
    rows = rows.filter(_day_number().between(_day_key(low), _day_key(high)))
    if required and rows.isEmpty():
        raise NoDataError(f"no rows under {base} from {low} to {high}")
    return rows


def load_range_paths(spark: SparkSession, base: str, from_ms: int, to_ms: int,
                     formats: FolderNames = KEYED_FORMATS) -> DataFrame:
    """Same rows through an explicit list of folders, for layouts without ``key=value`` names."""
    return spark.read.parquet(*range_paths(spark, base, from_ms, to_ms, formats))


def load_range_text(spark: SparkSession, feed: str, base: str, from_ms: int, to_ms: int,
                    delimiter: str) -> DataFrame:
    """A text feed stored in ``yyyy/MM/dd`` folders, over a time range."""
    return load_text(spark, FEEDS[feed], range_paths(spark, base, from_ms, to_ms, PLAIN_FORMATS), delimiter)


def in_months(today: dt.date, months: int) -> Column:
    """Predicate on partition columns: the current month and the ``months`` before it."""
    keys = [y * 100 + m for y, m in months_back(today, months)]
    return (_number("yy") * 100 + _number("mm")).isin(keys)


def in_last_days(end: dt.date, days: int) -> Column:
    """Predicate on partition columns: ``end`` and the days before it, ``days`` in all."""
    wanted = days_back(end, days)
    return _day_number().between(_day_key(wanted[-1]), _day_key(wanted[0]))


def load_last_days(spark: SparkSession, base: str, end: dt.date, days: int) -> DataFrame:
    """Parquet rows of the last ``days`` days up to ``end``."""
    return spark.read.parquet(base).filter(in_last_days(end, days))
