"""Date-part columns, in-place column changes and look-back slices."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DataParseError
from ..functions.times import date_part, millis_to_text, reformat_date

DAY_MS = 24 * 60 * 60 * 1000


def add_date_parts(df: DataFrame, column: str, parts: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Add zero-padded text columns for parts of a date, timestamp or date-text column."""
    native = df.schema[column].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
    date = F.col(column) if native else F.try_to_timestamp(F.col(column), F.lit(fmt))
    return df.withColumns({part: date_part(date, part) for part in parts})


def partition_by_date(df: DataFrame, column: str) -> tuple[list[str], DataFrame]:
    """Year, month and day columns cut out of ISO date text; returns their names too."""
    return ["yy", "mm", "dd"], df.withColumns(_iso_parts(F.col(column)))


def partition_by_millis(df: DataFrame, column: str) -> tuple[list[str], DataFrame]:
    """Year, month and day columns of an epoch-ms column; returns their names too."""
    return ["yy", "mm", "dd"], df.withColumns(_iso_parts(millis_to_text(column)))


def _iso_parts(text: Column) -> dict[str, Column]:
    return {"yy": F.substring(text, 1, 4), "mm": F.substring(text, 6, 2), "dd": F.substring(text, 9, 2)}


def transform_columns(df: DataFrame, change: Callable[[str], Column], columns: Sequence[str]) -> DataFrame:
    """Apply one function to several columns, in place."""
    return df.withColumns({c: change(c) for c in columns})


def transform_date_formats(df: DataFrame, columns: Sequence[str], source: str, target: str) -> DataFrame:
    """Rewrite date text of several columns from one pattern to another."""
    return transform_columns(df, lambda c: reformat_date(c, source, target), columns)


class Slice(NamedTuple):
    """A named look-back window, ``from_ms`` included and ``to_ms`` excluded."""

    name: str
    labels: str
    from_ms: int
    to_ms: int


def time_slices(start_ms: int, spec: str) -> list[Slice]:
    """Parse ``name[:labels]:first:last,...``: from ``last`` to ``first`` days before the start."""
    slices = []
    for entry in spec.split(","):
        parts = entry.split(":")
        if len(parts) not in (3, 4):
            raise DataParseError(f"unsupported slice {entry!r} in {spec!r}")
        first, last = int(parts[-2]), int(parts[-1])
        labels = parts[1] if len(parts) == 4 else ""
        slices.append(Slice(parts[0], labels, start_ms - last * DAY_MS, start_ms - first * DAY_MS))
    return slices


def assign_slices(df: DataFrame, millis: str, slices: Sequence[Slice]) -> DataFrame:
    """One output row per (row, slice) where the slice covers the row's time.

    The slices are a short list from the job's settings, so they go into the
    expression itself: no join, no shuffle.
    """
    hit = lambda s: F.when(
        (F.col(millis) >= s.from_ms) & (F.col(millis) < s.to_ms),
        F.struct(F.lit(s.name).alias("sliceName"), F.lit(s.labels).alias("sliceLabels")))
    hits = F.array_compact(F.array(*(hit(s) for s in slices)))
    return df.select("*", F.inline(hits))
