"""Loaders of the retail feeds from delimited text and from parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.times import utc_millis
from . import schemas

NULL_TEXT = r"\N"


@dataclass(frozen=True)
class DateRule:
    """Date columns that share patterns; ``strict`` ones must hold a date in every row."""

    columns: tuple[str, ...]
    formats: str | tuple[str, ...]
    strict: bool = False


@dataclass(frozen=True)
class Feed:
    """A named feed: its schema, its date columns, and whether parquet files still hold date text."""

    name: str
    schema: StructType
    dates: tuple[DateRule, ...] = ()
    parquet_dates: bool = False
    options: Mapping[str, str] = field(default_factory=dict)


# Accepted date patterns per feed. Patterns come after the ISO
# form with whole seconds, which every list accepts first.
FEEDS: dict[str, Feed] = {
    feed.name: feed
    for feed in (
        Feed("customer", schemas.CUSTOMER,
             (DateRule(("dateEntered", "dateModified"), "yyyy-MM-dd'T'HH:mm:ss.SSSX"),),
             parquet_dates=True),
        Feed("product", schemas.PRODUCT,
             (DateRule(("dateOnSite", "dateModified"),
                       ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss.SS")),)),
        Feed("variant", schemas.VARIANT,
             (DateRule(("dateModified",), ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS")),)),
        Feed("receipt", schemas.RECEIPT,
             (DateRule(("dateEntered", "dateModified"), ("yyyy-MM-dd HH:mm:ss",), strict=True),),
             parquet_dates=True),
        Feed("return", schemas.RETURN,
             (DateRule(("returnsDateKey", "receiptDateKey"), ("yyyy-MM-dd HH:mm:ss",), strict=True),
              DateRule(("dateEntered", "dateModified"), ("yyyy-MM-dd HH:mm:ss",))),
             parquet_dates=True),
        Feed("signals", schemas.SIGNAL,
             (DateRule(("signalDate", "dateModified"), ("yyyy-MM-dd'T'HH:mm:ss",), strict=True),)),
    )
}


def with_millis(df: DataFrame, feed: Feed) -> DataFrame:
    """Turn the feed's date text columns into epoch ms, in place."""
    changed = {
        name: utc_millis(F.col(name).cast("string"), _formats(rule), rule.strict)
        for rule in feed.dates for name in rule.columns
    }
    return df.withColumns(changed) if changed else df


def _formats(rule: DateRule) -> str | list[str]:
    return rule.formats if isinstance(rule.formats, str) else list(rule.formats)


def parse_text(lines: DataFrame, feed: str | Feed, delimiter: str, column: str = "value") -> DataFrame:
    """Lines of a feed, wherever they come from, with the schema, options and dates that files are read with."""
    spec = FEEDS[feed] if isinstance(feed, str) else feed
    options = {"sep": delimiter, "nullValue": NULL_TEXT, **spec.options}
    row = F.from_csv(F.col(column), F.lit(spec.schema.toDDL()), options)
    return with_millis(lines.select(F.inline(F.array(row))), spec)


def load_text(
    spark: SparkSession, feed: str | Feed, paths: str | Sequence[str], delimiter: str,
    options: Mapping[str, str] | None = None, raw: bool = False, num_partitions: int | None = None,
) -> DataFrame:
    """Read a feed from delimited text without a header; ``\\N`` is null.

    ``raw`` leaves date text as it is; ``num_partitions`` spreads the rows over
    that many partitions.
    """
    spec = FEEDS[feed] if isinstance(feed, str) else feed
    reader = spark.read.options(sep=delimiter, header="false", nullValue=NULL_TEXT, **spec.options)
    df = reader.options(**(options or {})).schema(spec.schema).csv(_paths(paths))
    if num_partitions:
        df = df.repartition(num_partitions)
    return df if raw else with_millis(df, spec)


def load_parquet(spark: SparkSession, feed: str | Feed, paths: str | Sequence[str]) -> DataFrame:
    """Read a feed from parquet; columns bind by name."""
    spec = FEEDS[feed] if isinstance(feed, str) else feed
    df = spark.read.parquet(*_paths(paths))
    return with_millis(df, spec) if spec.parquet_dates else df


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)
