"""Readers that drop malformed rows instead of failing, used to build training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import is_valid_date, iso_to_millis, safe_int
from ..operators.signals import valid_signals
from .feeds import FEEDS, load_text


def split_fields(lines: DataFrame, separator: str, fields: dict[str, int], column: str = "value") -> DataFrame:
    """Named fields of delimited lines, null where a line is too short.

    The generator keeps Spark from splitting a line again for every use of a field.
    """
    parts = lines.select(F.split(F.col(column), separator).alias("parts"))
    row = F.struct(*(F.get("parts", F.lit(i)).alias(name) for name, i in fields.items()))
    return parts.select(F.inline(F.array(row)))


# Positions of the fields that training reads.
SIGNAL_FIELDS = {"customerId": 0, "productId": 1, "sourceId": 4, "signalDate": 6, "useForRecs": 10}


def parse_signals(lines: DataFrame, column: str = "value") -> DataFrame:
    """``|``-separated signal lines to valid (customerId, productId, sourceId, signalDate, useForRecs) rows.

    Fields 0, 1, 4, 6 and 10 are read. Rows whose ids or source are not numbers,
    whose source has no weight, or whose date is not ISO-8601 are dropped.
    """
    fields = split_fields(lines, r"\|", SIGNAL_FIELDS, column)
    rows = fields.withColumns({c: safe_int(c) for c in SIGNAL_FIELDS if c != "signalDate"})
    return valid_signals(rows).filter(is_valid_date("signalDate"))


def parse_customers(lines: DataFrame, column: str = "value") -> DataFrame:
    """Tab-separated customer lines to customerId; lines without exactly 8 fields are dropped.

    Blank fields at the end of a line do not count as fields.
    """
    eight = F.col(column).rlike(r"^(?:[^\t]*\t){7}[^\t]+\t*$")
    ids = lines.filter(eight).select(safe_int(F.substring_index(column, "\t", 1)).alias("customerId"))
    return ids.filter("customerId <> -1")


def training_customers(spark: SparkSession, path: str) -> DataFrame:
    """Ids of the customers to train on."""
    return parse_customers(spark.read.text(path)).distinct()


def known_products(spark: SparkSession, path: str) -> DataFrame:
    """Product feed without its malformed rows; one row per product comes from ``latest_products``.

    Dates become epoch ms, or null when they cannot be read.
    """
    products = load_text(spark, FEEDS["product"], path, "|", {"mode": "DROPMALFORMED"}, raw=True)
    millis = lambda c: F.coalesce(iso_to_millis(c), F.col(c).try_cast("bigint"))
    dated = products.withColumns({c: millis(c) for c in ("dateOnSite", "dateModified")})
    return dated.filter(F.col("productId").isNotNull() & (F.col("productId") != -1))


def parse_flags(lines: DataFrame, column: str = "value") -> DataFrame:
    """``productId<TAB>flag`` lines to the ids of recommendable products (flag 1)."""
    fields = split_fields(lines, "\t", {"productId": 0, "isRecommended": 1}, column)
    rows = fields.withColumns({c: F.col(c).try_cast("int") for c in fields.columns})
    return rows.filter("productId is not null and isRecommended = 1").select("productId").distinct()


def recommendable_products(spark: SparkSession, path: str) -> DataFrame:
    """Ids of the products flagged as recommendable."""
    return parse_flags(spark.read.text(path))


def signal_lines(spark: SparkSession, paths: list[str], line_sep: str | None = None) -> DataFrame:
    """Signal lines of text files or globs; product-view files end their lines with CR."""
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    return reader.text(paths).select(F.regexp_replace("value", "^﻿", "").alias("value"))
