"""Product attributes: latest row per product and eligibility for recommendation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, key: str, modified: str) -> DataFrame:
    """One row per key: the last modified one; equal dates are settled by the other columns, in order. Nulls come last.

    Every task keeps one row of each of its keys before the shuffle, so a key with very many rows stays small.
    """
    order = [F.col(c).desc_nulls_last() for c in (modified, *(c for c in df.columns if c not in (key, modified)))]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def latest_products(products: DataFrame) -> DataFrame:
    """One row per product id, the last modified one."""
    return latest_rows(products, "productId", "dateModified")


def days_on_site(date_on_site: Column | str, today: Column | dt.date) -> Column:
    """Days between the day a product went on site and today."""
    return F.datediff(F.lit(today), F.to_date(date_on_site))


def eligible(max_days_on_site: int) -> Column:
    """Predicate on ``isExcluded``, ``daysOnSite`` and ``stockLevel``; unknown values are not eligible."""
    return (F.col("isExcluded") != 1) & (F.col("daysOnSite") <= max_days_on_site) & (F.col("stockLevel") > 0)


def eligible_items(products: DataFrame, recommendable: DataFrame, max_days_on_site: int) -> DataFrame:
    """Ids of the products that may be recommended."""
    good = products.filter(eligible(max_days_on_site)).select("productId")
    return good.join(recommendable.select("productId"), "productId", "left_semi")


def keep_items(factors: DataFrame, items: DataFrame) -> DataFrame:
    """Factors of the given products; factors of unknown products are dropped."""
    return factors.join(items.select(F.col("productId").alias("id")), "id", "left_semi")
