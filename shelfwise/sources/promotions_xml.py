"""Promotion documents from XML files and existing promotions from JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Element names of the promotion export. Numbers are read as text
# and cast, since empty elements are common.
DOCUMENT = """
    PromotionOverview struct<
        PromotionID: string, StartDate: string, EndDate: string, PromotionType: string,
        PromotionShortDescription: string, PromotionLongDescription: string>,
    ProductSets struct<ProductSet: array<struct<
        LowerBuyQuantity: string, UpperBuyQuantity: string, GetQuantity: string, RewardOption: string,
        RewardValue: struct<_VALUE: string, _CountryCode: string, _CurrencyCode: string, _DiscountType: string>,
        BuyAll: string,
        Products: struct<ProductCode: array<struct<_VALUE: string, _Seq: string, _TransactionType: string>>>>>>,
    BasketRewardRules struct<RewardType: string, RewardOption: string, RewardValue: string>
"""

# Members of a stored promotion. The expression tree is recursive
# and stays text.
EXISTING = """
    lastUpdated bigint, created bigint,
    stackingRules struct<stackingRule: struct<type: string>, promotionPriority: int>,
    descriptor struct<id: string, name: string, description: string, expression: string>,
    dateRange struct<`from`: string, `to`: string>,
    valueOrder string,
    promotionExpression string
"""


def _text(c: Column | str) -> Column:
    return F.nullif(F.trim(F.regexp_replace(c, r"^\s+|\s+$", "")), F.lit(""))


def parse_promotions(documents: DataFrame, column: str = "value") -> DataFrame:
    """Texts of one <Promotion> element each: see :func:`shape_promotions`."""
    return shape_promotions(documents.select(F.inline(F.array(F.from_xml(F.col(column), DOCUMENT)))))


def load_promotions_xml(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Promotion documents of XML files: see :func:`shape_promotions`."""
    files = ",".join([paths] if isinstance(paths, str) else paths)
    return shape_promotions(spark.read.format("xml").option("rowTag", "Promotion").schema(DOCUMENT).load(files))


def _unreadable(raw: Column, value: Column, name: str) -> Column:
    """What to say about a text that is there but is not a value of its kind; null otherwise."""
    return F.when(raw.isNotNull() & value.isNull(), F.concat(F.lit(f"unreadable {name} "), raw))


def shape_promotions(raw: DataFrame) -> DataFrame:
    """Read elements to promoId, description, dates, product sets, basket reward and ``problems``: one text for each
    value that cannot be read, and for a missing id."""
    overview, basket = F.col("PromotionOverview"), F.col("BasketRewardRules")
    day = lambda c: F.try_to_timestamp(_text(c), F.lit("dd/MM/yyyy"))
    numbers = (("LowerBuyQuantity", "int"), ("GetQuantity", "int"))
    product_set = lambda s: F.struct(
        _text(s["LowerBuyQuantity"]).try_cast("int").alias("lowerBuy"),
        _text(s["GetQuantity"]).try_cast("int").alias("getQty"),
        _text(s["RewardOption"]).alias("reward"),
        _text(s["RewardValue"]["_VALUE"]).try_cast("double").alias("value"),
        F.transform(F.coalesce(s["Products"]["ProductCode"], F.array()), lambda p: _text(p["_VALUE"])).alias("products"))
    set_problems = lambda s: F.array(
        *(_unreadable(_text(s[name]), _text(s[name]).try_cast(kind), name) for name, kind in numbers),
        _unreadable(_text(s["RewardValue"]["_VALUE"]), _text(s["RewardValue"]["_VALUE"]).try_cast("double"), "RewardValue"))
    sets = F.coalesce("ProductSets.ProductSet", F.array())
    value = _text(basket["RewardValue"])
    problems = F.concat(
        F.array(F.when(_text(overview["PromotionID"]).isNull(), F.lit("promotion without id")),
                *(_unreadable(_text(overview[d]), day(overview[d]), d) for d in ("StartDate", "EndDate")),
                _unreadable(value, value.try_cast("double"), "basket RewardValue")),
        F.flatten(F.transform(sets, set_problems)))
    return raw.select(
        _text(overview["PromotionID"]).alias("promoId"),
        _text(overview["PromotionLongDescription"]).alias("description"),
        day(overview["StartDate"]).alias("startDate"), day(overview["EndDate"]).alias("endDate"),
        F.transform(sets, product_set).alias("productSets"),
        F.struct(_text(basket["RewardOption"]).alias("rewardOption"), value.try_cast("double").alias("rewardValue")).alias("basket"),
        F.array_compact(problems).alias("problems"))


def load_existing_promotions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Stored promotions with the columns that decide whether a new one is equivalent."""
    raw = spark.read.schema(EXISTING).option("multiLine", "true").json(paths)
    return raw.select(
        F.col("descriptor.name").alias("name"), F.col("descriptor.description").alias("description"),
        F.col("descriptor.expression").alias("expression"),
        F.try_to_timestamp(F.col("dateRange.from")).alias("startDate"),
        F.try_to_timestamp(F.col("dateRange.to")).alias("endDate"),
        F.col("stackingRules.stackingRule.type").alias("stackingRule"),
        F.col("stackingRules.promotionPriority").alias("priority"),
        "valueOrder", "promotionExpression", "created")
