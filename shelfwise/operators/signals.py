"""Customer signals: weights, validity, ratings and the best signal per product."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import millis_to_text


def rating_of(source: Column | str) -> Column:
    """Weight of a signal source: 1 is a purchase, 2 to 6 are intents, 7 is a view, others count nothing."""
    source = F.col(source) if isinstance(source, str) else source
    weight = (F.when(source == 1, 3.0).when(source.between(2, 6), 2.0).when(source == 7, 1.0).otherwise(0.0))
    return weight.cast("float")


def valid_signals(signals: DataFrame) -> DataFrame:
    """Signals with ids and a date and a source that has a weight of at least 1; adds ``rating``."""
    rated = signals.withColumn("rating", rating_of("sourceId"))
    known = [(F.col(c).isNotNull() & (F.col(c) != -1)) for c in ("customerId", "productId", "sourceId")]
    return rated.filter(known[0] & known[1] & known[2] & (F.col("rating") >= 1) & F.col("signalDate").isNotNull())


def signal_ratings(valid: DataFrame) -> DataFrame:
    """Highest rating per customer and product."""
    return valid.groupBy("customerId", "productId").agg(F.max("rating").alias("rating"))


def training_ratings(valid: DataFrame, customers: DataFrame, products: DataFrame,
                     recommendable_only: bool = False) -> DataFrame:
    """Ratings of training customers for known products.

    Signals are reduced to one row per pair before the membership joins, so a
    customer or product with very many signals reaches a join with few rows.
    ``recommendable_only`` keeps signals flagged ``useForRecs`` = 1.
    """
    if recommendable_only:
        valid = valid.filter("useForRecs = 1")
    return keep_known(signal_ratings(valid), customers, products)


def keep_known(ratings: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Ratings of the given customers for the given products."""
    known = ratings.join(products.select("productId"), "productId", "left_semi")
    kept = known.join(customers.select("customerId"), "customerId", "left_semi")
    return kept.select("customerId", "productId", "rating")


def latest_per_source(signals: DataFrame) -> DataFrame:
    """Latest signal per customer, product and source.

    Holds the best signal of every customer and product, and is a plain hash
    aggregate that Spark also runs before the shuffle.
    """
    return signals.groupBy("customerId", "productId", "sourceId").agg(F.max("signalDate").alias("signalDate"))


def with_guid(signals: DataFrame, customers: DataFrame) -> DataFrame:
    """Signals with the external id of their customer; signals of unknown customers are dropped."""
    facts = signals.select("customerId", "productId", "sourceId", "signalDate")
    joined = facts.join(customers.select("customerId", "guid"), "customerId")
    return joined.select("customerId", "guid", "productId", "sourceId", "signalDate")


def prioritise(signals: DataFrame) -> DataFrame:
    """One signal per guid and product: lowest source, then latest date, then lowest customer; nulls come last.

    Three aggregates, each of which leaves one row per value that the next one goes by. All are hash aggregates
    over plain numbers that Spark also runs before the shuffle.
    """
    def of_best(column: str, by: str, best: Callable, pick: Callable) -> Column:
        """Value in the one row with the best ``by``, which is the one row without any if there is no other."""
        alone = F.max(F.when(F.col(by).isNull(), F.col(column)))
        return F.when(best(by).isNull(), alone).otherwise(pick(column, by)).alias(column)

    pair = ["guid", "productId"]
    single = signals.groupBy(*pair, "sourceId", "signalDate").agg(F.min("customerId").alias("customerId"))
    latest = single.groupBy(*pair, "sourceId").agg(
        of_best("customerId", "signalDate", F.max, F.max_by), F.max("signalDate").alias("signalDate"))
    return latest.groupBy(*pair).agg(
        of_best("customerId", "sourceId", F.min, F.min_by), of_best("signalDate", "sourceId", F.min, F.min_by),
        F.min("sourceId").alias("sourceId")).select("customerId", *pair, "sourceId", "signalDate")


def signal_output(signals: DataFrame) -> DataFrame:
    """Output shape of prioritised signals: ISO text for the date, no internal customer id."""
    return signals.select("guid", "productId", "sourceId", millis_to_text("signalDate").alias("signalDate"))


def priority_signals(signals: DataFrame, customers: DataFrame) -> DataFrame:
    """Prioritised signals of known customers.

    The signals shrink to one row per customer, product and source before they
    meet the customers, so hot customers do not make a hot join key.
    """
    return signal_output(prioritise(with_guid(latest_per_source(signals), customers)))
