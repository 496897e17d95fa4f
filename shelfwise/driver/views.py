"""The given tables read as retail feeds."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.products import days_on_site
from ..operators.promotions import Flat
from ..session import spread, stored

TODAY = "2005-06-01"
VECTOR_RANK = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _millis(c) -> F.Column:
    return F.unix_millis(F.col(c).cast("timestamp"))


def event_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of users on products, from the event stream."""
    source = (F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "click", 2)
              .when(F.col("event_type") == "signup", 5).when(F.col("event_type") == "view", 7).otherwise(99))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customerId"),
        F.get_json_object("props", "$.k").cast("bigint").alias("productId"),
        source.alias("sourceId"), _millis("ts").alias("signalDate"))


def order_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of customers on parts, from order lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    flag = F.col("l_returnflag")
    source = F.when(flag == "N", 1).when(flag == "A", 2).when(flag == "R", 7).otherwise(99)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("customerId"), F.col("l_partkey").alias("productId"),
        source.alias("sourceId"), _millis("l_shipdate").alias("signalDate"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customerId"), F.md5("c_name").alias("guid"),
        F.when(F.col("c_nationkey") % 2 == 0, "female").otherwise("male").alias("gender"),
        F.col("c_acctbal").alias("balance"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_site = F.date_add(F.to_date(F.lit("2000-01-01")), F.pmod(F.col("p_partkey"), F.lit(2500)).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("productId"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("currentPrice"), (F.col("p_size") - 5).alias("stockLevel"),
        F.when(F.col("p_partkey") % 17 == 0, 1).otherwise(0).alias("isExcluded"),
        on_site.alias("dateOnSite"), days_on_site(on_site, F.to_date(F.lit(TODAY))).alias("daysOnSite"),
        F.when(F.col("p_partkey") % 5 != 0, 1).otherwise(0).alias("isRecommended"))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("factors"), "label")


def user_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's vector: the sum of the vectors of the parts they bought."""
    bought = order_signals(spark, sf_dir).select("customerId", "productId").distinct()
    items = item_vectors(spark, sf_dir).withColumnRenamed("id", "productId")
    sums = bought.join(items, "productId").groupBy("customerId").agg(
        Summarizer.sum(array_to_vector(F.col("factors").cast("array<double>"))).alias("total"))
    rounded = F.transform(vector_to_array("total"), lambda v: F.round(v, 4).cast("float"))
    return sums.select(F.col("customerId").alias("id"), rounded.alias("factors"))


def promotions(spark: SparkSession, sf_dir: str) -> Flat:
    """Promotions of orders (short product lists) and of suppliers (long ones), from order lines.

    The lines are read twice: once for the sets, which are stored and of which the promotions are made, and once for the
    products, which are stored too as every operator on them needs them several times.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate")
    promo_ids = F.array(F.concat(F.lit("O"), F.col("l_orderkey")), F.concat(F.lit("S"), F.col("l_suppkey")))
    rows = spread(lines).select("*", F.explode(promo_ids).alias("promoId"), (F.col("l_linenumber") % 3).alias("position"))
    parts = rows.groupBy("promoId", "position").agg(
        F.max("l_partkey").alias("highest"), F.min("l_partkey").alias("lowest"), F.max("l_quantity").alias("quantity"),
        F.max("l_linenumber").alias("line"), F.max("l_discount").alias("discount"),
        F.min("l_shipdate").alias("startDate"), F.max("l_shipdate").alias("endDate"))
    parts = stored(parts.withColumn("docId", F.col("promoId")), "promotion-sets")
    highest, position = F.col("highest"), F.col("position")
    option = (F.when(highest % 97 == 0, "Free Gift").when((highest + position) % 5 < 2, "No Discount")
              .when((highest + position) % 5 == 2, "Set Price")
              .when((highest + position) % 5 == 3, "Money Off").otherwise("Percentage Off"))
    value = F.when(highest % 11 != 0, F.round(F.col("discount") * 100, 0))
    sets = parts.select("docId", "promoId", "position", (F.col("quantity").cast("int") % 4).alias("lowerBuy"),
                        (F.col("line") % 2).alias("getQty"), option.alias("reward"), value.alias("value"))
    lowest = F.min("lowest")
    # By docId alone, which joins on it can use; it is the promoId here.
    heads = parts.groupBy("docId").agg(
        F.concat(F.lit("offer "), F.max("line").cast("string")).alias("description"),
        F.min("startDate").alias("startDate"), F.max("endDate").alias("endDate"),
        F.when(lowest % 6 == 0, "Set Price").when(lowest % 6 == 1, "Percentage Off").alias("basketOption"),
        F.when(lowest % 6 == 0, 50.0).alias("basketValue")).select("docId", F.col("docId").alias("promoId"), "description", "startDate", "endDate",
                                                                    "basketOption", "basketValue")
    skus = rows.select(F.col("promoId").alias("docId"), "position", F.col("l_partkey").cast("string").alias("sku"))
    return Flat(heads, sets, stored(skus, "promotion-products"))


def promotion_number() -> F.Column:
    """Number in the id of a document."""
    return F.expr("substring(docId, 2)").cast("bigint")


def shared_promotions(spark: SparkSession, sf_dir: str) -> Flat:
    """The same documents under the ids of a hundred promotions."""
    flat = promotions(spark, sf_dir)
    shared = F.concat(F.lit("P"), (promotion_number() % 100).cast("string"))
    return flat._replace(promotions=flat.promotions.withColumn("promoId", shared), sets=flat.sets.withColumn("promoId", shared))


def stored_promotions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """New promotions (open orders) and existing ones (finished orders) with the same shape."""
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.when(F.col("o_orderstatus") == "F", "E").otherwise("N"), F.col("o_orderkey")).alias("name"),
        F.concat(F.lit("spend "), F.col("o_custkey") % 100).alias("description"),
        F.concat(F.lit("GET * £"), F.floor("o_totalprice"), F.lit(" 1 IN Basket")).alias("expression"),
        F.col("o_orderdate").alias("startDate"),
        (F.col("o_orderdate") + F.expr("interval 30 days")).alias("endDate"),
        F.when(F.col("o_orderkey") % 2 == 0, "Combines").alias("stackingRule"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.lit(None).cast("string").alias("valueOrder"), "o_orderstatus")
    return (rows.filter("o_orderstatus <> 'F'").drop("o_orderstatus"),
            rows.filter("o_orderstatus = 'F'").drop("o_orderstatus"))


def supplier_segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """New and existing segments of suppliers, by the year their parts shipped."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    rows = lines.select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("segment"), F.col("l_partkey").cast("string").alias("sku"),
        F.year("l_shipdate").alias("year"), (F.col("l_suppkey") % 4).alias("kind"))
    new = rows.filter("year >= 1998").select("segment", "sku")
    existing = rows.filter("year < 1998 and kind <> 0").select("segment", "sku")
    return new, existing
