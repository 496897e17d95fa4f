"""Reading back what the export jobs wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.codec import decode_pairs, decode_vector


def load_similarities(spark: SparkSession, path: str) -> DataFrame:
    """Base64 similarity lines to (id, similarId, score) rows."""
    return decode_pairs(spark.read.schema("id int, data string").csv(path, sep="\t"))


def load_user_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Base64 user lines to (guid, factors) rows."""
    lines = spark.read.schema("guid string, data string").csv(path, sep="\t")
    return lines.select("guid", decode_vector("data").alias("factors"))


def load_item_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Base64 item lines to (id, gender, factors) rows."""
    lines = spark.read.schema("id int, gender string, data string").csv(path, sep="\t")
    return lines.select("id", "gender", decode_vector("data").alias("factors"))
