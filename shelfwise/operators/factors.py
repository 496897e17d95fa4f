"""Implicit-feedback factorisation and the factor tables that come out of it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


@dataclass(frozen=True)
class FactorParams:
    """Settings of a training run.

    ``blocks`` is the number of user and of item blocks, by default one per core of the cluster.
    """

    rank: int
    iterations: int
    regularisation: float
    alpha: float
    blocks: int | None = None
    seed: int = 42


def train(ratings: DataFrame, params: FactorParams) -> ALSModel:
    """Train on (customerId, productId, rating) with implicit preferences.

    Long runs cut their lineage in the shared checkpoint folder of the session.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    blocks = params.blocks or max(10, ratings.sparkSession.sparkContext.defaultParallelism)
    als = ALS(
        userCol="customerId", itemCol="productId", ratingCol="rating", implicitPrefs=True,
        rank=params.rank, maxIter=params.iterations, regParam=params.regularisation, alpha=params.alpha,
        numUserBlocks=blocks, numItemBlocks=blocks, seed=params.seed, checkpointInterval=5,
    )
    typed = ratings.select(
        F.col("customerId").cast("int").alias("customerId"), F.col("productId").cast("int").alias("productId"),
        F.col("rating").cast("float").alias("rating"))
    return als.fit(typed)


def train_or_load(ratings: DataFrame, params: FactorParams, path: str, use_existing: bool) -> ALSModel:
    """Train, save and read back a model, or just read an existing one."""
    if not use_existing:
        train(ratings, params).write().overwrite().save(path)
    return ALSModel.load(path)


def item_factors(model: ALSModel) -> DataFrame:
    """All item vectors: (id, factors)."""
    return model.itemFactors.select("id", F.col("features").alias("factors"))


def user_factors(model: ALSModel) -> DataFrame:
    """All user vectors: (id, factors)."""
    return model.userFactors.select("id", F.col("features").alias("factors"))


def vectors_wide(vectors: DataFrame, rank: int) -> DataFrame:
    """One column per dimension (f0, f1, ...) next to the id."""
    return vectors.select("id", *(F.get("factors", F.lit(i)).alias(f"f{i}") for i in range(rank)))


def cohort_tag(c: Column | str) -> Column:
    """Upper-cased first letter of a cohort name."""
    return F.upper(F.substring(c, 1, 1))


def union_cohorts(parts: dict[str, DataFrame]) -> DataFrame:
    """All rows of several cohorts, tagged with the cohort."""
    tagged = [df.withColumn("gender", cohort_tag(F.lit(name))) for name, df in parts.items()]
    union = tagged[0]
    for df in tagged[1:]:
        union = union.unionByName(df)
    return union


def with_customer_guid(factors: DataFrame, customers: DataFrame) -> DataFrame:
    """User vectors with the external id of the customer instead of the internal one."""
    ids = customers.select(F.col("customerId").alias("id"), "guid")
    return factors.join(ids, "id").select("guid", "factors")


def gram(vectors: DataFrame) -> DataFrame:
    """Sums of products of all pairs of dimensions over all vectors: (i, j, value).

    A task adds up its vectors as one matrix product per batch, so rank x rank rows per task are shuffled.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                column = batch.column("factors")
                matrix = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                total = matrix.T @ matrix + (0 if total is None else total)
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_pydict({"i": i.ravel(), "j": j.ravel(), "value": total.ravel()})

    typed = vectors.select(F.col("factors").cast("array<double>").alias("factors"))
    return typed.mapInArrow(partial, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))


def implicit_loss(ratings: DataFrame, users: DataFrame, items: DataFrame, regularisation: float, alpha: float) -> DataFrame:
    """What training minimises, in one row: ``loss`` of user and item vectors (id, factors) against the ratings.

    Every customer and product counts, rated or not: a rating r > 0 is a preference of 1 held with the weight 1 + alpha * r,
    all others are a preference of 0 with the weight 1. The sum over all pairs is not formed: that of the squared
    products of all vectors is the product of the two Gram matrices, and only the ratings correct it. The norm of a vector counts
    once per rating of its customer or product.
    """
    squares = gram(users).join(gram(items).withColumnRenamed("value", "other"), ["i", "j"]).select((F.col("value") * F.col("other")).alias("part"))

    def side(vectors: DataFrame, key: str, name: str) -> DataFrame:
        return vectors.select(F.col("id").alias(key), F.col("factors").cast("array<double>").alias(name))

    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    rated = ratings.filter("rating > 0").join(side(users, "customerId", "x"), "customerId").join(side(items, "productId", "y"), "productId")
    terms = rated.select(F.col("rating").cast("double").alias("r"), dot("x", "y").alias("p"), (dot("x", "x") + dot("y", "y")).alias("norms"))
    corrections = terms.select((
        (1 + alpha * F.col("r")) * (1 - F.col("p")) * (1 - F.col("p")) - F.col("p") * F.col("p") + regularisation * F.col("norms")).alias("part"))
    return squares.unionAll(corrections).agg(F.coalesce(F.sum("part"), F.lit(0.0)).alias("loss"))
