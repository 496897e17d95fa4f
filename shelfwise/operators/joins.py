"""Joins against one row per group that stay even when a group is very large."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Salts of a group for each task that its rows would fill: a hash deals so many pieces out about evenly.
SALTS_PER_SHARE = 8


def group_salts(rows: DataFrame, keys: list[str], tasks: int) -> list[tuple]:
    """Keys and number of salts of every group that has more rows than a task should.

    A task's share is one in ``tasks`` of all rows, so there are fewer such groups than tasks. Their sizes come from a count
    of all rows by key, which is combined before its shuffle.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    if not total or most * tasks <= total:
        return []
    large = counts.filter(F.col("n") * tasks > total).collect()
    return [(*row[:-1], math.ceil(row.n * tasks * SALTS_PER_SHARE / total)) for row in large]


def salted_join(rows: DataFrame, groups: DataFrame, keys: list[str], spread_by: str, how: str = "inner",
                tasks: int | None = None) -> DataFrame:
    """Join many rows to one row per group on ``keys``.

    Groups that measure more than a task's share are dealt out: their rows get a salt by the hash of another column, and
    the one row of the group is repeated for each salt. All other groups have one salt; without large groups this is a
    plain join. ``rows`` is read once more to be measured, so it should be cheap to read. Null keys match nothing.
    """
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = group_salts(rows.dropna(subset=keys), keys, tasks)
    if not large:
        return rows.join(groups, keys, how)
    schema = T.StructType([*(rows.schema[k] for k in keys), T.StructField("_salts", T.LongType())])
    salts = F.broadcast(rows.sparkSession.createDataFrame(large, schema))

    def measured(df: DataFrame, salt: Column) -> DataFrame:
        known = df.join(salts, keys, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
        return known.withColumn("_salt", salt).drop("_salts")

    # Never null, so Spark has no reason to push a null check on the hash down to the scan.
    salted = measured(rows, F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_salts")), F.lit(0)))
    repeated = measured(groups, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
