"""Write factors and similarities in their base64 text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import make_path
from ..operators import factors
from ..sinks import files
from ..sources.feeds import load_text
from .compute_factors import COHORTS
from .runner import need


def has_cohorts(args: dict[str, str]) -> bool:
    """The setting that the training job was run with."""
    return args.get("cohorts", "false") == "true"


def read_items(spark: SparkSession, base: str, cohorts: bool) -> DataFrame:
    """Item vectors with their cohort, each written in a folder of its own; without cohorts it is null."""
    if not cohorts:
        return spark.read.parquet(base).withColumn("gender", F.lit(None).cast("string"))
    return factors.union_cohorts({cohort: spark.read.parquet(make_path(base, cohort)) for cohort in COHORTS})


def read_all(spark: SparkSession, base: str, cohorts: bool) -> DataFrame:
    """Parquet data of all cohorts together, or of the one folder that there is without."""
    return spark.read.parquet(*((make_path(base, cohort) for cohort in COHORTS) if cohorts else [base]))


def run(spark: SparkSession, args: dict[str, str]) -> None:
    cohorts = has_cohorts(args)
    customers = load_text(spark, "customer", need(args, "customersInput")[0], "\t", raw=True)
    source, target = need(args, "userFactorsInput", "userFactorsOutput")
    users = factors.with_customer_guid(read_all(spark, source, cohorts), customers)
    files.save_lines(files.user_b64_lines(users), target, int(args.get("userPartitions", "64")))

    source, target = need(args, "productFactorsInput", "productFactorsOutput")
    items = read_items(spark, source, cohorts)
    files.save_lines(files.item_b64_lines(items), target, int(args.get("productPartitions", "100")))

    source, target = need(args, "productSimilarityInput", "productSimilarityOutput")
    similar = read_all(spark, source, cohorts)
    files.save_lines(files.similarity_b64_lines(similar), target, int(args.get("similarityPartitions", "64")))
