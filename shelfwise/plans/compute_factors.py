"""Train on recent signals and write similar products, product factors and user factors.

    run.py compute_factors todaysDate=2019-03-04 signalsPath=... ...
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import make_path, month_globs
from ..operators import factors, products, ranking, signals
from ..sinks.files import release, save
from ..sources import ranges, tolerant
from .runner import need

COHORTS = ("male", "female")


def training_signals(spark: SparkSession, args: dict[str, str], today: dt.date) -> DataFrame:
    """Valid signals of the current month and of ``signalMonths`` months before it."""
    prefix, months = need(args, "signalsPath", "signalMonths")
    globs = ranges.existing_paths(spark, month_globs(prefix, today, int(months)))
    if not globs:
        raise ranges.NoDataError(f"no signals under {prefix}")
    valid = tolerant.parse_signals(tolerant.signal_lines(spark, globs))
    return valid.filter("useForRecs = 1") if args.get("usableSignalsOnly", "false") == "true" else valid


def product_table(spark: SparkSession, path: str, today: dt.date) -> DataFrame:
    """Latest row per product with its age in days."""
    latest = products.latest_products(tolerant.known_products(spark, path))
    on_site = F.timestamp_millis("dateOnSite")
    return latest.withColumn("daysOnSite", products.days_on_site(on_site, today))


def cohort_customers(spark: SparkSession, path: str, cohort: str | None) -> DataFrame:
    """Ids of the customers to train on, all of them or those of one cohort."""
    if cohort is None:
        return tolerant.training_customers(spark, path)
    lines = spark.read.text(path)
    gender = F.upper(F.get(F.split("value", "\t"), F.lit(2)))
    return tolerant.parse_customers(lines.filter(gender == cohort[0].upper())).distinct()


def run(spark: SparkSession, args: dict[str, str]) -> None:
    today = dt.date.fromisoformat(need(args, "todaysDate")[0])
    cohorts = COHORTS if args.get("cohorts", "false") == "true" else (None,)
    table = product_table(spark, need(args, "productPath")[0], today).select(
        "productId", "isExcluded", "daysOnSite", "stockLevel").persist()
    flagged = tolerant.recommendable_products(spark, need(args, "isRecommendedPath")[0])
    eligible = products.eligible_items(table, flagged, int(need(args, "maxDaysOnSite")[0])).persist()
    rated = signals.signal_ratings(training_signals(spark, args, today)).persist()
    try:
        for cohort in cohorts:
            members = cohort_customers(spark, need(args, "customerPath")[0], cohort)
            write_outputs(signals.keep_known(rated, members, table), eligible, args, cohort)
    finally:
        release(table, eligible, rated)


def write_outputs(ratings: DataFrame, eligible: DataFrame, args: dict[str, str], cohort: str | None) -> None:
    """Train or reload the model of a cohort and write its three outputs."""
    target = lambda name: make_path(need(args, name)[0], *([cohort] if cohort else []))
    model = factors.train_or_load(
        ratings, model_params(args), target("modelPath"), need(args, "useExistingModel")[0] == "true")
    items = factors.item_factors(model)
    candidates = products.keep_items(items, eligible)
    similar = ranking.similar_items(items, candidates, int(args.get("numRecs", "100")))
    save(similar.select(F.col("id").cast("int"), F.col("similarId").cast("int"), "score"), target("prodSimPath"),
         int(args.get("similarityPartitions", "32")))
    candidates.write.parquet(target("prodFactorsPath"))
    save(factors.user_factors(model), target("userFactorsPath"), int(args.get("customerFactorsPartitions", "64")))


def model_params(args: dict[str, str]) -> factors.FactorParams:
    rank, iterations, regularisation, alpha = need(args, "rank", "numIterations", "lambda", "alpha")
    return factors.FactorParams(int(rank), int(iterations), float(regularisation), float(alpha),
                                blocks=int(args["blocks"]) if "blocks" in args else None, seed=int(args.get("seed", "42")))
