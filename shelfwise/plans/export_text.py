"""Write factors and similarities as delimited text, each only if its output is named."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sinks import files
from .export_base64 import has_cohorts, read_all
from .runner import need


def run(spark: SparkSession, args: dict[str, str]) -> None:
    cohorts = has_cohorts(args)
    files_of = lambda name, default: int(args.get(name, default))
    if "userFactorsOutput" in args:
        source, target = need(args, "userFactorsInput", "userFactorsOutput")
        files.save_text(files.user_factor_table(read_all(spark, source, cohorts)), target, "\t", files_of("userPartitions", "32"))
    if "productFactorsOutput" in args:
        source, target = need(args, "productFactorsInput", "productFactorsOutput")
        files.save_lines(files.item_factor_lines(read_all(spark, source, cohorts)), target, files_of("productPartitions", "100"))
    if "productSimilarityOutput" in args:
        source, target = need(args, "productSimilarityInput", "productSimilarityOutput")
        files.save_text(files.similarity_table(read_all(spark, source, cohorts)), target, "\t", files_of("similarityPartitions", "64"))
