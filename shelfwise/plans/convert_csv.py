"""Convert CSV files to parquet as a JSON schema document says."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources.csv_schema import CsvSchema, convert_to_parquet
from .runner import need


def run(spark: SparkSession, args: dict[str, str]) -> None:
    source, target, schema_path = need(args, "csvPath", "parquetPath", "schemaPath")
    document = spark.read.text(schema_path, wholetext=True).first()[0]
    convert_to_parquet(spark, source, target, CsvSchema.from_json(document),
                       int(args.get("partitions", "32")), args.get("mode", "errorifexists"))
