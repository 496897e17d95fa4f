"""Write the best signal per customer and product."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.signals import priority_signals
from ..sinks.files import save_text
from ..sources.feeds import load_parquet
from .runner import need


def run(spark: SparkSession, args: dict[str, str]) -> None:
    signals_path, customers_path, target = need(args, "signalsPath", "customersPath", "csvOutputPath")
    best = priority_signals(load_parquet(spark, "signals", signals_path),
                            load_parquet(spark, "customer", customers_path))
    save_text(best, target, "\t", int(args.get("outputPartitions", "32")))
