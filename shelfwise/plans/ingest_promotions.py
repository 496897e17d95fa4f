"""Promotion documents to new promotions, segment changes and errors, ready for a writer."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import make_path
from ..operators import promotions, segments
from ..operators.promotions import Flat
from ..sources.promotions_xml import load_existing_promotions, load_promotions_xml
from .runner import need


class Ingest(NamedTuple):
    promotions: DataFrame
    changes: DataFrame
    errors: DataFrame
    summary: DataFrame


def translate_supported(flat: Flat, stacking_rule: str | None = "Combines", priority: int | None = 0,
                        value_order: str | None = None) -> DataFrame:
    """Translation of the promotions that have a reward of their own.

    Documents carry no stacking rule, priority or value order: those of new promotions are settings, and have to be
    those that promotions are stored with, or a later run does not recognise them.
    """
    kept = promotions.supported(flat.promotions, flat.sets)
    return promotions.translate(flat._replace(promotions=kept)).withColumns({
        "stackingRule": F.lit(stacking_rule).cast("string"), "priority": F.lit(priority).cast("int"),
        "valueOrder": F.lit(value_order).cast("string")})


def ingest(translated: DataFrame, flat: Flat, existing: DataFrame, existing_segments: DataFrame,
           as_of: Column) -> Ingest:
    """Promotions that are new and not over, the changes their segments need, and what was wrong.

    ``existing`` has the columns of a stored promotion, ``existing_segments``
    (segment, sku). Errors also name ids that several documents have; that alone rejects none of them.
    """
    valid = promotions.valid_promotions(translated)
    accepted = promotions.active(promotions.new_promotions(valid, existing), as_of)
    errors = promotions.translation_errors(translated)
    wanted = promotions.named_segments(flat, accepted)
    rejected = translated.filter(F.size("errors") > 0)
    status = lambda df, name: df.select("docId").withColumn("status", F.lit(name))
    summary = promotions.ingest_summary(status(accepted, "accepted").unionAll(status(rejected, "rejected")))
    return Ingest(accepted.drop("docId"), segments.segment_changes(wanted, existing_segments),
                  errors.unionByName(promotions.repeated_ids(translated)), summary)


def run(spark: SparkSession, args: dict[str, str]) -> None:
    """Also takes asOf, stackingRule, priority and valueOrder; an empty value means none."""
    source, existing_path, segments_path, target = need(
        args, "promotionsPath", "existingPromotionsPath", "existingSegmentsPath", "outputPath")
    documents_path, translated_path = make_path(target, "documents"), make_path(target, "translated")
    # Stored, since everything starts from these two.
    promotions.keyed(load_promotions_xml(spark, source)).write.mode("overwrite").parquet(documents_path)
    flat = promotions.flatten_stored(spark.read.parquet(documents_path))
    priority = args.get("priority", "0")
    translate_supported(flat, args.get("stackingRule", "Combines") or None, int(priority) if priority else None,
                        args.get("valueOrder") or None).write.mode("overwrite").parquet(translated_path)
    as_of = F.to_timestamp(F.lit(args["asOf"])) if "asOf" in args else F.current_timestamp()
    done = ingest(spark.read.parquet(translated_path), flat, load_existing_promotions(spark, existing_path),
                  segments.segment_rows(spark.read.schema(SEGMENT).json(segments_path)), as_of)
    for name, df in done._asdict().items():
        df.write.mode("overwrite").parquet(make_path(target, name))


SEGMENT = "descriptor struct<name: string, description: string>, items array<struct<sku: string>>"
