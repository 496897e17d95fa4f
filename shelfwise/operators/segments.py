"""Product segments as (segment, sku) rows: change sets, requests and registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .joins import salted_join


def segment_changes(new: DataFrame, existing: DataFrame) -> DataFrame:
    """What turns the existing segments into the new ones: (segment, sku, action).

    ``create`` rows belong to segments that do not exist yet; segments that
    exist get ``add`` and ``remove`` rows. Existing segments that are not among
    the new ones are left alone. Both inputs have (segment, sku).
    """
    tagged = new.select("segment", "sku", F.lit(1).alias("isNew")).unionByName(
        existing.select("segment", "sku", F.lit(0).alias("isNew")))
    # Stored, since sizes, sides and the rows themselves all come from it.
    pairs = stored(tagged.groupBy("segment", "sku").agg(F.max("isNew").alias("isNew"), F.min("isNew").alias("least")), "segment-pairs")
    one_sided = pairs.filter("isNew = least").select("segment", "sku", "isNew")
    sides = pairs.groupBy("segment").agg(F.max("isNew").alias("anyNew"), F.min("least").alias("allNew"))
    compared = salted_join(one_sided, sides.filter("anyNew = 1"), ["segment"], "sku")
    action = F.when(F.col("allNew") == 1, "create").when(F.col("isNew") == 1, "add").otherwise("remove")
    return compared.select("segment", "sku", action.alias("action"))


def apply_changes(existing: DataFrame, changes: DataFrame) -> DataFrame:
    """Existing (segment, sku) rows after a change set."""
    removed = changes.filter("action = 'remove'").select("segment", "sku")
    added = changes.filter("action <> 'remove'").select("segment", "sku")
    return existing.select("segment", "sku").distinct().join(
        removed, ["segment", "sku"], "left_anti").unionByName(added)


def set_difference(left: Column | str, right: Column | str) -> Column:
    """SKUs of one array that are not in another."""
    return F.array_except(left, right)


def segment_key(accessor: Column | str, segment_type: Column | str) -> Column:
    """Name a segment is registered under."""
    return F.concat_ws(":", accessor, segment_type)


def latest_segments(rows: DataFrame) -> DataFrame:
    """Rows of the last registered version of each segment.

    Input and output have (segmentKey, version, sku).
    """
    latest = rows.groupBy("segmentKey").agg(F.max("version").alias("version"))
    return salted_join(rows, latest, ["segmentKey", "version"], "sku", "left_semi").select(
        "segmentKey", "version", "sku").distinct()


def overwritten_segments(rows: DataFrame) -> DataFrame:
    """Segments registered more than once: key and the number of versions that were replaced."""
    versions = rows.groupBy("segmentKey", "version").agg(F.lit(1).alias("one"))
    counts = versions.groupBy("segmentKey").agg((F.count("*") - 1).alias("replaced"))
    return counts.filter("replaced > 0")


def lookup_segments(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the requested segment keys."""
    return salted_join(rows, keys.select("segmentKey").distinct(), ["segmentKey"], "sku", "left_semi")


def segment_request(segments: DataFrame) -> DataFrame:
    """Request shape of a segment, one row per item: the description falls back to the name.

    Items stay rows: a segment may hold any number of them.
    """
    return segments.select(
        F.col("segment").alias("name"), F.coalesce("description", "segment").alias("description"), "sku")


def segment_rows(responses: DataFrame) -> DataFrame:
    """Response documents (descriptor{name, description}, items[{sku}]) to one row per item."""
    return responses.select(
        F.col("descriptor.name").alias("segment"), F.col("descriptor.description").alias("description"),
        F.explode("items.sku").alias("sku"))
