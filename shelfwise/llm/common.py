"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.session import ensure_checkpoint_dir

#: Up to so many ids are broadcast, with a number or two each (at most 64 MB); more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, a null text as an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def fold(doc_id: Column, parts: int) -> Column:
    """Fold of a row: crc32 of its id as text, modulo the number of folds. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def cut(df: DataFrame) -> DataFrame:
    """The rows from the shared checkpoint folder; a lost executor costs nothing that was computed before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffles that no frame needs any more removed from the executors' disks. Spark does so when its driver collects
    garbage, some of it the second time only."""
    gc.collect()
    for _ in range(3):
        spark._jvm.System.gc()
        time.sleep(1)


def sized(ids: DataFrame) -> DataFrame:
    """Narrow rows, to be broadcast if they are few enough, so that texts need not be shuffled to meet them."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as make it differ from all columns."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows, with all columns, whose doc_id is not among the ``doc_id`` of gone; rows without doc_id stay."""
    key = fresh(docs, "gone_id")
    ids = cut(gone.select(F.col("doc_id").alias(key)).distinct())
    return docs.join(sized(ids), F.col("doc_id").cast("long") == F.col(key), "left_anti")


def low_bytes(values: np.ndarray) -> np.ndarray:
    """Rows of the bytes, the lowest first, that the largest of some unsigned numbers needs."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width])


def from_bytes(data: bytes, count: int) -> np.ndarray:
    """So many numbers, of :func:`low_bytes`."""
    out = np.zeros((count, 8), np.uint8)
    out[:, :len(data) // max(1, count)] = np.frombuffer(data, np.uint8).reshape(count, -1) if count else 0
    return out.view(np.uint64).reshape(-1)
