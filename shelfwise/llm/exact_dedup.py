"""Exact duplicates by a distributed sort of the normalised texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.common import cut, fresh, id_and_text, sized

#: Runs of ASCII white space that are not one space already.
SPACES = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space."""
    return F.regexp_replace(text, SPACES, " ")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Find texts that are identical but for runs of white space; the smallest doc_id of each group stays.

    Sampled splitters deal the texts by range, each task sorts its range externally, and a window over the sorted
    rows compares neighbours in full. Splitters are the first characters and a hash of the text, so what the
    driver samples is of bounded size; equal texts have equal splitters. A text that more than a quarter of a
    task's share of rows has is dealt out over as many pieces as there are tasks, and the pieces, equal in the
    SHA-256 of their text, are put together afterwards; there are at most four such texts per task.

    One row out for each row in: doc_id, keep_id, group_size, kept, text_sha256. A null text counts as empty.
    Of rows with the same text and doc_id one is kept. Null ids come after all others: keep_id is null only in a
    group without any id, of which one row is kept. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = id_and_text(docs).select("doc_id", normalised(F.col("text")).alias("norm")) \
        .withColumn("hash", F.xxhash64("norm"))
    large = max(1000, docs.count() // (4 * tasks))
    # Every such text has over a quarter of a task's share, so there are at most 4 x tasks of them.
    hot = texts.groupBy("hash").count().filter(F.col("count") > large).select("hash", F.lit(True).alias("hot"))
    keys = ["head", "hash", "piece"]
    ranged = (
        texts.join(F.broadcast(hot), "hash", "left")
        .withColumn("head", F.substring("norm", 1, 12))
        .withColumn("piece", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(tasks))).otherwise(-1).cast("int"))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys, "norm", F.col("doc_id").asc_nulls_last())
    )
    # Dealt by range of the first three keys, rows of equal keys are in one task: the window needs no exchange.
    group = Window.partitionBy(*keys, "norm").orderBy(F.col("doc_id").asc_nulls_last())
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pieces = cut(ranged.select(
        "doc_id", F.unhex(F.sha2("norm", 256)).alias("digest"), (F.col("piece") >= 0).alias("hot"),
        (F.row_number().over(group) == 1).alias("first"), F.min("doc_id").over(whole).alias("piece_id"),
        F.count(F.lit(1)).over(whole).alias("piece_size"),
    ))
    merged = pieces.filter("hot AND first").groupBy("digest").agg(
        F.min("piece_id").alias("hot_id"), F.sum("piece_size").alias("hot_size"))
    keep = F.when(F.col("hot"), F.col("hot_id")).otherwise(F.col("piece_id"))
    return pieces.join(F.broadcast(merged), "digest", "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("hot_size", "piece_size").alias("group_size"),
        (F.col("first") & F.col("doc_id").eqNullSafe(keep)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that exact_dedup keeps, with all their columns: one row per text."""
    found = cut(exact_dedup(docs))
    key, digest, other_key, other, number = (fresh(docs, n) for n in ("key", "digest", "other_key", "other_digest", "number"))
    own = docs.withColumns({key: F.col("doc_id").cast("long"), digest: F.sha2(normalised(F.coalesce("text", F.lit(""))), 256)})
    same_row = F.col(key).eqNullSafe(F.col(other_key)) & (F.col(digest) == F.col(other))

    def rows(of: DataFrame) -> DataFrame:
        return of.select(F.col("doc_id").alias(other_key), F.col("text_sha256").alias(other))

    gone = found.filter(~F.col("kept"))
    if gone.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).isEmpty():
        left = own.join(sized(rows(gone)), same_row, "left_anti")
    else:
        # Rows that repeat an id and its text can't be told apart by them: they lie together after this join.
        left = own.join(rows(found.filter("kept")), same_row, "left_semi")
        again = Window.partitionBy(key, digest).orderBy(key)
        left = left.withColumn(number, F.row_number().over(again)).filter(F.col(number) == 1).drop(number)
    return left.drop(key, digest)
