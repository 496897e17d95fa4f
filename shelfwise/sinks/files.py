"""Writers for parquet and delimited text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codec import encode_pairs, encode_vector
from ..sources.feeds import NULL_TEXT

Partitioner = Callable[[DataFrame], tuple[list[str], DataFrame]]


def save(df: DataFrame, path: str, num_partitions: int) -> None:
    """Parquet, in ``num_partitions`` files. The rows are dealt anew, so the tasks that make them stay as many as they are."""
    df.repartition(num_partitions).write.parquet(path)


def save_text(df: DataFrame, path: str, delimiter: str, num_partitions: int) -> None:
    """Delimited text without a header, null as ``\\N``."""
    _text(df.repartition(num_partitions).write, delimiter).csv(path)


def save_both(df: DataFrame, parquet_path: str, text_path: str, num_partitions: int = 32,
              delimiter: str = "|") -> None:
    """Parquet, and delimited text too when ``text_path`` is given."""
    save(df, parquet_path, num_partitions)
    if text_path:
        save_text(df, text_path, delimiter, num_partitions)


RUN_COLUMN = "run"


def save_partitioned(df: DataFrame, path: str, num_partitions: int, partitioner: Partitioner,
                     fmt: str = "parquet", delimiter: str = "|", run_id: str | None = None) -> None:
    """Append to a folder partitioned by the columns the partitioner adds.

    With a ``run_id`` the append can be repeated: the rows go to a folder ``run=<run_id>`` within each partition, and a run
    replaces what an earlier one with the same id has left in the partitions that it writes to. A job that is run again
    on the same input then doubles nothing, and rows of other runs stay.
    """
    columns, rows = partitioner(df)
    if run_id is not None:
        columns, rows = [*columns, RUN_COLUMN], rows.withColumn(RUN_COLUMN, F.lit(run_id))
    writer = rebalanced(rows, columns, num_partitions).write.mode("append" if run_id is None else "overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*columns)
    if fmt == "csv":
        writer.options(sep=delimiter, header="false").csv(path)
    else:
        writer.format(fmt).save(path)


def rebalanced(df: DataFrame, columns: list[str], num_partitions: int) -> DataFrame:
    """Rows of a folder next to each other, so that a day is not written by every task.

    Adaptive execution splits folders with very many rows over several tasks and
    puts small ones together.
    """
    return df.hint("rebalance", num_partitions, *columns)


def save_lines(lines: DataFrame, path: str, num_partitions: int) -> None:
    """A single text column as plain lines, without any quoting."""
    lines.repartition(num_partitions).write.text(path)


def _text(writer, delimiter: str):
    return writer.options(sep=delimiter, nullValue=NULL_TEXT, header="false")


def release(*dfs: DataFrame) -> None:
    """Drop cached tables."""
    for df in dfs:
        df.unpersist()


def vector_text(c: Column | str) -> Column:
    """Values of a vector as comma-separated text."""
    return F.array_join(F.col(c).cast("array<double>").cast("array<string>"), ",")


def user_factor_table(factors: DataFrame) -> DataFrame:
    """Text export of user vectors: id and comma-separated values."""
    return factors.select("id", vector_text("factors").alias("factors"))


def item_factor_lines(factors: DataFrame) -> DataFrame:
    """Text export of item vectors: one ``id,f1,f2,...`` line each."""
    return factors.select(F.concat_ws(",", F.col("id").cast("string"), vector_text("factors")).alias("value"))


def similarity_table(scores: DataFrame) -> DataFrame:
    """Text export of similarities: id, similarId and score."""
    return scores.select("id", "similarId", "score")


def user_b64_lines(factors: DataFrame) -> DataFrame:
    """Binary export of user vectors: ``guid<TAB>base64``."""
    return factors.select(F.concat_ws("\t", "guid", encode_vector("factors")).alias("value"))


def item_b64_lines(factors: DataFrame) -> DataFrame:
    """Binary export of item vectors: ``id<TAB>cohort<TAB>base64``."""
    return factors.select(F.concat_ws(
        "\t", F.col("id").cast("string"), "gender", encode_vector("factors")).alias("value"))


def similarity_b64_lines(scores: DataFrame) -> DataFrame:
    """Binary export of similarities: ``id<TAB>base64`` with the best score first."""
    return encode_pairs(scores).select(F.concat_ws("\t", F.col("id").cast("string"), "data").alias("value"))
