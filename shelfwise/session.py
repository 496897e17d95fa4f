"""Session helpers shared by the jobs, the tests and the benchmark."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for one machine; on a cluster the session comes from spark-submit."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, as named in ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own. A cluster
    without it is an error: executors can be lost, so a machine-local folder
    would not do.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="shelfwise-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def _stages(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/stages-{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared checkpoint folder."""
    return f"{_stages(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared checkpoint folder.

    Ends a stage: what reads it, however often, computes nothing again, takes only the columns it needs, and depends
    on no executor that was there before.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> None:
    """Remove the tables that this application has stored; no frame that reads one may be in use any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_stages(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Rows that come in fewer partitions than there are cores, dealt anew before costly work on each of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
