"""Write the pointer file that announces a finished model."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from ..errors import DataPublishError
from ..functions.paths import make_path
from .runner import need


class PointerFile(NamedTuple):
    path: str
    content: str


def path_name(value: str) -> str:
    """``*`` stands for all in the arguments, and is no file name."""
    return "all" if value == "*" else value


def pointer_file(args: dict[str, str]) -> PointerFile:
    """Path (from model and slice start) and content (six tab-separated fields)."""
    model, model_type, start = need(args, "modelName", "modelType", "sliceStart")
    scope = [args.get(name, "all") for name in ("store", "origin", "mvt")]
    stamp = dt.datetime.fromisoformat(start).strftime("%Y%m%d_%H%M%S")
    content = "\t".join([model, model_type, *scope, str(int(args.get("retentionDays", "5")))])
    return PointerFile(f"/{model}/pointer_{stamp}.tsv", content)


def run(spark: SparkSession, args: dict[str, str]) -> None:
    pointer = pointer_file(args)
    line = spark.createDataFrame([(pointer.content,)], "value string")
    target = make_path(need(args, "basePath")[0], pointer.path)
    try:
        line.coalesce(1).write.mode("overwrite").text(target)
    except PySparkException as error:
        raise DataPublishError(f"cannot write {target}") from error
