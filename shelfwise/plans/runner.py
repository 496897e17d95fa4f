"""Running a job from the command line."""

from __future__ import annotations

import logging
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from ..session import drop_stages

Job = Callable[[SparkSession, dict[str, str]], None]

log = logging.getLogger("shelfwise")


class JobArgumentError(ValueError):
    """A required job argument is missing."""


def named_args(args: Sequence[str]) -> dict[str, str]:
    """``key=value`` arguments; the value may itself hold ``=``, other arguments are ignored."""
    return dict(arg.split("=", 1) for arg in args if "=" in arg)


def need(args: dict[str, str], *names: str) -> list[str]:
    """Values of required arguments."""
    missing = [name for name in names if name not in args]
    if missing:
        raise JobArgumentError(f"missing job arguments: {', '.join(missing)}")
    return [args[name] for name in names]


def run_job(job: Job, args: Sequence[str] | None = None, stop: bool = True) -> None:
    """Run a job in a UTC session with adaptive execution, log its outcome, and stop the session."""
    name = f"{job.__module__.rsplit('.', 1)[-1]}"
    spark = (SparkSession.builder.appName(name)
             .config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
             .getOrCreate())
    log.info("started %s", name)
    try:
        job(spark, named_args(sys.argv[1:] if args is None else args))
        log.info("completed %s", name)
    except Exception:
        log.exception("failed %s", name)
        raise
    finally:
        if stop:
            if spark.sparkContext.getCheckpointDir():
                drop_stages(spark)
            spark.stop()
