"""Run a job: spark-submit --py-files shelfwise.zip run.py <job> key=value ..."""

from __future__ import annotations

import importlib
import sys

from shelfwise.plans.runner import run_job

if __name__ == "__main__":
    job, *args = sys.argv[1:]
    run_job(importlib.import_module(f"shelfwise.plans.{job}").run, args)
