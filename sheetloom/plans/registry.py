"""The list of runnable queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        RUNS[name] = run
        if check is not None:
            CHECKS[name] = check
        return run

    return register
