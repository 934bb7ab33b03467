"""Independent Spark actions started side by side."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

MOST_AT_ONCE = 8


def side_by_side(spark: SparkSession, steps: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run the steps in driver threads, so that one step's small jobs fill another's gaps."""
    with ThreadPoolExecutor(max_workers=min(MOST_AT_ONCE, max(1, len(steps)))) as pool:
        started = {
            name: pool.submit(inheritable_thread_target(spark)(copy_context().run), step)
            for name, step in steps.items()
        }
        return {name: future.result() for name, future in started.items()}
