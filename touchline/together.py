"""Independent Spark jobs submitted side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

Result = TypeVar("Result")


def run_together(
    spark: SparkSession, actions: Sequence[Callable[[], Result]], threads: int = 8
) -> list[Result]:
    """Run actions that do not depend on each other; the first error is raised.

    The tasks of a small table fill the executors that a large one leaves idle.
    """
    with ThreadPoolExecutor(max_workers=threads) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
        return [future.result() for future in running]
