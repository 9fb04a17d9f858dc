"""Several Spark jobs at once from one driver, in bounded number and with results in a fixed order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T, U = TypeVar("T"), TypeVar("U")


def pooled(spark: SparkSession, fn: Callable[[T], U], of: Sequence[T], parallelism: int) -> list[U]:
    """``[fn(x) for x in of]`` with at most ``parallelism`` calls at a time.

    Threads inherit the caller's job group and local properties. The first error is raised once the calls that
    already run have ended; calls that haven't begun are dropped.
    """
    if parallelism <= 1 or len(of) <= 1:
        return [fn(x) for x in of]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(of))) as pool:
        # one wrapper per call: each thread takes its own copy of the local properties
        calls = [pool.submit(inheritable_thread_target(spark)(fn), x) for x in of]
        try:
            return [c.result() for c in calls]
        except BaseException:
            for c in calls:
                c.cancel()
            raise
