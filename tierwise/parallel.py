"""Submitting independent Spark jobs side by side from the driver, and listing many folders in few tasks."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def together(
    spark: SparkSession, calls: Mapping[str, Callable[[], T]], parallel: int = 4
) -> dict[str, T]:
    """Results by name, ``parallel`` calls at a time.

    The first failure in declared order is raised once the running calls have ended.
    """
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        jobs = {n: pool.submit(inheritable_thread_target(spark)(call)) for n, call in calls.items()}
    return {name: job.result() for name, job in jobs.items()}


# Tasks that list folders at once, for each core and at least.
LISTING, A_CORE, AT_LEAST = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4, 64
_lock, _before = threading.Lock(), []


@contextmanager
def listing_by_cores(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark lists the folders of a table with some tasks a core, not with a task for each folder, of which it
    allows 10,000: starting one takes far longer than listing a folder.  The setting comes back with the last of
    several threads; a smaller one stays.
    """
    with _lock:
        _before.append(_before[-1] if _before else spark.conf.get(LISTING))
        spark.conf.set(LISTING, min(int(_before[-1]), max(AT_LEAST, A_CORE * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        with _lock:
            earlier = _before.pop()
            if not _before:
                spark.conf.set(LISTING, earlier)
