"""Steps that do not depend on each other, submitted side by side.

A small table's job occupies a few cores for a moment; several at once keep the cluster busy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, steps: Iterable[Callable[[], object]], width: int) -> None:
    """Run all steps, ``width`` at a time. After the first error no further step starts; it is raised when
    those under way have ended."""
    with ThreadPoolExecutor(max_workers=width) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        wait(started, return_when=FIRST_EXCEPTION)
        if any(step.done() and step.exception() for step in started):
            pool.shutdown(wait=True, cancel_futures=True)
    for step in started:
        if not step.cancelled():
            step.result()
