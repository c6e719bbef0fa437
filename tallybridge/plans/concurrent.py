"""Independent jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def side_by_side(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Run jobs that do not depend on each other, so a small one does not wait for a large one."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inherit(step)) for step in steps]
        return [step.result() for step in running]
