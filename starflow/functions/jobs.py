"""Submitting independent jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

A = TypeVar("A")
B = TypeVar("B")
MAX_JOBS = 8


def run_together(spark: SparkSession, fn: Callable[[A], B], items: Sequence[A]) -> list[B]:
    """``[fn(i) for i in items]``, where each call starts Spark jobs of its own.

    Their stages then fill the gaps in each other's tails instead of queueing.
    """
    if not items:
        return []
    with ThreadPoolExecutor(max_workers=min(MAX_JOBS, len(items))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fn), items))
