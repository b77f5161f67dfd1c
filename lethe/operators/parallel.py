"""Independent Spark jobs submitted side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

MAX_JOBS = 8  # driver threads that only wait for jobs; executors are shared by the scheduler


def in_parallel(calls: Iterable[Callable[[], Any]], most: int = MAX_JOBS) -> list[Any]:
    """Results of the calls, in their order, ``most`` at a time; the first failure is raised."""
    calls = list(calls)
    if min(most, len(calls)) < 2:
        return [call() for call in calls]
    with ThreadPoolExecutor(min(MAX_JOBS, most, len(calls))) as pool:
        return list(pool.map(lambda call: call(), calls))
