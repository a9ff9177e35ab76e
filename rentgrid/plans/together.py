"""Independent tables of one run, written at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(*steps: Callable[[], Any]) -> list[Any]:
    """Run Spark actions that do not need each other side by side.

    One write's last slow tasks leave executors idle; the next write can use them.
    Threads take over the caller's job group and scheduler pool. The first error is
    raised once all steps have ended.
    """
    session = SparkSession.getActiveSession()
    inherit = inheritable_thread_target(session) if session else inheritable_thread_target
    with ThreadPoolExecutor(len(steps)) as pool:
        return [future.result() for future in [pool.submit(inherit(step)) for step in steps]]
