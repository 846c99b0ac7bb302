"""Run independent Spark actions at the same time, so that one does not wait for the other's tail."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(spark: SparkSession, tasks: list[Callable]) -> list:
    """Results of the tasks in order; each task runs its own Spark jobs from its own thread."""
    if len(tasks) == 1:
        return [tasks[0]()]
    with ThreadPoolExecutor(len(tasks)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [done.result() for done in waiting]
