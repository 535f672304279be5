"""What Python workers keep between their tasks.

Spark reuses workers, so what one holds after a task stands beside the next
stage: tables cached for another operator, and free memory that the allocators
of Python, numpy and Arrow have not returned to the system.  All of it counts
against the executor.
"""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import SparkSession

#: Arrow from the system's allocator, which numpy uses too: free memory of the one serves the other
WORKER_ENV = {"ARROW_DEFAULT_MEMORY_POOL": "system"}

_tables: list = []


def worker_table(cached):
    """Marks a cached loader whose results a worker may hold from task to task
    of its own operator, but not through other operators' tasks."""
    _tables.append(cached)
    return cached


def lean(run, tables: bool = False):
    """``run`` (for mapInArrow), which gives free memory back at its end.

    Tables of other operators go before it starts; one that uses such tables
    (``tables``) keeps them for its next task.
    """
    def task(batches):
        if not tables and any(cached.cache_info().currsize for cached in _tables):
            for cached in _tables:
                cached.cache_clear()
            give_back()
        yield from run(batches)
        give_back()

    return task


def give_back() -> None:
    """Returns the process's free memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc's
    if trim is not None:
        trim(0)


def set_worker_env(spark: SparkSession) -> None:
    """Starts this session's Python workers with ``WORKER_ENV``; what the session has set stays."""
    for name, value in WORKER_ENV.items():
        spark.sparkContext.environment.setdefault(name, value)
