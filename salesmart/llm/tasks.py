"""Helpers of Python code that runs inside tasks."""

from __future__ import annotations

import sys
from contextlib import contextmanager

from pyspark import cloudpickle

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(module: str) -> None:
    """Send the functions of ``module`` along with the task, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def worker_cache(name: str, large: bool = False) -> dict:
    """A dictionary that lives as long as the worker process and is shared by its tasks.

    A new ``large`` one takes the place of all others, which are made again where they are needed.
    """
    caches = sys.modules["__main__"].__dict__.setdefault("_salesmart_caches", {})
    if large and (name, large) not in caches:
        caches.clear()
        release()
    return caches.setdefault((name, large), {})


@contextmanager
def small_batches(spark, size: str = "4m"):
    """What is written meanwhile passes Arrow batches of about ``size``: a task holds several at once, in the JVM and in Python."""
    before = spark.conf.get(_BATCH_BYTES, None)
    spark.conf.set(_BATCH_BYTES, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_BYTES)
        else:
            spark.conf.set(_BATCH_BYTES, before)


def release() -> None:
    """Give freed memory back to the system, which the allocators of an idle, reused worker would keep."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(function):
    """The same batch function, which releases memory at the end of a task."""

    def wrapped(batches):
        yield from function(batches)
        release()

    return wrapped


ship(__name__)
