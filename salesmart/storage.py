"""Written intermediate tables.

A step that is read more than once, or whose values must not change when a lost executor's work is
redone, is written as Parquet under the shared folder the cluster names in ``spark.checkpoint.dir``
and read back. Unlike cached blocks these files outlive executors, and unlike ``checkpoint()`` they
keep column pruning and filter pushdown.
"""

from __future__ import annotations

import copy
import tempfile
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: For wide tables of texts, whose hashes (hexadecimal digits) other codecs leave at full size.
DENSE = {"compression": "zstd"}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, tuple[int, str]] = {}
_lock = threading.Lock()


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="salesmart-")
    spark.sparkContext.setCheckpointDir(root)
    return root


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Shuffle files of what runs within go with its end; otherwise they stay until the driver happens to collect garbage.

    The setting is put back once nobody of the session is within any more."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        inside, before = _cleaning.get(session) or (0, spark.conf.get(_CLEANUP, "false"))
        _cleaning[session] = inside + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            inside, before = _cleaning.pop(session)
            if inside > 1:
                _cleaning[session] = inside - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


class Scratch:
    """A folder of written tables that belong to one run."""

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.path = f"{shared_root(spark)}/salesmart/{label}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str, derive: dict[str, Callable[[], Column]] | None = None, **options: str) -> DataFrame:
        """Write ``df`` once and return a reader over the files.

        Columns in ``derive`` follow from the others: the files leave them out, and a reader that asks for one works it out.
        """
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        stored = df.drop(*(derive or {}))
        with dropping_shuffles(df.sparkSession):
            stored.write.options(**options).parquet(path)
        rows = self.spark.read.schema(stored.schema).parquet(path)
        return rows.withColumns({key: make() for key, make in derive.items()}).select(*df.columns) if derive else rows

    def part(self, name: str) -> "Scratch":
        """A folder within this one, for tables that can be dropped before the rest."""
        inner = copy.copy(self)
        inner.path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        return inner

    def drop(self) -> None:
        """Delete this run's own folder; call it once nothing reads from the tables any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
