"""Where jobs may write data that other executors have to see."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one the cluster names, or below that of the run.

    Only a local session without the setting (tests) falls back to a folder of
    this machine; on a cluster the setting is required.
    """
    root = _RUN.get() or spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_SETTING} must name a shared folder")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, purpose: str = "run") -> Iterator[str]:
    """A shared folder for all steps that are written inside, deleted at the end.

    Results read these steps, so write them elsewhere before it ends.
    """
    path = shared_folder(spark, purpose)
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        delete(spark, [path])


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files or whole folders of any file system that Spark knows."""
    jvm = spark.sparkContext._jvm
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(settings).delete(path, True)
