"""Intermediate results that outlive executors, kept in the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import getpass
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK = "/tmp/checkpoints"
_PASSING = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A session on a local master that names none gets one under /tmp; on a cluster, where executors would write to
    disks of their own there, the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors of {master} share")
        base = f"file://{_LOCAL_FALLBACK}/{getpass.getuser()}"
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = store.makeQualified(path).toString().rstrip("/")
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark)}/tallgrass/{name}-{uuid.uuid4().hex}"
    _note(path)
    return path


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.stash_path = path
    return kept


def discard(df: DataFrame) -> None:
    """Delete what ``stash`` wrote; nothing that is still to run may read it."""
    remove(df.sparkSession, df.stash_path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _note(path: str) -> None:
    levels = getattr(_PASSING, "levels", None)
    if levels:
        levels[-1].append(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Delete at the end what was stashed meanwhile, but for what the yielded function was called with.

    What is kept is passed on to the enclosing block, if there is one: a lazy result reads it later.
    """
    levels = _PASSING.levels = getattr(_PASSING, "levels", None) or []
    levels.append([])
    kept: set[str] = set()
    try:
        yield lambda *frames: kept.update(x if isinstance(x, str) else x.stash_path for x in frames)
    finally:
        for path in levels.pop():
            if path in kept:
                _note(path)
            else:
                remove(spark, path)
