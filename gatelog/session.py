"""Session settings and scratch space."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on, and keep streaming state off the heap.

    Event times are TIMESTAMP_NTZ; truncation and epoch functions go through
    TIMESTAMP, which is lossless only when the session zone is UTC. State of the retry
    check grows with the tokens seen within its delay, so it goes to RocksDB.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


@lru_cache(maxsize=1)
def _own_folder() -> str:
    """For runs in one process (tests, bench): a folder that goes when the process ends."""
    path = tempfile.mkdtemp(prefix="gatelog-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, the folder that driver and executors share.

    Where the setting is absent, a run within one process uses a folder of its own; any other raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = _own_folder()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def together(spark: SparkSession, steps: Iterable[Callable]) -> list:
    """Results of steps that do not depend on each other, whose Spark jobs run side by side.

    All have ended when this returns or raises.
    """
    targets = [inheritable_thread_target(spark)(step) for step in steps]
    with ThreadPoolExecutor(max(len(targets), 1)) as pool:
        running = [pool.submit(target) for target in targets]
    return [step.result() for step in running]
