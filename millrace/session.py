"""Session settings and the shared working folder.

Nothing here sizes a cluster: executors, memory and shuffle partitions belong to the
submitter.  ``prepare`` only fixes settings that results or skew handling depend on.
"""

from __future__ import annotations

import os
import queue
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import Future

from pyspark import InheritableThread
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join partition even if the split costs a further exchange above it.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session somebody else built."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int = 8, app: str = "millrace") -> SparkSession:
    """A single-machine session for tests and ``bench.py``."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = os.path.join(tempfile.gettempdir(), f"millrace-{os.getpid()}")
    os.makedirs(fallback, exist_ok=True)
    return fallback


#: Steps that ``together`` runs at once; the driver plans as many.
AT_ONCE = 3


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What the steps return, run at the same time: for steps that do not need each other, as of several tables.

    All have ended before the first error, in the order of the steps, is raised.  Most of a step on small tables is the
    driver's planning and waiting, which one step after the other would leave the executors idle for.  The threads have no
    active session, as frames bring theirs; so PySpark does not ask the JVM for the call site of every column expression.
    """
    ended = [Future() for _ in steps]
    waiting = queue.SimpleQueue()
    for pair in zip(steps, ended):
        waiting.put(pair)

    def run() -> None:
        while True:
            try:
                step, into = waiting.get_nowait()
            except queue.Empty:
                return
            try:
                into.set_result(step())
            except BaseException as problem:  # noqa: BLE001
                into.set_exception(problem)

    threads = [InheritableThread(target=run, session=spark) for _ in steps[:AT_ONCE]]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return [into.result() for into in ended]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so nothing must be cleared."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
