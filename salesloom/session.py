"""Session settings and the shared scratch location."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

# Codec of stored tables: ids are hexadecimal text, which the default codec leaves as large as it is.
CODEC = "zstd"
# Folders a task writes to side by side before it sorts its rows by folder instead.
OPEN_FILES = 16


def build_session(app_name: str = "salesloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tuned for; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a temporary folder: on a cluster other machines cannot see it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            configured = tempfile.mkdtemp(prefix="salesloom-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def table_writer(df: DataFrame, columns: Sequence[str] = ()):
    """A writer for stored tables, by the folders that ``columns`` name.

    Rows that are grouped by folder beforehand leave a task a few folders.  It
    keeps their files open instead of sorting, and spilling, all its rows; a
    session of the user's that has no such setting gets it here.
    """
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    if columns and int(conf.get(name)) == 0:
        conf.set(name, OPEN_FILES)
    return df.write.option("compression", CODEC).partitionBy(*columns)


def _let_go(spark: SparkSession) -> None:
    """Drop the JVM's objects that Python has dropped: the thread that does so looks once a second only."""
    client = spark.sparkContext._gateway._gateway_client
    waiting = getattr(client, "finalizer_deque", None)
    while waiting:
        try:
            entry = waiting.pop()
        except IndexError:  # that thread was faster
            return
        if not isinstance(entry, tuple):  # the sign for that thread to end
            waiting.append(entry)
            return
        entry[0].garbage_collect_object(entry[1], False)


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files, checkpoints and broadcasts of finished steps.

    It does when the driver collects its garbage, which a driver with memory to
    spare rarely does: all steps of a long run would lie on disk side by side.
    The events of the last step name its plan until all listeners have seen
    them, and what the first collection lets go of holds it as well.
    """
    gc.collect()
    _let_go(spark)
    try:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    except Py4JError:  # a bus that lags, or one that cannot be asked: a later step removes what is left
        pass
    system = spark.sparkContext._jvm.System
    system.gc()
    time.sleep(0.1)
    system.gc()


def checkpointed(df):
    """Cut the lineage of ``df`` on reliable storage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
