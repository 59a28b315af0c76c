"""Session set-up and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: WeakKeyDictionary[SparkSession, tuple[int, str]] = WeakKeyDictionary()
_LOCK = threading.Lock()


def get_spark(app: str = "cardlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    UTC keeps dates, hashes and oracle comparisons independent of the machine.
    Adaptive execution re-plans joins from measured shuffle sizes, splits
    skewed join partitions and coalesces small ones; none of it is hand-tuned.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode
    session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its executor, so that is an error.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="cardlake-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when the write has ended. Otherwise they
    stay until the driver collects its garbage, so a load of several steps would hold
    those of all. Loads may run side by side: the setting stays until the last has ended.
    """
    with _LOCK:
        running, before = _FREEING.get(spark, (0, spark.conf.get(CLEANUP_CONF, "false")))
        _FREEING[spark] = (running + 1, before)
        spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        with _LOCK:
            running, before = _FREEING.pop(spark)
            if running > 1:
                _FREEING[spark] = (running - 1, before)
            else:
                spark.conf.set(CLEANUP_CONF, before)
