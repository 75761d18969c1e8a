"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the layers of the mart rely on for speed, none of it for correctness.
MART_CONF = {
    # Tables in buckets by customer are joined by customer and date where they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # The JVM does not compile methods above 8000 bytes; a stage that wide runs
    # faster as several smaller generated methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


@contextmanager
def mart_settings(spark: SparkSession) -> Iterator[None]:
    """Run writes with ``MART_CONF`` in a session made elsewhere; its own settings come back."""
    before = {key: spark.conf.get(key) for key in MART_CONF}
    try:
        for key, value in MART_CONF.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def get_session(app: str = "creditmart", **conf: str) -> SparkSession:
    """A session with the settings the mart relies on for speed, none for correctness.

    Shuffle sizing is left to adaptive execution: it starts from
    ``spark.sql.shuffle.partitions`` and merges or splits by bytes.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.ui.enabled", "false")
        # Files of checkpoints go when their last reference does.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Recording the call site of every column slows the building of wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**MART_CONF, **conf}.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Folders made for local sessions that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without ``spark.checkpoint.dir``, as in tests, gets a
    folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="creditmart-")
    return _LOCAL_FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never reused."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
