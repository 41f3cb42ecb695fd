"""Session set-up and the folder that every executor can reach."""

from __future__ import annotations

import atexit
import contextvars
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# Adaptive execution re-plans joins from measured sizes: it coalesces small shuffle partitions,
# splits skewed ones and switches to a broadcast only when the finished stage is known to be small.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a task gets after coalescing; sorted and hashed it takes some thirty times as much memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.session.timeZone": "UTC",
    "spark.scheduler.mode": "FAIR",
}

#: Bytes of stored input per shuffle partition before coalescing.
PARTITION_BYTES = 8 << 20

_local_folder: str | None = None


def open_session(app_name: str = "tillwork", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the scale settings; ``settings`` use ``__`` for dots (``spark__ui__enabled="false"``)."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in SCALE_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def use_scale_settings(spark: SparkSession, folder: str | None = None) -> None:
    """Set the SQL part of the scale settings on a session somebody else has opened.

    With the ``folder`` of the input, shuffles begin with a number of partitions that grows with it, at least the configured one:
    adaptive execution can put small ones together, but apart from skewed joins it never cuts a large one, and what a task holds in
    memory would grow with the input.
    """
    for name, value in SCALE_SETTINGS.items():
        if name.startswith("spark.sql."):
            spark.conf.set(name, value)
    if folder is not None:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session may leave it unset and gets a temporary folder. On a cluster that would be
    one machine's disk, so there the setting is required; whether a ``file:`` path it names is a mounted share is up to
    whoever sets it.
    """
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tillwork-")
    return _local_folder


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``new_folder``, in whatever store it lies."""
    _remove(spark._jvm, spark._jsc.hadoopConfiguration(), path)


def _remove(jvm, configuration, path: str) -> None:
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(configuration).delete(place, True)


#: The folder of this process below each shared folder, and the folders made since each open ``scratch`` began.
_process_folders: dict[str, str] = {}
_open_scratches: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scratches", default=())


def process_folder(spark: SparkSession) -> str:
    """What all scratch data of this process lies below; it goes when the process ends, also after a failure."""
    shared = shared_folder(spark)
    if shared not in _process_folders:
        _process_folders[shared] = f"{shared}/tillwork-{uuid.uuid4().hex}"
        atexit.register(_remove_at_exit, spark._jvm, spark._jsc.hadoopConfiguration(), _process_folders[shared])
    return _process_folders[shared]


def _remove_at_exit(jvm, configuration, path: str) -> None:
    with suppress(Py4JError, OSError):  # the JVM may be gone before
        _remove(jvm, configuration, path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier call has used."""
    folder = f"{process_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for made in _open_scratches.get()[-1:]:
        made.append(folder)
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders made in this block are removed at its end: whatever is to stay is written to one made before it."""
    made: list[str] = []
    before = _open_scratches.set((*_open_scratches.get(), made))
    try:
        yield
    finally:
        _open_scratches.reset(before)
        for folder in made:
            remove_folder(spark, folder)
