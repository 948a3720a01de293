"""Session settings, and frames that a run keeps in the shared folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # The keys of a run's changed accounts, too many to broadcast, still cut the large tables before their shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "512MB",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("activation-mart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def named_folder(spark: SparkSession) -> str | None:
    """The folder all executors share, as the session names it, if it does."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/") if folder else None


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only a local master may fall back to a folder of its own.
    """
    folder = named_folder(spark)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="activation-mart-"))
    return context.getCheckpointDir().rstrip("/")


def remove_files(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, through the file system that holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """What one run settles: a folder of its own, and the tables it registers."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{(folder or shared_folder(spark)).rstrip('/')}/activation-mart/run-{uuid.uuid4().hex}"
        self.tables: list[str] = []

    def path(self, label: str) -> str:
        """A path that nothing else uses."""
        return f"{self.folder}/{label}-{uuid.uuid4().hex}"

    def owns_table(self, name: str) -> None:
        """The table goes with the run; one that lies elsewhere goes with its data."""
        self.tables.append(name)

    def remove(self) -> None:
        """Remove the tables and the folder."""
        while self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop()}")
        remove_files(self.spark, self.folder)


_running: ContextVar[Scratch | None] = ContextVar("activation_mart_scratch", default=None)


@contextmanager
def run_scope(spark: SparkSession, folder: str | None = None) -> Iterator[Scratch]:
    """A run that owns what is settled inside it, and removes that at its end, also after a failure.

    Results have to be written or collected inside, for they read what was
    settled. Runs side by side, in threads or in tasks of an event loop, do not
    see each other's; a run inside a run removes its own part earlier.
    ``folder`` takes the place of the shared one.
    """
    scratch = Scratch(spark, folder)
    token = _running.set(scratch)
    try:
        yield scratch
    finally:
        _running.reset(token)
        scratch.remove()


def current_scratch(spark: SparkSession) -> Scratch:
    """That of the run around the caller; outside of a run one that nobody removes."""
    return _running.get() or Scratch(spark)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # of settled frames
_lock = threading.Lock()
_writes: Counter[SparkSession] = Counter()
_before: dict[SparkSession, str | None] = {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go as soon as it ends, not when the driver collects its garbage.

    For writes, which run once. Several threads may be inside; the last one out
    puts the session's setting back.
    """
    with _lock:
        if not _writes[spark]:
            _before[spark] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _writes[spark] += 1
    try:
        yield
    finally:
        with _lock:
            _writes[spark] -= 1
            if not _writes[spark]:
                del _writes[spark]
                before = _before.pop(spark)
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several branches read to the shared folder, and read it from there.

    Its rows no longer depend on executors staying alive or on being computed
    again alike; branches read only their columns, and its size is known, so
    that Spark broadcasts it where, and only where, it is small. The run around
    it (``run_scope``) owns the files.
    """
    spark = df.sparkSession
    path = current_scratch(spark).path(label)
    with shuffles_removed(spark):
        df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    _paths[rows] = path
    return rows


def discard(*frames: DataFrame) -> None:
    """Remove the files of settled frames early; nothing that reads them may run after that."""
    for rows in frames:
        remove_files(rows.sparkSession, _paths.pop(rows))
