"""Where a session keeps what it writes on its way, and how Python code of this package reaches the workers."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch; with texts of a few kilobytes a larger batch holds much memory outside the heap.
BATCH_ROWS = 1000
_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Workers take Arrow's memory from the C library, so that ``_trim`` gives it back as well.
_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2"}

_ROOT = str(Path(__file__).resolve().parent.parent)


def reachable(spark: SparkSession) -> None:
    """Adds the folder that holds the package to the workers' module path.

    On a cluster the package should be installed, or sent with ``--py-files``; this
    serves sessions whose workers share the driver's file system.
    """
    environment = spark.sparkContext.environment
    have = environment.get("PYTHONPATH", "")
    if _ROOT not in have.split(":"):
        environment["PYTHONPATH"] = f"{_ROOT}:{have}".rstrip(":")
    for name, value in _MEMORY.items():
        environment.setdefault(name, value)


def ready(spark: SparkSession) -> None:
    """Makes the package reachable, and Arrow batches no larger than BATCH_ROWS rows.

    The number is a setting of the session, which is lowered if it is higher.
    """
    reachable(spark)
    if not 0 < int(spark.conf.get(_RECORDS)) <= BATCH_ROWS:
        spark.conf.set(_RECORDS, str(BATCH_ROWS))


def _trim() -> None:
    """Gives freed memory back to the system, where the C library can; workers live on between tasks."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        environment.setdefault(name, value)


_held: dict[str, dict] = {}


def held(module: str) -> dict:
    """What a worker keeps between tasks for the functions of a module, until a function of another module runs there."""
    return _held.setdefault(module, {})


def released(module: str) -> None:
    """Drops what is kept for the functions of all other modules."""
    others = [kept for name, kept in _held.items() if name != module and kept]
    for kept in others:
        kept.clear()
    if others:
        gc.collect()
        _trim()


def arrow_map(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` in a session that is ``ready``; a worker keeps no freed memory beyond its task."""
    ready(df.sparkSession)
    module = function.__module__

    def run(batches: Iterator) -> Iterator:
        released(module)
        try:
            yield from function(batches)
        finally:
            _trim()

    return df.mapInArrow(run, schema)


_made: set[str] = set()
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset (a local test), a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = _local.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="quarry-")
        _local[spark.sparkContext.applicationId] = where
    return where.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, removed when this process ends."""
    root = f"{shared_dir(spark)}/quarry-{spark.sparkContext.applicationId}"
    if root not in _made:
        _made.add(root)
        atexit.register(_remove, spark, root)
    return f"{root}/{uuid.uuid4().hex}"


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the JVM may have ended before us
        environment.setdefault(name, value)


def saved(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read again.

    Cuts lineage like ``checkpoint()`` but computes the rows a single time, and
    survives the loss of any executor.  ``dropped`` deletes them.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._quarry_path = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Deletes what ``saved`` wrote for these frames; nothing may read them, or what is made of them, any more."""
    for df in frames:
        if path := getattr(df, "_quarry_path", None):
            _remove(df.sparkSession, path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it knows it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_text(path: str, text: str) -> None:
    """A small file, on the file system that a URI names or on the driver's own."""
    if "://" in path:
        fs, target = file_system(SparkSession.active(), path)
        out = fs.create(target, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text, encoding="utf-8")


def read_bytes(path: str, most: int | None = None) -> bytes:
    """A small file, or the first ``most`` bytes of one."""
    if "://" not in path:
        with open(path, "rb") as f:
            return f.read() if most is None else f.read(most)
    fs, target = file_system(SparkSession.active(), path)
    stream = fs.open(target)
    try:
        size = fs.getFileStatus(target).getLen()
        return bytes(SparkSession.active().sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size if most is None else min(most, size)))
    finally:
        stream.close()
