"""Shared storage and size checks used by every plan."""

from __future__ import annotations

import tempfile
import uuid
import warnings
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# A side is broadcast only below these sizes; every caller has another way beyond.
MAX_BROADCAST_ROWS = 16_384
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
MAX_LOOKUP_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="kindred-")
    warnings.warn(f"spark.checkpoint.dir is not set; this local session stores its tables in {folder}", stacklevel=2)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _job_dir(spark: SparkSession) -> str:
    """This application's folder of stored tables, or the one of the :func:`scratch` block it is in.

    Its removal is left to the driver's file system, which does it when the application ends.
    """
    name = f"kindred-{spark.sparkContext.applicationId}"
    folder = f"{shared_dir(spark)}/{name}"
    if folder not in _FOLDERS:
        path, system = _file_system(spark, folder)
        system.mkdirs(path)
        system.deleteOnExit(path)
        _FOLDERS.add(folder)
    inner = _SCRATCH.get()
    return f"{folder}/{inner}" if inner else folder


def _file_system(spark: SparkSession, folder: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Remove what is stored inside the block when it ends; gives a ``stored`` whose tables outlive the block.

    Results that read other tables of the block must be written before. Blocks may be nested; threads have their own.
    """
    outer = _SCRATCH.get()
    inner = f"{outer + '/' if outer else ''}scratch-{uuid.uuid4().hex}"

    def keep(df: DataFrame, name: str) -> DataFrame:
        _SCRATCH.set(outer)
        try:
            return stored(df, name)
        finally:
            _SCRATCH.set(inner)

    _SCRATCH.set(inner)
    try:
        yield keep
    finally:
        path, system = _file_system(spark, _job_dir(spark))
        _SCRATCH.set(outer)
        system.delete(path, True)


def table_dir(spark: SparkSession, name: str) -> str:
    return f"{_job_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    The lineage ends at the files, so a lost executor costs a re-read and not a
    re-run, and several readers share one computation.
    """
    spark = df.sparkSession
    path = table_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_all(parts: Iterable[DataFrame], path: str) -> DataFrame:
    """The same for tables of one schema, written one after the other into one table at ``path``; at least one."""
    for part in parts:
        part.write.mode("append").parquet(path)
    return part.sparkSession.read.schema(part.schema).parquet(path)


def spread(table: DataFrame, key: str) -> DataFrame:
    """Deal a table with too few splits out over all cores before heavy work per row.

    Only small tables have fewer splits than two per core; a large one is left as it lies.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() < 2 * cores else table


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="kindred-")) / "kindred.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()
_FOLDERS: set[str] = set()
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)
