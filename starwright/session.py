"""Session set-up and scratch tables.

Work that must not be recomputed (row numbering, change sets) is written once as a
Parquet table in the cluster's shared checkpoint folder and read back.  That cuts the
lineage, survives the loss of executors, and gives Catalyst true file sizes, so its
broadcast threshold is a real size check.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

CONCURRENT_STEPS = 8

_LOCAL_DIRS: dict[str, str] = {}
#: Folder of the scratch tables of a step, while one runs that removes them.
_PASSING: ContextVar[str | None] = ContextVar("passing", default=None)


def build_session(app_name: str, cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        # Months of a fact are listed by the driver, not by a job of their own.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "512")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for scratch tables, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    app_id = spark.conf.get("spark.app.id", "local")
    if shared:
        return f"{shared.rstrip('/')}/starwright/{app_id}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if app_id not in _LOCAL_DIRS:
        _LOCAL_DIRS[app_id] = tempfile.mkdtemp(prefix="starwright-")
    return _LOCAL_DIRS[app_id]


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system knows it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; none if it does not exist."""
    system, folder = file_system(spark, path)
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


def delete(spark: SparkSession, path: str) -> None:
    system, folder = file_system(spark, path)
    system.delete(folder, True)


def remove_scratch(spark: SparkSession) -> None:
    """Remove the scratch tables of this application; frames that read them end with it."""
    delete(spark, work_dir(spark))


def size_of(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes in some folders."""
    total = 0
    for path in paths:
        system, folder = file_system(spark, path)
        total += system.getContentSummary(folder).getLength()
    return total


def beyond_broadcast(written: DataFrame) -> bool:
    """Whether a written table is larger than what the session broadcasts by itself."""
    spark = written.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return True
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return size_of(spark, written.inputFiles()) > bytes_of(limit)


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of frames that nobody holds any more.

    It does so whenever the driver's garbage is collected, which a driver with memory to spare
    hardly ever needs, so a job's disks would keep the shuffles of all its steps.  What holds on to
    them goes in a first collection, they go in a second one.
    """
    gc.collect()
    for _ in range(2):
        spark._jvm.System.gc()


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside are removed at the end; frames that read them end with them."""
    folder = scratch_path(spark, "step")
    token = _PASSING.set(folder)
    try:
        yield
    finally:
        _PASSING.reset(token)
        delete(spark, folder)


def scratch_path(spark: SparkSession, label: str, lasting: bool = False) -> str:
    folder = work_dir(spark) if lasting else _PASSING.get() or work_dir(spark)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, lasting: bool = False, **options: str) -> DataFrame:
    """Write ``df`` once as a scratch table and return a scan of it; ``options`` of the writer.

    A ``lasting`` one outlives a step that removes its scratch tables.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label, lasting)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(work: Callable[[str], T], names: Sequence[str]) -> dict[str, T]:
    """Run independent steps at the same time, so that small ones do not idle the cluster."""
    with ThreadPoolExecutor(max_workers=CONCURRENT_STEPS) as pool:
        # Each step runs in a copy of this thread's context, so its scratch tables go where ours go.
        steps = [(copy_context(), name) for name in names]
        return dict(zip(names, pool.map(lambda step: step[0].run(work, step[1]), steps)))
