"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options every result depends on.

    Validity intervals and ingestion times are UTC instants, and strict parsing
    means that a bad cast fails the job instead of giving null.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return spark


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillhouse")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


#: The folder of the innermost ``scratch`` block this code runs in.
_scope: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


def _shared(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    return tempfile.mkdtemp(prefix="tillhouse-")


def work_dir(spark: SparkSession) -> str:
    """A new folder under the one named by ``spark.checkpoint.dir``, or under the ``scratch`` block's own.

    Every executor must see it. Only a local master may fall back to a folder of
    this machine; a cluster without the setting is refused.
    """
    return f"{_scope.get() or _shared(spark)}/{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediate files of the block are removed at its end, also when it fails.

    For blocks that store their results: a frame that still reads such files must not leave the block.
    """
    folder = work_dir(spark)
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        remove(spark, folder)


def _store(spark: SparkSession, location: str):
    """The file system of a location, and the location in it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    store, path = _store(spark, location)
    return store.exists(path)


def folders(spark: SparkSession, location: str) -> list[str]:
    """Names of what lies in a folder, in order; nothing if there is no such folder."""
    store, path = _store(spark, location)
    return sorted(found.getPath().getName() for found in store.listStatus(path)) if store.exists(path) else []


def remove(spark: SparkSession, location: str) -> None:
    store, path = _store(spark, location)
    store.delete(path, True)


def together(*steps: Callable[[], Any]) -> list[Any]:
    """Run independent steps at the same time and return their results in order.

    Spark runs the jobs of several threads side by side, so the last tasks of one step
    do not leave the other executors idle.
    """
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        started = [pool.submit(contextvars.copy_context().run, step) for step in steps]
        return [future.result() for future in started]


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where one result feeds several plans: it cuts the lineage, survives the
    loss of executors, and keeps the expensive upstream from being run again.
    """
    spark = df.sparkSession
    path = path or work_dir(spark)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
