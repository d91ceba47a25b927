"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

PACKED = {"compression": "zstd"}  # for tables of record texts: half the size of the default, at no more time
_REMOVE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_removing: dict[int, tuple[int, str | None]] = {}  # by session: how many blocks are open, and the setting before the first
_lock = threading.Lock()


def build_session(app: str = "millwright", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    Executors may be lost, so hand-over tables and stream checkpoints must live
    where every node can read them. Only a local master may fall back to a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind, which else lie on disk until the driver collects its garbage."""
    session = spark._jsparkSession.hashCode()  # a stream's batches have a session of their own
    with _lock:
        depth, before = _removing.get(session) or (0, spark.conf.get(_REMOVE, None))
        _removing[session] = depth + 1, before
        spark.conf.set(_REMOVE, "true")
    try:
        yield
    finally:
        with _lock:
            depth, before = _removing.pop(session)
            if depth > 1:
                _removing[session] = depth - 1, before
            elif before is None:
                spark.conf.unset(_REMOVE)
            else:
                spark.conf.set(_REMOVE, before)


def written(df: DataFrame, label: str, path: str | None = None, **options: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder, or at ``path`` for a caller that removes it; ``options`` go to the writer.

    It is computed once however often it is used, survives lost executors, and has a
    measured size when Spark chooses between broadcast and shuffle.
    """
    path = path or scratch_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    """A path and its file system, of whatever store it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _path(spark, path)
    return store.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    store, where = _path(spark, path)
    store.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    store, where = _path(spark, path)
    store.mkdirs(where)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to where another one may stand."""
    store, there = _path(spark, target)
    store.delete(there, True)
    store.mkdirs(there.getParent())
    if not store.rename(_path(spark, source)[1], there):
        raise OSError(f"{source} can't be moved to {target}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none where there is no such path."""
    store, where = _path(spark, path)
    return sorted(x.getPath().getName() for x in store.listStatus(where) if x.isDirectory()) if store.exists(where) else []
