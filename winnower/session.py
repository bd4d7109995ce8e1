"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A fan-out write keeps one open file per destination instead of sorting each task by destination.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Every column expression would otherwise record its Python call site, which costs more than planning it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The JVM does not compile methods above this size; larger stages run as split projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
    # Keyed state lives off-heap and spills to disk, so its size is not bound by executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str, master: str | None = None, conf: Mapping[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def scoped_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set runtime SQL settings (dots written as double underscores) and put the old values back."""
    wanted = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="winnower-")
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/winnower/{purpose}-{uuid.uuid4().hex}"


def is_committed(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder went through to its end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """Last parts of the paths that match a pattern, sorted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().getName() for status in found or ())


def committed_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the folders that match a pattern and whose write went through to its end, sorted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().getParent().getName() for status in found or ())


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a finished folder to where readers look. It fails if the target is there already.

    One step on a file system that renames folders; on a store that copies objects instead, use a broker.
    """
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    system = paths[0].getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(paths[1].getParent())
    if system.exists(paths[1]) or not system.rename(*paths):
        raise FileExistsError(f"cannot move {source} to {target}")


def streaming_query_id(spark: SparkSession) -> str:
    """Inside a micro-batch, the id that its query keeps in its checkpoint."""
    known = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not known:
        raise RuntimeError("not within a micro-batch of a streaming query")
    return known
