"""Session helpers: a local session for tests and benches, and the shared folder for lineage cuts."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "stationcast") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")   # the horizon fits are concurrent jobs from driver threads
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _path(spark: SparkSession, path: str):
    """A path of any store that Spark reaches, and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def release(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate table that ``shared_dir`` named."""
    target, store = _path(spark, path)
    store.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target, store = _path(spark, path)
    return store.exists(target)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    target, store = _path(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(target)) if store.exists(target) else []


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a folder or file to a name that is not taken."""
    source, store = _path(spark, path)
    target, _ = _path(spark, to)
    if store.exists(target) or not store.rename(source, target):
        raise OSError(f"{path} cannot be renamed to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all: written beside its place, then renamed."""
    aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    target, store = _path(spark, aside)
    out = store.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, aside, path)


def read_text(spark: SparkSession, path: str) -> str:
    target, store = _path(spark, path)
    stream = store.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written and read again: its lineage is cut and it survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., str]]:
    """Names folders like ``shared_dir`` and deletes them all at the end, whether the job ended well or not."""
    made: list[str] = []

    def folder(*parts: str) -> str:
        made.append(shared_dir(spark, *parts))
        return made[-1]

    try:
        yield folder
    finally:
        for path in made:
            release(spark, path)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The setting is read from the session. Only a local-mode session without it (tests) gets a folder of its
    own; on a cluster a missing setting is an error, because machine-local folders do not survive the loss
    of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="stationcast-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    path = os.path.join(root, *parts, uuid.uuid4().hex) if parts else os.path.join(root, uuid.uuid4().hex)
    return path
