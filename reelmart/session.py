"""Sessions and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager, suppress
from functools import cache

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "reelmart") -> SparkSession:
    """Session for tests and benches on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "4m")  # small tables, but all cores
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="reelmart-wh-"))
        .getOrCreate()
    )


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for one action, restored afterwards."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="reelmart-ckpt-")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a single-machine session may fall back to a temporary folder: on a cluster the executors
    could not read it back.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = _local_folder()
    return configured


_ROOTS: dict[str, str] = {}


def _scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared one; it is removed when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = f"{checkpoint_dir(spark).rstrip('/')}/reelmart-{uuid.uuid4().hex}"
        atexit.register(_remove_at_exit, spark, _ROOTS[app])
    return _ROOTS[app]


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    with suppress(Py4JError, OSError):  # the JVM may be gone; what it left is then for whoever cleans the shared folder
        remove(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for tables written during one run, in the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, whatever its file system; an absent one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialized(df: DataFrame, name: str = "kept") -> tuple[DataFrame, str]:
    """The rows written as Parquet in the shared folder, and where: cuts the lineage, survives lost executors.

    Columns are kept as columns; the caller removes the folder when the rows are no longer needed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path
