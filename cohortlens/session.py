"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext, SparkFiles
from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on, and let AQE split skewed joins everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Python workers hold a batch or two at a time; rows may be long.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    ship_package(spark.sparkContext)
    return spark


def ship_package(context: SparkContext) -> None:
    """Send this package to the workers once, whatever folder the driver was started from."""
    if getattr(context, "_cohortlens_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # Spark serves the archive from its own folder on the driver and removes it at the end.
    folder = os.path.join(SparkFiles.getRootDirectory(), f"source-{uuid.uuid4().hex}")
    os.makedirs(folder)
    archive = os.path.join(folder, "cohortlens-source.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for place, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(place, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._cohortlens_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, from spark.checkpoint.dir.

    A session in local mode that has none, where driver and executor are one process, gets a
    temporary one that goes when Python ends; any other must be configured.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="cohortlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Results made and kept in here leave no shuffle files; else these stay until the driver happens to
    collect its garbage. For plans that run once, as into a checkpoint."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use every core on rows that arrive in a few small parts; a no-op on large inputs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() * 2 <= cores
    return df.repartition(cores, *keys) if few else df
