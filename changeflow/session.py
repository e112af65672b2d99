"""Session settings and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants; partition counts stay with the cluster's operator,
# AQE coalesces them at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="changeflow-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has written to, inside the shared folder."""
    return f"{shared_dir(spark)}/changeflow/{label}-{uuid.uuid4().hex}"


#: Spark's setting by which files of a write's shuffles go when the write is done. Without it
#: they stay until the driver's JVM happens to collect what refers to them.
SPENT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def save(df: DataFrame, path: str) -> None:
    """Write the rows as Parquet; the files of the shuffles that this took go at once."""
    conf = df.sparkSession.conf
    before = conf.get(SPENT, "false")
    conf.set(SPENT, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SPENT, before)


def written(df: DataFrame, label: str, held: list[str] | None = None) -> DataFrame:
    """The same rows, written once to the shared folder and read back.

    Later uses neither compute them again nor lose them with an executor, and
    Spark plans with their size on disk instead of a guess. The folder's path is added to
    ``held``, if given, for ``release``.
    """
    path = fresh_dir(df.sparkSession, label)
    save(df, path)
    if held is not None:
        held.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, held: list[str]) -> None:
    """Delete written tables that nothing will read again."""
    while held:
        remove_dir(spark, held.pop())


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per session.

    Only the operators that run Python in tasks need it.
    """
    context = spark.sparkContext
    if getattr(context, "_changeflow_shipped", False):
        return
    package = Path(__file__).resolve().parent
    base = tempfile.mkdtemp(prefix="changeflow-package-")
    archive = shutil.make_archive(f"{base}/changeflow", "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._changeflow_shipped = True


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, on whatever file system."""
    system, place = _file_system(spark, path)
    return system.exists(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if it is not there."""
    system, place = _file_system(spark, path)
    return [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, on whatever file system holds it."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def remove_file(spark: SparkSession, path: str) -> None:
    """Delete a file this library wrote, and its folder if that holds no other rows."""
    system, place = _file_system(spark, path)
    system.delete(place, False)
    folder = place.getParent()
    if system.exists(folder) and not any(
            f.getPath().getName().startswith("part-") for f in system.listStatus(folder)):
        system.delete(folder, True)
