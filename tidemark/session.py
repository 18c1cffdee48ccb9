"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on. UTC makes zone-less timestamps and instants
#: agree; ANSI makes a bad cast fail instead of turning into null; the adaptive
#: settings coalesce small shuffle partitions and split skewed join partitions.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with :data:`SESSION_SETTINGS` applied.

    ``extra`` takes further settings with dots written as double underscores,
    e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediate results.

    Call it once no DataFrame built on them is read any more; a job may leave a
    sorted copy of its input there. Returns whether there were any.
    """
    return delete_path(spark, _scratch_root(spark))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the entries of a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().toString() for entry in store.listStatus(target)]


def shared_folder(spark: SparkSession, folder: str) -> str:
    """``folder`` with its file system named, as Spark resolves it.

    A folder on a machine's own disk is refused on a cluster, unless it lies in
    ``spark.checkpoint.dir``, which every executor can reach.
    """
    conf = spark._jsc.hadoopConfiguration()

    def qualified(name: str) -> str:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(conf).makeQualified(path).toString()

    named = qualified(folder)
    local = named.startswith("file:") and not spark.sparkContext.master.startswith("local")
    if local and not f"{named}/".startswith(f"{qualified(checkpoint_root(spark))}/"):
        raise ValueError(f"not every executor can reach {folder}")
    return named


def folder_store(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path, for tasks, of a folder as :func:`shared_folder` names it."""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder (or over ``path``) and read it back.

    This cuts lineage like a checkpoint, but columnar: readers prune columns,
    and the planner knows the true size. Use it where two consumers must see the
    very same partitioning, which recomputation would not promise.
    """
    path = path or scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
