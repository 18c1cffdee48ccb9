"""Files that tasks write to, and read from, a folder all executors share.

A file is written beside its place and moved there when complete. Its name and
bytes depend on the task's input only, so a repeated task writes the same file
again and a lost executor leaves at most an unfinished ``.part`` file, which
:func:`remove_unfinished` deletes once the job is over.
"""

from __future__ import annotations

import contextlib
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from tidemark.session import delete_path, list_folder, scratch_path


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the one named in spark.checkpoint.dir, as a URI."""
    path = scratch_path(spark, label)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(hadoop)
    uri = store.makeQualified(hadoop).toString()
    # Hadoop writes file:/path; other readers want an empty host.
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and the path within it; s3a and s3n are names of s3."""
    for alias in ("s3a://", "s3n://"):
        if uri.startswith(alias):
            uri = "s3://" + uri[len(alias):]
    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def whole_file(uri: str):
    """A stream to a file that appears under its name only when it is complete."""
    store, path = locate(uri)
    draft = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with store.open_output_stream(draft) as stream:
            yield stream
        store.move(draft, path)
    except BaseException:
        with contextlib.suppress(OSError):
            store.delete_file(draft)
        raise


def remove_unfinished(spark: SparkSession, folder: str) -> int:
    """Delete what lost tasks left; call it when no task writes to the folder."""
    left = [path for path in list_folder(spark, folder) if path.endswith(".part")]
    for path in left:
        delete_path(spark, path)
    return len(left)
