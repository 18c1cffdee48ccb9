"""Helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch. A batch of texts stays a few MB, so that tasks need
#: little memory besides the longest single text.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and bound their Arrow batches."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    handle, name = tempfile.mkstemp(prefix="tidemark-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(name)
    atexit.register(Path(name).unlink, missing_ok=True)
    context._tidemark_shipped = True


def remote(function: Callable, *args) -> Callable:
    """A task's function: imports the module-level ``function`` where it runs and calls it.

    The package's own functions would otherwise travel by value with every task,
    and what a worker keeps between tasks (vocabularies, automata) would be lost.
    """
    module, name = function.__module__, function.__name__

    def run(*given):
        from importlib import import_module

        return getattr(import_module(module), name)(*given, *args)

    return run


def remote_group(function: Callable, *args) -> Callable:
    """The same for a function of a group's key and rows."""
    inner = remote(function, *args)

    def run(key, rows):
        return inner(key, rows)

    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, whole."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def own_columns(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the columns an operator reads, cast; others cannot clash with its own."""
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in kinds.items()))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(column: pa.Array) -> list[str]:
    """A string column as Python strings; null as empty."""
    return [value or "" for value in column.to_pylist()]


def ragged(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def pieces(lengths: list[int], most: int):
    """Consecutive index ranges whose lengths add up to about ``most``; a longer one is alone."""
    begin, held = 0, 0
    for i, length in enumerate(lengths):
        if held and held + length > most:
            yield begin, i
            begin, held = i, 0
        held += length
    if begin < len(lengths):
        yield begin, len(lengths)


def runs(batches, names: list[str]):
    """(key, batches of its rows) for each run of equal integer columns ``names`` of sorted rows."""
    key, held = None, []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(name).to_numpy() for name in names]
        turn = np.zeros(len(batch), bool)
        for column in columns:
            turn[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(turn).tolist(), len(batch)]
        for begin, stop in zip(starts[:-1], starts[1:], strict=True):
            own = tuple(int(column[begin]) for column in columns)
            if own != key and held:
                yield key, held
                held = []
            key = own
            held.append(batch.slice(begin, stop - begin))
    if held:
        yield key, held


#: A key with more than this share of the rows is joined apart, so there are at most this many.
HOT_KEYS = 1000


def join_split(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join with a ``right`` that has one row per key and only fixed-size columns.

    Rows whose key holds more than a thousandth of ``left`` stay where they are:
    the at most thousand keys concerned are sent to them. The rest is shuffled.
    ``left`` is read three times, so it should be written.
    """
    most = left.count() / HOT_KEYS
    hot = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(key)
    sent = F.broadcast(right.join(F.broadcast(hot), key, "left_semi"))
    here = left.join(F.broadcast(hot), key, "left_semi").join(sent, key, "left")
    rest = left.join(F.broadcast(hot), key, "left_anti").join(right, key, "left")
    return here.unionByName(rest)
