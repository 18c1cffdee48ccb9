"""Downsampling of live signals by time; frames with state per key are in :mod:`stateful`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.frames import (
    FRAME_STEP_US,
    check_mode,
    drop_nulls_in_signal,
    frame_columns,
    partials,
)


def stream_downsample_time(
    stream: DataFrame,
    value: str,
    key: str,
    time: str,
    mode: str,
    profile: str,
    label: str,
    step_us: int = FRAME_STEP_US,
    delay: str = "10 seconds",
) -> DataFrame:
    """Tumbling time frames per key; works on a stream and on a batch.

    Frames are (key, window) groups with partial aggregation, so a hot key
    spreads over its windows. Samples later than ``delay`` are dropped.
    """
    check_mode(mode)
    signal = drop_nulls_in_signal(stream, value).select(
        key, F.col(time).cast("timestamp").alias("_time"), F.col(value).cast("double").alias("_value")
    )
    windows = (
        signal.withWatermark("_time", delay)
        .groupBy(key, F.window("_time", f"{step_us} microseconds").alias("_window"))
        .agg(*partials("_value"))
    )
    return windows.select(
        key,
        F.col("_window.start").cast("timestamp_ntz").alias("frame_start"),
        *frame_columns(profile, label, mode),
    )


def write_time_frames(
    frames: DataFrame, folder: str, checkpoint: str, once: bool = False, interval: str = "30 seconds"
) -> StreamingQuery:
    """Write the frames that each micro-batch touched, open ones included.

    A micro-batch overwrites its own folder, so a replay after a failure repeats
    nothing, and the newest windows need no later row to close them.
    ``folder`` belongs to one checkpoint; start both anew together.
    """

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={batch}")

    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        frames.writeStream.option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def read_time_frames(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """The newest state of every frame written so far."""
    written = spark.read.parquet(folder)
    values = [c for c in written.columns if c not in (key, "frame_start", "batch")]
    newest = written.groupBy(key, "frame_start").agg(F.max_by(F.struct(*values), "batch").alias("_newest"))
    return newest.select(key, "frame_start", "_newest.*")
