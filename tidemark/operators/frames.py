"""Downsampling of high-rate signals to frames, idle gaps, and frame history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_away, whole_division
from tidemark.operators.ranking import position_in

# --- Fixed values: rates, digits, states --------------------------------------
SOURCE_HZ = 500
FRAME_HZ = 30
SAMPLES_PER_FRAME = max(1, round(SOURCE_HZ / FRAME_HZ))
FRAME_STEP_US = 33_333
METRIC_DIGITS = 4
STREAMING = "streaming"
IDLE = "idle"
HISTORY_LENGTH = 120
ALERT_PENDING = "ALERT_PENDING"
AUTONOMOUS = "AUTONOMOUS"
# ------------------------------------------------------------------------------

MODES = ("max", "mean")
_GRID_CHUNK = 10_000


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {', '.join(MODES)}")
    return mode


def drop_nulls_in_signal(df: DataFrame, value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull())


def assign_frames(
    df: DataFrame,
    stream: str,
    order: Sequence[str],
    samples: int = SAMPLES_PER_FRAME,
    width: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Number consecutive groups of ``samples`` rows of each stream as ``frame``."""
    placed = position_in(df, order, [stream], name="_position", width=width, keep=keep)
    frame = whole_division(F.col("_position"), samples)
    return placed.withColumn("frame", frame).drop("_position")


def metric_value(total: Column, peak: Column, count: Column, mode: str) -> Column:
    """Rounded frame value from partial aggregates; 0.0 for an empty frame."""
    value = peak if check_mode(mode) == "max" else total / count
    return F.when(count > 0, round_half_away(value, METRIC_DIGITS)).otherwise(F.lit(0.0))


def frame_columns(profile: str, label: str, mode: str) -> list[Column]:
    """The frame record from the partial aggregates ``_sum``, ``_max`` and ``_count``."""
    return [
        F.lit(profile).alias("profile"),
        F.lit(label).alias("label"),
        metric_value(F.col("_sum"), F.col("_max"), F.col("_count"), mode).alias("metric_value"),
        F.col("_count").alias("sample_count"),
        F.when(F.col("_count") > 0, STREAMING).otherwise(IDLE).alias("status"),
    ]


def partials(value: str) -> list[Column]:
    """Mergeable aggregates of a signal; booleans count as 0 and 1."""
    number = F.col(value).cast("double")
    return [
        F.sum(number).alias("_sum"),
        F.max(number).alias("_max"),
        F.count(number).alias("_count"),
    ]


def signal_downsample(
    df: DataFrame,
    value: str,
    stream: str,
    order: Sequence[str],
    mode: str,
    profile: str,
    label: str,
    samples: int = SAMPLES_PER_FRAME,
    width: int | None = None,
) -> DataFrame:
    """One frame per ``samples`` non-null values; the last one keeps its true count.

    Only the stream, order and value columns travel. The rows of a frame arrive
    side by side, so partial aggregation shrinks them ``samples`` to one.
    """
    check_mode(mode)
    needed = dict.fromkeys([stream, *order, value])
    narrow = drop_nulls_in_signal(df.select(*needed), value)
    framed = assign_frames(narrow, stream, order, samples, width, keep=[value])
    grouped = framed.groupBy(stream, "frame").agg(*partials(value))
    return grouped.select(stream, "frame", *frame_columns(profile, label, mode))


# --- frames by time -----------------------------------------------------------
def micros(moment: datetime) -> int:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    whole = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (whole.days * 86_400 + whole.seconds) * 1_000_000 + whole.microseconds


def _grid(streams: DataFrame, stream: str, first: int, last: int) -> DataFrame:
    """Every (stream, frame) from ``first`` to ``last``.

    Expanded in two steps, spread out in between: no task builds more than a
    chunk of frame numbers at a time, however long the range is.
    """
    chunks = streams.select(
        stream,
        F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(_GRID_CHUNK))).alias("_from"),
    ).repartition(stream, "_from")
    upto = F.least(F.col("_from") + F.lit(_GRID_CHUNK - 1), F.lit(last))
    return chunks.select(stream, F.explode(F.sequence(F.col("_from"), upto)).alias("frame"))


def idle_frames(
    df: DataFrame,
    value: str,
    stream: str,
    time: str,
    mode: str,
    profile: str,
    label: str,
    start: datetime,
    end: datetime,
    step_us: int = FRAME_STEP_US,
) -> DataFrame:
    """Fixed-length time frames from ``start`` to before ``end``, gaps included.

    A window without samples becomes an ``idle`` frame of value 0.0. The empty
    grid and the samples meet in one aggregation instead of a join.
    """
    check_mode(mode)
    origin, stop = micros(start), micros(end)
    moment = F.unix_micros(F.col(time).cast("timestamp"))
    inside = (
        drop_nulls_in_signal(df, value)
        .filter((moment >= F.lit(origin)) & (moment < F.lit(stop)))
        .select(
            stream,
            whole_division(moment - F.lit(origin), step_us).alias("frame"),
            F.col(value).cast("double").alias("_value"),
        )
    )
    last = max(0, (stop - origin - 1) // step_us)
    streams = df.select(stream).distinct()
    empty = _grid(streams, stream, 0, last).withColumn("_value", F.lit(None).cast("double"))
    grouped = inside.unionByName(empty).groupBy(stream, "frame").agg(*partials("_value"))
    begins = F.timestamp_micros(F.lit(origin) + F.col("frame") * F.lit(step_us))
    return grouped.select(
        stream,
        "frame",
        begins.cast("timestamp_ntz").alias("frame_start"),
        *frame_columns(profile, label, mode),
    )


def _beside(left: DataFrame, right: DataFrame, stream: str, *keys: str, how: str = "inner") -> DataFrame:
    """Rows of ``left`` with those of ``right`` of the same stream and keys; null is a stream too."""
    renamed = right.withColumnsRenamed({name: f"_r{name}" for name in (stream, *keys)})
    same = left[stream].eqNullSafe(renamed[f"_r{stream}"])
    for name in keys:
        same &= left[name] == renamed[f"_r{name}"]
    return left.join(renamed, same, how).drop(*[f"_r{name}" for name in (stream, *keys)])


def _alert(idle: Column, reset: Column) -> Column:
    """Pending if the last idle frame came after the last reset."""
    pending = idle.isNotNull() & (reset.isNull() | (idle > reset))
    return F.when(pending, ALERT_PENDING).otherwise(AUTONOMOUS)


def _dense(condition: Column) -> Column:
    return F.when(condition, True).otherwise(F.raise_error(F.lit("frames must be numbered without gaps")))


# --- history ------------------------------------------------------------------
def frame_history(
    frames: DataFrame,
    stream: str,
    length: int = HISTORY_LENGTH,
    chunk: int = 50_000,
    resets: DataFrame | None = None,
) -> DataFrame:
    """Rolling view over the last ``length`` frames, and the sticky alert state.

    Frames are numbered without gaps per stream (others fail), so a stream is cut
    in chunks by frame number and each chunk gets the ``length - 1`` frames before
    it as a copy; the window then runs per (stream, chunk) and a hot stream is
    spread over many tasks. An alert stays from an idle frame on until the
    operator resets it: ``resets`` has (stream, frame), each after that frame.
    What earlier chunks leave behind is one row per chunk.
    """
    reach = length - 1
    if chunk < reach:
        raise ValueError("a chunk must be at least as long as the history")
    home = whole_division(F.col("frame"), chunk)
    if resets is None:
        marked = frames.withColumn("_reset", F.lit(None).cast("bigint"))
    else:
        once = resets.select(stream, "frame").distinct().withColumn("_reset", F.col("frame").cast("bigint"))
        marked = _beside(frames, once, stream, "frame", how="left")
    marked = marked.withColumn("_idle", F.when(F.col("status") == IDLE, F.col("frame")))
    next_too = F.pmod(F.col("frame"), F.lit(chunk)) >= F.lit(chunk - reach)
    copies = F.when(next_too, F.array(home, home + 1)).otherwise(F.array(home))
    spread = marked.select("*", F.explode(copies).alias("_chunk"))

    # Copies of earlier frames may take part in these too: they did come before.
    ordered = Window.partitionBy(stream, "_chunk").orderBy("frame")
    recent = ordered.rowsBetween(-reach, 0)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rolled = spread.select(
        "*",
        F.count(F.lit(1)).over(recent).alias("history_count"),
        F.min("metric_value").over(recent).alias("history_min"),
        F.max("metric_value").over(recent).alias("history_max"),
        F.avg("metric_value").over(recent).alias("history_avg"),
        F.lag("frame").over(ordered).alias("_previous"),
        F.max("_idle").over(so_far).alias("_last_idle"),
        F.max("_reset").over(before).alias("_last_reset"),
    ).filter(F.col("_chunk") == home)

    chunks = marked.groupBy(stream, home.alias("_chunk")).agg(
        F.max("frame").alias("_frame"), F.max("_idle").alias("_idle"), F.max("_reset").alias("_reset")
    )
    earlier = Window.partitionBy(stream).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    left_behind = chunks.select(
        stream,
        "_chunk",
        F.max("_frame").over(earlier).alias("_frame_before"),
        F.max("_idle").over(earlier).alias("_idle_before"),
        F.max("_reset").over(earlier).alias("_reset_before"),
    )
    previous = F.coalesce("_previous", "_frame_before")
    state = _alert(F.greatest("_last_idle", "_idle_before"), F.greatest("_last_reset", "_reset_before"))
    return (
        _beside(rolled, left_behind, stream, "_chunk")
        .filter(_dense(previous.isNull() | (F.col("frame") == previous + 1)))
        .select(*rolled.columns, state.alias("hardware_status"))
        .drop("_chunk", "_idle", "_reset", "_previous", "_last_idle", "_last_reset")
    )


def latest_history(
    frames: DataFrame, stream: str, length: int = HISTORY_LENGTH, resets: DataFrame | None = None
) -> DataFrame:
    """The current state of each stream: latest frame and its last ``length`` values.

    Frames are numbered without gaps (others fail), so the last ones are found by
    number; each group collected has at most ``length`` entries.
    """
    newest = frames.groupBy(stream).agg(
        F.min("frame").alias("_first"),
        F.max("frame").alias("latest_frame"),
        F.max(F.when(F.col("status") == IDLE, F.col("frame"))).alias("_last_idle"),
    )
    if resets is None:
        newest = newest.withColumn("_last_reset", F.lit(None).cast("bigint"))
    else:
        last = resets.groupBy(stream).agg(F.max("frame").cast("bigint").alias("_last_reset"))
        newest = _beside(newest, last, stream, how="left")
    facts = [c for c in newest.columns if c != stream]
    tail = (
        _beside(frames, newest, stream)
        .filter(F.col("frame") > F.col("latest_frame") - F.lit(length))
        .groupBy(stream, *facts)
        .agg(F.sort_array(F.collect_list(F.struct("frame", "metric_value"))).alias("_points"))
    )
    expected = F.least(F.lit(length), F.col("latest_frame") - F.col("_first") + 1)
    return tail.filter(_dense(F.size("_points") == expected)).select(
        stream,
        "latest_frame",
        F.col("_points.metric_value").alias("history"),
        _alert(F.col("_last_idle"), F.col("_last_reset")).alias("hardware_status"),
    )
