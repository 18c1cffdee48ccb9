"""Live frames with state per key in Spark's state store.

All three operators work the same way. A first, windowed aggregation gathers what
a key got within a short span and gives it out once the watermark has passed, so
late rows find their place and a hot key is spread over its spans. What reaches
the keyed state is one row per key and span, in order, and the state is touched
only for keys with such a row (or a timer that is due).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.numeric import whole_division
from tidemark.operators.frames import (
    ALERT_PENDING,
    AUTONOMOUS,
    FRAME_STEP_US,
    HISTORY_LENGTH,
    IDLE,
    SAMPLES_PER_FRAME,
    check_mode,
    drop_nulls_in_signal,
    frame_columns,
    micros,
    partials,
)

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: History points looked at together.
_ROLL = 4096


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which keyed state needs."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def write_frames(
    frames: DataFrame, folder: str, checkpoint: str, once: bool = False, interval: str = "30 seconds"
) -> StreamingQuery:
    """Append the frames of a stream to ``folder``, each exactly once.

    ``folder`` belongs to one checkpoint; start both anew together.
    """
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    with keyed_state(frames.sparkSession):
        return (
            frames.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .option("path", folder)
            .outputMode("append")
            .trigger(**trigger)
            .start()
        )


def _all(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True)


def _repeated(value, count: int) -> pd.Series:
    # As objects: strings of pandas' own kind come in pieces that Spark does not take.
    return pd.Series([value] * count, dtype=object)


#: A key's column on its way through keyed state, whatever its own name. Names of
#: columns that go in must not begin with an underscore.
KEY = "stream_key"


def _schema(stream: DataFrame, key: str, *fields: str) -> T.StructType:
    kinds = {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}
    named = [T.StructField(name, kinds[kind]) for name, kind in (field.split() for field in fields)]
    return T.StructType([T.StructField(KEY, stream.schema[key].dataType), *named])


# --- frames by count ----------------------------------------------------------
class _Counting(StatefulProcessor):
    """The open frame of a key: number, sum, maximum and count."""

    def __init__(self, samples: int) -> None:
        self.samples = samples

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "frame long, total double, peak double, count long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        runs = _all(rows).sort_values("begin")
        values = np.concatenate([np.asarray(run, np.float64) for run in runs["run"]])
        frame, total, peak, count = self.open.get() if self.open.exists() else (0, 0.0, -np.inf, 0)
        # The first frame goes on where the open one stands.
        starts = np.arange(self.samples - count, len(values), self.samples)
        starts = np.concatenate([[0], starts]).astype(np.int64)
        sums, peaks = np.add.reduceat(values, starts), np.maximum.reduceat(values, starts)
        counts = np.diff(np.append(starts, len(values)))
        sums[0] += total
        peaks[0] = max(peaks[0], peak)
        counts[0] += count
        numbers = frame + np.arange(len(starts))
        full = counts == self.samples
        if full[-1]:
            self.open.update((int(numbers[-1]) + 1, 0.0, -np.inf, 0))
        else:
            self.open.update((int(numbers[-1]), float(sums[-1]), float(peaks[-1]), int(counts[-1])))
        yield pd.DataFrame(
            {
                KEY: _repeated(key[0], int(full.sum())), "frame": numbers[full], "_sum": sums[full],
                "_max": peaks[full], "_count": counts[full].astype(np.int64),
            }
        )

    def close(self) -> None:
        pass


def stream_count_frames(
    stream: DataFrame,
    value: str,
    key: str,
    order: Sequence[str],
    mode: str,
    profile: str,
    label: str,
    samples: int = SAMPLES_PER_FRAME,
    span: str = "10 seconds",
    delay: str = "10 seconds",
) -> DataFrame:
    """Frames of exactly ``samples`` values per key from an unbounded stream.

    Values are put in ``order``, which begins with the event time; a value counts
    once the watermark has passed its ``span``, and those later than ``delay`` are
    dropped. A frame is given out when it is full.
    """
    check_mode(mode)
    signal = drop_nulls_in_signal(stream, value).select(
        key, F.col(order[0]).cast("timestamp").alias("_time"),
        F.struct(*order, F.col(value).cast("double").alias("_value")).alias("_sample"),
    )
    runs = (
        signal.withWatermark("_time", delay)
        .groupBy(key, F.window("_time", span).alias("_window"))
        .agg(F.array_sort(F.collect_list("_sample")).alias("_samples"))
        .select(F.col(key).alias(KEY), F.unix_micros("_window.start").alias("begin"), F.col("_samples._value").alias("run"))
    )
    framed = runs.groupBy(KEY).transformWithStateInPandas(
        _Counting(samples),
        _schema(stream, key, "frame long", "_sum double", "_max double", "_count long"),
        "Append", "None",
    )
    return framed.select(F.col(KEY).alias(key), "frame", *frame_columns(profile, label, mode))


# --- frames by time, gaps included --------------------------------------------
class _Gaps(StatefulProcessor):
    """The next frame a key has to give out; a timer rings when it has passed unseen."""

    def __init__(self, origin: int, step: int) -> None:
        self.origin, self.step = origin, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "frame long")

    def _wait(self, upcoming: int) -> None:
        self.next.update((upcoming,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        end = self.origin + (upcoming + 1) * self.step
        self.handle.registerTimer(-(-end // 1000))

    def _rows(self, key, begin, last, total, peak, count) -> pd.DataFrame:
        return pd.DataFrame(
            {
                KEY: _repeated(key[0], len(begin)), "frame": begin, "last_frame": last,
                "_sum": total, "_max": peak, "_count": count,
            }
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed = _all(rows).sort_values("frame")
        closed = closed[closed["frame"] >= 0]
        upcoming = self.next.get()[0] if self.next.exists() else 0
        frames = closed["frame"].to_numpy(np.int64)
        if len(frames):
            if frames[0] < upcoming:
                raise RuntimeError(f"frame {frames[0]} closed after frame {upcoming - 1}")
            before = np.concatenate([[upcoming], frames[:-1] + 1])
            gap = frames > before
            nothing = np.full(int(gap.sum()), np.nan)
            yield self._rows(key, before[gap], frames[gap] - 1, nothing, nothing, np.zeros(len(nothing), np.int64))
            yield self._rows(key, frames, frames, *(closed[name].to_numpy() for name in ("total", "peak", "seen")))
            upcoming = int(frames[-1]) + 1
        self._wait(upcoming)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # All windows that end by the watermark have come in before any timer rings.
        upcoming = self.next.get()[0]
        last = (timerValues.getCurrentWatermarkInMs() * 1000 - self.origin) // self.step - 1
        if last >= upcoming:
            yield self._rows(key, [upcoming], [last], [np.nan], [np.nan], [0])
            upcoming = last + 1
        self._wait(upcoming)

    def close(self) -> None:
        pass


def stream_idle_frames(
    stream: DataFrame,
    value: str,
    key: str,
    time: str,
    mode: str,
    profile: str,
    label: str,
    start: datetime,
    step_us: int = FRAME_STEP_US,
    delay: str = "10 seconds",
) -> DataFrame:
    """Time frames of a stream from ``start`` on; what has no sample is an ``idle`` range.

    A key that has been seen once gets every frame up to the watermark: windows
    with samples as ``frame`` = ``last_frame``, gaps as one row however long they
    are. Gaps end by the next sample or by a timer as the watermark of all keys
    goes on, so a silent key turns idle too. :func:`expand_idle` lists the frames.
    """
    check_mode(mode)
    origin = micros(start)
    signal = stream.select(
        key, F.col(time).cast("timestamp").alias("_time"), F.col(value).cast("double").alias("_value")
    )
    offset = f"{origin % step_us} microseconds"
    step = f"{step_us} microseconds"
    closed = (
        signal.withWatermark("_time", delay)
        .groupBy(key, F.window("_time", step, step, offset).alias("_window"))
        .agg(*partials("_value"))
    )
    past = F.unix_micros("_window.start") - F.lit(origin)
    framed = (
        closed.select(
            F.col(key).alias(KEY), whole_division(past - F.pmod(past, F.lit(step_us)), step_us).alias("frame"),
            F.col("_sum").alias("total"), F.col("_max").alias("peak"), F.col("_count").alias("seen"),
        )
        .groupBy(KEY)
        .transformWithStateInPandas(
            _Gaps(origin, step_us),
            _schema(stream, key, "frame long", "last_frame long", "_sum double", "_max double", "_count long"),
            "Append", "EventTime",
        )
    )
    return framed.select(F.col(KEY).alias(key), "frame", "last_frame", *frame_columns(profile, label, mode))


def expand_idle(ranges: DataFrame, start: datetime, step_us: int = FRAME_STEP_US) -> DataFrame:
    """One row per frame, with the time it begins, from frames and idle ranges."""
    begins = F.timestamp_micros(F.lit(micros(start)) + F.col("frame") * F.lit(step_us))
    others = [name for name in ranges.columns if name not in ("frame", "last_frame")]
    listed = ranges.select(*others, F.explode(F.sequence("frame", "last_frame")).alias("frame"))
    return listed.withColumn("frame_start", begins.cast("timestamp_ntz"))


# --- history ------------------------------------------------------------------
class _Rolling(StatefulProcessor):
    """The last points of a key, its last frame, and whether an alert is pending."""

    def __init__(self, length: int) -> None:
        self.length = length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.points = handle.getListState("points", "value double")
        self.last = handle.getValueState("last", "frame long, pending boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = [event for part in _all(rows)["events"] for event in part]
        events.sort(key=lambda event: (event["frame"], event["reset"]))
        before, pending = self.last.get() if self.last.exists() else (None, False)
        # An alert holds from an idle frame on, until a reset that came after it.
        place = np.arange(len(events))
        idle = np.maximum.accumulate(np.where([event["idle"] for event in events], place, -1))
        reset = np.maximum.accumulate(np.where([event["reset"] for event in events], place, -1))
        alert = (idle > reset) | ((idle < 0) & (reset < 0) & pending)
        own = np.array([not event["reset"] for event in events])
        frames = np.array([event["frame"] for event in events], np.int64)[own]
        first = frames[:1] if before is None else [before + 1]
        if len(frames) and (frames != first[0] + np.arange(len(frames))).any():
            raise RuntimeError("frames must be numbered without gaps")
        known = [point[0] for point in self.points.get()] if self.points.exists() else []
        values = [event["value"] for event, mine in zip(events, own, strict=True) if mine]
        line = np.array([np.nan] * (self.length - len(known) - 1) + known[-(self.length - 1) :] + values)
        for begin in range(0, len(frames), _ROLL):
            stop = min(begin + _ROLL, len(frames))
            recent = np.lib.stride_tricks.sliding_window_view(line[begin : stop + self.length - 1], self.length)
            yield pd.DataFrame(
                {
                    KEY: _repeated(key[0], stop - begin),
                    "frame": frames[begin:stop],
                    "metric_value": line[begin + self.length - 1 : stop + self.length - 1],
                    "history_count": (~np.isnan(recent)).sum(axis=1),
                    "history_min": np.nanmin(recent, axis=1),
                    "history_max": np.nanmax(recent, axis=1),
                    "history_avg": np.nanmean(recent, axis=1),
                    "hardware_status": np.where(alert[own][begin:stop], ALERT_PENDING, AUTONOMOUS).astype(object),
                }
            )
        kept = (known + values)[-(self.length - 1) :] if self.length > 1 else []
        self.points.put([(float(value),) for value in kept]) if kept else self.points.clear()
        after = int(frames[-1]) if len(frames) else before
        self.last.update((after, bool(alert[-1])))

    def close(self) -> None:
        pass


def stream_frame_history(
    frames: DataFrame,
    key: str,
    time: str,
    length: int = HISTORY_LENGTH,
    resets: DataFrame | None = None,
    span: str = "10 seconds",
    delay: str = "10 seconds",
) -> DataFrame:
    """Rolling view over a stream of frames, and the alert that an operator resets.

    ``frames`` has key, frame (without gaps per key), metric_value, status and
    ``time``; ``resets``, a stream of its own, has key, frame and ``time``: after
    which frame, and a time before the next frame's. Both meet in one stream with
    one watermark, so neither holds up the other when it is silent.
    """
    def event(value: Column, idle: Column, reset: bool) -> Column:
        return F.struct(
            F.col("frame").cast("bigint").alias("frame"), F.lit(reset).alias("reset"),
            value.cast("double").alias("value"), idle.alias("idle"),
        ).alias("_event")

    moment = F.col(time).cast("timestamp").alias("_time")
    events = frames.select(key, moment, event(F.col("metric_value"), F.col("status") == IDLE, False))
    if resets is not None:
        events = events.union(resets.select(key, moment, event(F.lit(None), F.lit(False), True)))
    gathered = (
        events.withWatermark("_time", delay)
        .groupBy(key, F.window("_time", span).alias("_window"))
        .agg(F.collect_list("_event").alias("events"))
        .select(F.col(key).alias(KEY), "events")
    )
    return gathered.groupBy(KEY).transformWithStateInPandas(
        _Rolling(length),
        _schema(
            frames, key, "frame long", "metric_value double", "history_count long", "history_min double",
            "history_max double", "history_avg double", "hardware_status string",
        ),
        "Append", "None",
    ).withColumnRenamed(KEY, key)
