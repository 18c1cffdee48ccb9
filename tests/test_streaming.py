import os
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import flywheel, frames
from tidemark.profiles import CLINICAL, ROBOTICS
from tidemark.streaming import stateful
from tidemark.streaming.downsample import stream_downsample_time
from tidemark.streaming.ingest import append_scores, stream_bronze_ingest

T0 = datetime(2026, 1, 1)
SIGNAL = "k string, t timestamp_ntz, id bigint, v double"


def _signal(n=700):
    rng = np.random.default_rng(11)
    return pd.DataFrame(
        {
            "k": rng.choice(["hot", "b", "c"], n, p=[0.8, 0.15, 0.05]),
            "t": [T0 + timedelta(milliseconds=int(i) * 20) for i in range(n)],
            "id": range(n),
            "v": rng.integers(0, 100, n).astype(float),
        }
    )


def _files(spark, data, folder, parts):
    """One parquet file per part, older parts first."""
    for i, places in enumerate(np.array_split(np.arange(len(data)), parts)):
        part = data.iloc[places]
        path = folder / f"part-{i:03d}.parquet"
        part.astype({"t": "datetime64[us]"}).to_parquet(path, index=False)
    return spark.readStream.schema(SIGNAL).option("maxFilesPerTrigger", 1).parquet(str(folder))


def _late_signal(n=1500):
    """Samples that arrive up to 0.9 s late; key c falls silent, and one stream has no name."""
    rng = np.random.default_rng(1)
    data = pd.DataFrame(
        {
            "k": rng.choice(["hot", "b", "c", None], n, p=[0.8, 0.1, 0.05, 0.05]),
            "t": [T0 + timedelta(milliseconds=int(i) * 20) for i in range(n)],
            "id": range(n),
            "v": rng.integers(0, 100, n).astype(float),
        }
    )
    data = data[~((data.k == "c") & (data.id > 500))]
    arrival = data.t + pd.to_timedelta(rng.integers(0, 900, len(data)), unit="ms")
    return data.iloc[np.argsort(arrival.values, kind="stable")].reset_index(drop=True)


def _append(data, folder, first, stop, parts=5):
    for i, places in enumerate(np.array_split(np.arange(len(data)), parts)):
        if first <= i < stop:
            path = folder / f"part-{i:03d}.parquet"
            data.iloc[places].astype({"t": "datetime64[us]"}).to_parquet(path, index=False)
            os.utime(path, (1_000_000 + i, 1_000_000 + i))


def _stream(spark, folder, schema=SIGNAL):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def _plain(frame, *columns):
    return sorted(map(tuple, frame.astype(object).where(frame.notna(), None)[list(columns)].values.tolist()), key=str)


FRAME = ("k", "frame", "metric_value", "sample_count", "status")


@pytest.mark.parametrize("mode", ["mean", "max"])
def test_count_frames_over_a_restart_equal_batch(spark, tmp_path, mode):
    data = _late_signal()
    (tmp_path / "in").mkdir()

    def run():
        framed = stateful.stream_count_frames(
            _stream(spark, tmp_path / "in"), "v", "k", ["t", "id"], mode, "P", "L", span="500 milliseconds", delay="1 second"
        )
        query = stateful.write_frames(framed, str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
        query.awaitTermination()
        return query

    _append(data, tmp_path / "in", 0, 3)
    run()
    _append(data, tmp_path / "in", 3, 5)
    run()
    closed = data[data.t < (data.t.max() - timedelta(seconds=1)).floor("500ms")]
    want = frames.signal_downsample(spark.createDataFrame(closed, SIGNAL), "v", "k", ["t", "id"], mode, "P", "L").toPandas()
    got = spark.read.parquet(str(tmp_path / "out")).toPandas()
    assert _plain(got, *FRAME) == _plain(want[want.sample_count == 17], *FRAME) and len(got) > 20
    # nothing new: the same checkpoint repeats nothing
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(got)


def test_state_is_touched_only_for_keys_in_the_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def run(i, keys, second):
        rows = [(k, T0 + timedelta(seconds=second), i, 1.0) for k in keys]
        pd.DataFrame(rows, columns=["k", "t", "id", "v"]).astype({"t": "datetime64[us]"}).to_parquet(
            tmp_path / "in" / f"{i}.parquet", index=False
        )
        framed = stateful.stream_count_frames(
            _stream(spark, tmp_path / "in"), "v", "k", ["t", "id"], "mean", "P", "L", span="1 second", delay="0 seconds"
        )
        query = stateful.write_frames(framed, str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
        query.awaitTermination()
        keyed = [
            operator
            for progress in query.recentProgress
            for operator in progress["stateOperators"]
            if operator["operatorName"].startswith("transformWithState")
        ]
        return sum(operator["numRowsUpdated"] for operator in keyed)

    many = [f"k{i}" for i in range(40)]
    run(0, many, 0)
    assert run(1, ["k1"], 10) <= 41  # the first batch's keys close now, at most one more
    assert run(2, ["k1"], 20) <= 2


def test_idle_frames_of_silent_and_nameless_streams_equal_the_grid(spark, tmp_path):
    data = _late_signal()
    (tmp_path / "in").mkdir()
    step = 100_000

    def run():
        ranges = stateful.stream_idle_frames(
            _stream(spark, tmp_path / "in"), "v", "k", "t", "mean", "P", "L", T0, step_us=step, delay="1 second"
        )
        stateful.write_frames(ranges, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()

    _append(data, tmp_path / "in", 0, 3)
    run()
    _append(data, tmp_path / "in", 3, 5)
    run()
    passed = (data.t.max() - timedelta(seconds=1) - T0) // timedelta(microseconds=step)
    end = T0 + timedelta(microseconds=passed * step)
    want = frames.idle_frames(
        spark.createDataFrame(data, SIGNAL), "v", "k", "t", "mean", "P", "L", T0, end, step_us=step
    ).toPandas()
    ranges = spark.read.parquet(str(tmp_path / "out"))
    got = stateful.expand_idle(ranges, T0, step).toPandas()
    columns = (*FRAME, "frame_start")
    assert _plain(got, *columns) == _plain(want, *columns)
    silent = ranges.where("k = 'c'").agg({"last_frame": "max"}).first()[0]
    assert silent == passed - 1 and ranges.count() < len(got)


def test_idle_frames_before_the_start_and_without_values(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [("a", T0 - timedelta(seconds=5), 1, 1.0), ("b", T0 + timedelta(seconds=1), 2, None), ("a", T0 + timedelta(seconds=9), 3, 2.0)]
    data = pd.DataFrame(rows, columns=["k", "t", "id", "v"])
    data.astype({"t": "datetime64[us]"}).to_parquet(tmp_path / "in" / "0.parquet", index=False)
    ranges = stateful.stream_idle_frames(
        _stream(spark, tmp_path / "in"), "v", "k", "t", "max", "P", "L", T0, step_us=1_000_000, delay="0 seconds"
    )
    stateful.write_frames(ranges, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    got = stateful.expand_idle(spark.read.parquet(str(tmp_path / "out")), T0, 1_000_000).toPandas()
    assert _plain(got, "k", "frame", "status") == [(k, i, "idle") for k in "ab" for i in range(9)]


def _frames_and_resets(n=400):
    rng = np.random.default_rng(4)
    rows, resets = [], []
    for key in ("a", "b", None):
        for i in range(n if key == "a" else 60):
            idle = rng.random() < 0.05
            rows.append((key, i, 0.0 if idle else float(rng.integers(0, 90)), "idle" if idle else "streaming", T0 + timedelta(seconds=i)))
            if i % 17 == 3:
                resets.append((key, i, T0 + timedelta(seconds=i, milliseconds=500)))
    return (
        pd.DataFrame(rows, columns=["k", "frame", "metric_value", "status", "t"]),
        pd.DataFrame(resets, columns=["k", "frame", "t"]),
    )


def test_history_on_a_stream_with_resets_equals_batch(spark, tmp_path):
    made, resets = _frames_and_resets()
    kinds = "k string, frame bigint, metric_value double, status string, t timestamp_ntz"
    reset_kinds = "k string, frame bigint, t timestamp_ntz"
    (tmp_path / "in").mkdir()
    (tmp_path / "resets").mkdir()
    late = np.random.default_rng(5).integers(0, 4000, len(made))
    arrival = made.iloc[np.argsort((made.t + pd.to_timedelta(late, unit="ms")).values, kind="stable")]
    (resets.sort_values("t").astype({"t": "datetime64[us]"})).to_parquet(tmp_path / "resets" / "0.parquet", index=False)

    def run():
        rolled = stateful.stream_frame_history(
            _stream(spark, tmp_path / "in", kinds), "k", "t", length=20,
            resets=spark.readStream.schema(reset_kinds).parquet(str(tmp_path / "resets")), span="3 seconds", delay="500 seconds",
        )
        stateful.write_frames(rolled, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()

    _append(arrival, tmp_path / "in", 0, 3)
    run()
    _append(arrival, tmp_path / "in", 3, 5)
    # a newest frame far ahead lets the watermark pass all others
    ahead = pd.DataFrame([("z", 0, 1.0, "streaming", T0 + timedelta(days=1))], columns=made.columns)
    ahead.astype({"t": "datetime64[us]"}).to_parquet(tmp_path / "in" / "part-009.parquet", index=False)
    run()
    columns = ("k", "frame", "metric_value", "history_count", "history_min", "history_max", "history_avg", "hardware_status")
    want = frames.frame_history(
        spark.createDataFrame(made, kinds), "k", length=20, chunk=100,
        resets=spark.createDataFrame(resets, reset_kinds).select("k", "frame"),
    ).toPandas()
    got = spark.read.parquet(str(tmp_path / "out")).toPandas()
    for df in (got, want):
        df["history_avg"] = df["history_avg"].round(9)
    assert _plain(got, *columns) == _plain(want, *columns)


def test_history_fails_on_a_gap(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [("a", 0, 1.0, "streaming", T0), ("a", 2, 1.0, "streaming", T0 + timedelta(seconds=2)), ("b", 0, 1.0, "idle", T0 + timedelta(hours=1))]
    data = pd.DataFrame(rows, columns=["k", "frame", "metric_value", "status", "t"])
    data.astype({"t": "datetime64[us]"}).to_parquet(tmp_path / "in" / "0.parquet", index=False)
    kinds = "k string, frame bigint, metric_value double, status string, t timestamp_ntz"
    rolled = stateful.stream_frame_history(_stream(spark, tmp_path / "in", kinds), "k", "t", delay="0 seconds")
    with pytest.raises(Exception, match="without gaps"):
        stateful.write_frames(rolled, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()


def test_time_frames_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    data = _signal()
    late = pd.DataFrame({"k": ["hot"], "t": [T0], "id": [10_000], "v": [1e6]})
    (tmp_path / "in").mkdir()
    ordered = pd.concat([data, late])
    stream = _files(spark, ordered, tmp_path / "in", 3)

    def made(df):
        return stream_downsample_time(df, "v", "k", "t", "mean", "P", "L", step_us=100_000, delay="1 second")

    query = (
        made(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .option("path", str(tmp_path / "out"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values(["k", "frame_start"])
    want = made(spark.createDataFrame(data, SIGNAL)).toPandas()
    # windows that end a second before the last row are closed
    last = data["t"].max() - timedelta(seconds=1)
    want = want[want.frame_start + pd.Timedelta(milliseconds=100) <= last].sort_values(["k", "frame_start"])
    pd.testing.assert_frame_equal(
        got.reset_index(drop=True), want.reset_index(drop=True), check_dtype=False
    )


def test_bronze_feed_masks_and_survives_a_restart(spark, lake, salt, tmp_path):
    house = lake(CLINICAL)
    (tmp_path / "in").mkdir()

    def drop(i):
        pd.DataFrame(
            {"patient_id_hashed": [f"PAT-{i}"], "study_id": ["ONC-204"], "extra": [1]}
        ).to_parquet(tmp_path / "in" / f"{i}.parquet", index=False)

    def run():
        raw = spark.readStream.schema("patient_id_hashed string, study_id string, extra bigint").parquet(
            str(tmp_path / "in")
        )
        stream_bronze_ingest(house, raw, str(tmp_path / "cp"), salt, once=True).awaitTermination()
        return house.read_product("bronze", "ecrf_observations_feed")

    drop(1)
    drop(2)
    assert run().count() == 2
    drop(3)
    back = run()
    assert back.count() == 3 and back.columns == CLINICAL.schema.names
    assert {r.patient_id_hashed.split(":")[0] for r in back.collect()} == {"masked_sha256"}


def test_scores_are_appended_once_per_batch(spark, lake, tmp_path):
    house = lake(ROBOTICS)
    (tmp_path / "in").mkdir()
    for i in range(3):
        pd.DataFrame({"episode_id": [f"e{i}"], "vla_feature_vector": [[0.1 * i, -0.2]]}).to_parquet(
            tmp_path / "in" / f"{i}.parquet", index=False
        )
    episodes = (
        spark.readStream.schema("episode_id string, vla_feature_vector array<double>, robot_model_id string")
        .option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "in"))
    )
    events = flywheel.live_events(episodes, "m1", "lab", 5)
    append_scores(house, events, str(tmp_path / "cp"), "feed", once=True).awaitTermination()
    live = house.read_product("bronze", flywheel.LIVE_TABLE)
    assert live.count() == 3 and live.select("inference_id").distinct().count() == 3
    # the same checkpoint again: nothing new
    append_scores(house, events, str(tmp_path / "cp"), "feed", once=True).awaitTermination()
    assert house.read_product("bronze", flywheel.LIVE_TABLE).count() == 3
    # a renewed checkpoint begins at batch 0 again; other files under the same feed all arrive
    (tmp_path / "more").mkdir()
    for i in range(3, 6):
        pd.DataFrame({"episode_id": [f"e{i}"], "vla_feature_vector": [[0.1 * i, -0.2]]}).to_parquet(
            tmp_path / "more" / f"{i}.parquet", index=False
        )
    later = (
        spark.readStream.schema("episode_id string, vla_feature_vector array<double>, robot_model_id string")
        .option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "more"))
    )
    renewed = flywheel.live_events(later, "m1", "lab", 5)
    append_scores(house, renewed, str(tmp_path / "cp2"), "feed", once=True).awaitTermination()
    live = house.read_product("bronze", flywheel.LIVE_TABLE)
    assert live.count() == 6 and live.select("inference_id").distinct().count() == 6


def test_a_batch_that_broke_off_is_completed(spark, lake, tmp_path):
    """Killed between append and mark: the replayed batch adds only what is missing."""
    house = lake(ROBOTICS)
    (tmp_path / "in").mkdir()
    pd.DataFrame({"episode_id": ["a", "b"], "vla_feature_vector": [[0.1], [0.2]]}).to_parquet(
        tmp_path / "in" / "0.parquet", index=False
    )
    episodes = spark.readStream.schema(
        "episode_id string, vla_feature_vector array<double>, robot_model_id string"
    ).parquet(str(tmp_path / "in"))
    events = flywheel.live_events(episodes, "m1", "lab", 5)
    mark, failed = house.set_table_property, []

    def breaking(tier, table, key, value):
        if key.endswith(".done") and not failed:
            failed.append(key)
            raise RuntimeError("killed")
        mark(tier, table, key, value)

    house.set_table_property = breaking
    with pytest.raises(Exception, match="killed"):
        append_scores(house, events, str(tmp_path / "cp"), once=True).awaitTermination()
    append_scores(house, events, str(tmp_path / "cp"), once=True).awaitTermination()
    live = house.read_product("bronze", flywheel.LIVE_TABLE)
    assert failed and sorted(r.episode_id for r in live.collect()) == ["a", "b"]


def test_a_feed_refuses_a_table_with_rows(spark, lake, salt, tmp_path):
    house = lake(CLINICAL)
    rows = spark.createDataFrame([("PAT-1", "ONC-204")], "patient_id_hashed string, study_id string")
    house.append_product("bronze", "ecrf_observations", rows, CLINICAL.schema)
    (tmp_path / "in").mkdir()
    raw = spark.readStream.schema("patient_id_hashed string, study_id string").parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="hide"):
        stream_bronze_ingest(house, raw, str(tmp_path / "cp"), salt, table="ecrf_observations", once=True)
    assert house.read_product("bronze", "ecrf_observations").count() == 1
