from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import frames
from tidemark.operators.ranking import position_in

T0 = datetime(2026, 1, 1)


def _hot(rng, n=4000):
    """One stream holds most rows; some ties in time; a null stream."""
    stream = rng.choice(["hot", "cold", "warm", None], n, p=[0.8, 0.1, 0.05, 0.05])
    return pd.DataFrame(
        {"stream": stream, "t": rng.integers(0, n // 4, n), "id": rng.permutation(n), "v": rng.normal(size=n)}
    )


def test_positions_equal_row_numbers(spark):
    data = _hot(np.random.default_rng(3))
    out = position_in(spark.createDataFrame(data), ["t", "id"], ["stream"], width=60).toPandas()
    want = data.sort_values(["t", "id"]).copy()
    want["position"] = want.groupby("stream", dropna=False).cumcount()
    got = out.set_index("id")["position"].to_dict()
    assert got == want.set_index("id")["position"].to_dict()


def test_positions_without_key_and_with_start(spark):
    data = _hot(np.random.default_rng(4), 500)
    df = spark.createDataFrame(data)
    out = position_in(df, ["t", "id"], width=20).toPandas().sort_values(["t", "id"])
    assert list(out["position"]) == list(range(500))
    begin = spark.createDataFrame([("hot", 10)], "stream string, position bigint")
    moved = position_in(df, ["t", "id"], ["stream"], width=20, start=begin).toPandas()
    assert moved[moved.stream == "hot"]["position"].min() == 10
    assert moved[moved.stream == "cold"]["position"].min() == 0
    assert position_in(df.limit(0), ["t", "id"]).count() == 0


def test_identical_rows_each_get_a_position(spark):
    df = spark.createDataFrame([("a", 1)] * 100, "s string, t int")
    out = [r.position for r in position_in(df, ["t"], ["s"]).collect()]
    assert sorted(out) == list(range(100))


@pytest.mark.parametrize(
    "kind, make",
    [
        ("bigint", lambda i: (i - 40) * 3),
        ("double", lambda i: [float("nan"), float("inf"), float("-inf"), -0.0][i % 9] if i % 9 < 4 else (i - 40) / 7),
        ("timestamp_ntz", lambda i: T0 + timedelta(minutes=17 * (i - 40))),
        ("timestamp", lambda i: T0 + timedelta(minutes=17 * (i - 40))),
        ("date", lambda i: (T0 + timedelta(days=i // 3)).date()),
        ("string", lambda i: f"k{i * 7 % 50}"),
    ],
)
def test_positions_in_any_order(spark, kind, make):
    """A third of the rows has no time and is ordered by the second column."""
    rows = [("ab"[i % 2], None if i % 3 == 0 else make(i), i * 31 % 80 - 40) for i in range(80)]
    df = spark.createDataFrame(rows, f"s string, t {kind}, id bigint")
    number = F.row_number().over(Window.partitionBy("s").orderBy("t", "id")) - 1
    want = {(r.s, r.id): r.n for r in df.select("s", "id", number.alias("n")).collect()}
    for width in (None, 7):
        got = {(r.s, r.id): r.position for r in position_in(df, ["t", "id"], ["s"], width=width).collect()}
        assert got == want


def test_a_hot_stream_is_cut_in_buckets(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("s"), F.col("id").alias("t"))
    out = position_in(df, ["t"], ["s"], width=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Rows are shuffled once, by key and bucket, and numbered there.
    assert "rangepartitioning" not in plan and "row_number() windowspecdefinition(_key_part" in plan
    assert out.filter("position <> t").isEmpty() and out.count() == 10_000


@pytest.mark.parametrize("mode", ["mean", "max"])
def test_downsample_equals_brute_force(spark, mode):
    data = _hot(np.random.default_rng(5)).dropna()
    data.loc[data.index[::9], "v"] = np.nan
    df = spark.createDataFrame(data).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    out = frames.signal_downsample(
        df, "v", "stream", ["t", "id"], mode, "P", "L", width=50
    ).toPandas().sort_values(["stream", "frame"])
    want = []
    for stream, part in data.dropna().sort_values(["t", "id"]).groupby("stream"):
        values = part["v"].to_numpy()
        for i in range(0, len(values), 17):
            cut = values[i : i + 17]
            want.append((stream, i // 17, cut.max() if mode == "max" else cut.mean(), len(cut)))
    assert len(out) == len(want)
    np.testing.assert_array_equal(out["sample_count"], [w[3] for w in want])
    np.testing.assert_allclose(out["metric_value"], [w[2] for w in want], atol=5.1e-5)
    assert set(out["status"]) == {"streaming"}
    assert set(out["label"]) == {"L"} and set(out["profile"]) == {"P"}


def test_small_frames(spark):
    assert frames.SAMPLES_PER_FRAME == 17
    df = spark.createDataFrame([("a", 1, 0.1), ("a", 2, 0.9), ("a", 3, 0.3)], "s string, t int, v double")
    row = frames.signal_downsample(df, "v", "s", ["t"], "max", "P", "L").first()
    assert (row.metric_value, row.sample_count) == (0.9, 3)
    flags = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, None)], "s string, t int, v boolean")
    row = frames.signal_downsample(flags, "v", "s", ["t"], "mean", "P", "L").first()
    assert (row.metric_value, row.sample_count) == (0.5, 2)
    with pytest.raises(ValueError):
        frames.signal_downsample(df, "v", "s", ["t"], "median", "P", "L")


def test_idle_frames_fill_gaps(spark):
    rows = [("a", T0, 10.0), ("a", T0 + timedelta(microseconds=33_333), 20.0),
            ("a", T0 + timedelta(microseconds=33_334), 30.0), ("b", T0 + timedelta(seconds=1), 5.0),
            ("a", T0 + timedelta(seconds=9), 99.0)]
    df = spark.createDataFrame(rows, "s string, t timestamp_ntz, v double")
    out = frames.idle_frames(
        df, "v", "s", "t", "mean", "P", "L", T0, T0 + timedelta(microseconds=33_333 * 40)
    ).toPandas()
    assert len(out) == 80
    a = out[out.s == "a"].set_index("frame")
    assert a.loc[0, "metric_value"] == 10.0 and a.loc[1, "metric_value"] == 25.0
    assert a.loc[1, "frame_start"] == pd.Timestamp(T0) + pd.Timedelta(microseconds=33_333)
    assert tuple(a.loc[2, ["metric_value", "sample_count", "status"]]) == (0.0, 0, "idle")
    assert (out[out.s == "b"].status == "idle").sum() == 39


def test_grid_spans_chunks(spark):
    streams = spark.createDataFrame([("a",), ("b",)], "s string")
    grid = frames._grid(streams, "s", 0, 25_000)
    assert grid.count() == 2 * 25_001 and grid.distinct().count() == 2 * 25_001


def test_history_equals_rolling(spark):
    rng = np.random.default_rng(6)
    data = pd.concat(
        [
            pd.DataFrame(
                {"s": s, "frame": range(n), "metric_value": rng.normal(size=n).round(4),
                 "status": ["idle" if i == idle else "streaming" for i in range(n)]}
            )
            for s, n, idle in (("a", 700, 450), ("b", 130, -1), ("c", 1, 0))
        ]
    )
    out = frames.frame_history(spark.createDataFrame(data), "s", length=120, chunk=119).toPandas()
    assert len(out) == len(data)
    for s, part in data.groupby("s"):
        got = out[out.s == s].sort_values("frame").reset_index(drop=True)
        rolling = part["metric_value"].reset_index(drop=True).rolling(120, min_periods=1)
        np.testing.assert_allclose(got["history_avg"], rolling.mean(), atol=1e-12)
        np.testing.assert_array_equal(got["history_max"], rolling.max())
        np.testing.assert_array_equal(got["history_min"], rolling.min())
        np.testing.assert_array_equal(got["history_count"], np.minimum(np.arange(len(part)) + 1, 120))
        alert = (part["status"] == "idle").cummax().to_numpy()
        assert list(got["hardware_status"] == "ALERT_PENDING") == list(alert)
    state = {r.s: r for r in frames.latest_history(spark.createDataFrame(data), "s").collect()}
    assert state["a"].history == list(data[data.s == "a"]["metric_value"].iloc[-120:])
    assert state["b"].hardware_status == "AUTONOMOUS" and state["c"].hardware_status == "ALERT_PENDING"
    with pytest.raises(ValueError):
        frames.frame_history(spark.createDataFrame(data), "s", length=120, chunk=50)


def test_signal_comes_from_the_best_tier(spark, lake, salt):
    from tidemark.plans import medallion, signals
    from tidemark.profiles import HEALTH_TECH, ROBOTICS

    house = lake(ROBOTICS)
    assert signals.profile_frames(house, "robot_id", ["timestamp"]) is None
    rows = [(T0 + timedelta(milliseconds=20 * i), "r", "Apollo-1", [float(i), -1.0], "u", "NO_FAILURE", True)
            for i in range(20)]
    medallion.ingest(house, spark.createDataFrame(rows, ROBOTICS.schema), salt)
    def found():
        out = signals.profile_frames(house, "robot_id", ["timestamp"]).orderBy("frame").collect()
        return [(r.label, r.metric_value, r.sample_count) for r in out]
    want = [("peak_torque_nm", 16.0, 17), ("peak_torque_nm", 19.0, 3)]
    assert found() == want
    medallion.enforce(house, salt)
    assert found() == want
    assert signals.load_signal(house)[0].columns[4] == "peak_joint_pos"
    assert signals.load_signal(lake(HEALTH_TECH)) is None


def test_history_keeps_the_stream_without_a_name(spark):
    rows = [(s, i, float(i), "idle" if i == 3 else "streaming") for s in ("a", None) for i in range(5)]
    df = spark.createDataFrame(rows, "stream string, frame long, metric_value double, status string")
    rolled = frames.frame_history(df, "stream", length=3, chunk=4)
    assert rolled.count() == 10 and rolled.where("hardware_status <> 'AUTONOMOUS'").count() == 4
    latest = {r.stream: list(r.history) for r in frames.latest_history(df, "stream", 3).collect()}
    assert latest == {"a": [2.0, 3.0, 4.0], None: [2.0, 3.0, 4.0]}


def test_alert_ends_with_a_reset(spark):
    """Against a plain replay, with resets on chunk borders and in a stream without a name."""
    idle = {"a": {3, 7, 20}, None: {0, 11}}
    done = {"a": {3, 9, 15}, None: {0, 4}}
    rows, want = [], {}
    for s in idle:
        pending = False
        for i in range(26):
            pending |= i in idle[s]
            want[s, i] = pending
            rows.append((s, i, float(i), "idle" if i in idle[s] else "streaming"))
            pending &= i not in done[s]
    df = spark.createDataFrame(rows, "stream string, frame long, metric_value double, status string")
    resets = spark.createDataFrame([(s, i) for s in done for i in done[s]] * 2, "stream string, frame long")
    out = frames.frame_history(df, "stream", length=3, chunk=4, resets=resets)
    assert out.columns == df.columns + ["history_count", "history_min", "history_max", "history_avg", "hardware_status"]
    assert {(r.stream, r.frame): r.hardware_status == "ALERT_PENDING" for r in out.collect()} == want
    latest = frames.latest_history(df, "stream", 3, resets).collect()
    assert {r.stream: r.hardware_status == "ALERT_PENDING" for r in latest} == {"a": True, None: True}
    later = resets.union(spark.createDataFrame([("a", 25)], resets.schema))
    latest = frames.latest_history(df, "stream", 3, later).collect()
    assert {r.stream: r.hardware_status == "ALERT_PENDING" for r in latest} == {"a": False, None: True}


@pytest.mark.parametrize("numbers", [[0, 1, 3], [0, 50], [0, 1, 1], range(0, 400, 10)])
def test_history_over_gaps_fails(spark, numbers):
    df = spark.createDataFrame(
        [("a", i, 1.0, "streaming") for i in numbers], "s string, frame long, metric_value double, status string"
    )
    with pytest.raises(Exception, match="without gaps"):
        frames.frame_history(df, "s", length=3, chunk=4).collect()
    if max(numbers) > 3:
        with pytest.raises(Exception, match="without gaps"):
            frames.latest_history(df, "s", 3).collect()
