"""The downsampled channel of a profile, from whichever tier has it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.frames import SAMPLES_PER_FRAME, signal_downsample
from tidemark.profiles import ROBOTICS, metric_spec
from tidemark.sources.lakehouse import Lakehouse


def load_signal(lake: Lakehouse) -> tuple[DataFrame, str] | None:
    """Signal table and column: Silver first, then Bronze.

    Robotics Bronze only has joint lists; their peak is derived there.
    """
    profile = lake.profile
    found = lake.first_available(profile.signal)
    if found is None and profile.name == ROBOTICS.name:
        found = lake.first_available([("bronze", profile.bronze_table, "joint_positions")])
        if found is not None:
            peak = F.array_max("joint_positions")
            return found[0].withColumn("peak_joint_pos", peak), "peak_joint_pos"
    return found


def profile_frames(
    lake: Lakehouse,
    stream: str,
    order: Sequence[str],
    samples: int = SAMPLES_PER_FRAME,
) -> DataFrame | None:
    """Frames of the profile's channel per ``stream``; None without any signal."""
    found = load_signal(lake)
    if found is None:
        return None
    df, column = found
    label, mode = metric_spec(lake.profile)
    return signal_downsample(
        df, column, stream, order, mode, lake.profile.name, label, samples
    )
