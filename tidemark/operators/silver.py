"""Silver: drop rows without an identifier, derive one column, keep the rest."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_away
from tidemark.profiles import CLINICAL

# --- Fixed values: limits of the service level and of physiology --------------
PLC_LIMITS = (
    ("measured_voltage", "<", 12.0),
    ("measured_voltage", ">", 16.0),
    ("temperature_c", ">", 95.0),
    ("pressure_bar", ">", 9.5),
)
BIOMETRIC_RANGES = {
    "heart_rate_variability": (5, 200),
    "sleep_efficiency": (0.0, 1.0),
}
# ------------------------------------------------------------------------------

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def drop_null_identifier(df: DataFrame, identifier: str) -> DataFrame:
    return df.filter(F.col(identifier).isNotNull())


def null_out_of_range(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Null values outside their inclusive range; the row itself stays."""
    return df.withColumns(
        {c: F.when(F.col(c).between(low, high), F.col(c)) for c, (low, high) in ranges.items()}
    )


def threshold_breach(limits: Sequence[tuple[str, str, float]]) -> Column:
    """True if any limit is crossed; null if none is known to be but one is unknown."""
    tests = [_COMPARE[sign](F.col(c), F.lit(bound)) for c, sign, bound in limits]
    return reduce(operator.or_, tests)


def silver_robot_signals(bronze: DataFrame) -> DataFrame:
    return drop_null_identifier(bronze, "robot_id").select(
        "timestamp",
        "robot_id",
        "robot_model_id",
        "joint_positions",
        F.array_max("joint_positions").alias("peak_joint_pos"),
        "camera_frame_uri",
        "failure_type_tag",
        "success_flag",
    )


def silver_plc_registers(bronze: DataFrame) -> DataFrame:
    return drop_null_identifier(bronze, "facility_id").withColumn(
        "sla_breach", threshold_breach(PLC_LIMITS)
    )


def silver_wearable_biometrics(bronze: DataFrame) -> DataFrame:
    return null_out_of_range(drop_null_identifier(bronze, "patient_id_hashed"), BIOMETRIC_RANGES)


def silver_subscription_events(bronze: DataFrame) -> DataFrame:
    # The product is taken in single precision, as the column types say; left
    # alone, float times int would widen to double.
    product = (F.col("monthly_revenue") * F.col("tenure_months").cast("float")).cast("float")
    return drop_null_identifier(bronze, "customer_id_hashed").withColumn(
        "lifetime_value", round_half_away(product, 2).cast("float")
    )


def silver_ecrf_observations(bronze: DataFrame) -> DataFrame:
    """Only the declared columns survive, whatever else the feed carries."""
    return drop_null_identifier(bronze, "patient_id_hashed").select(*CLINICAL.schema.names)
