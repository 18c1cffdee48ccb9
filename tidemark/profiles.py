"""Domain profiles: what differs between domains, as data.

A profile is passed as an argument, so several can run in one session.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: vocabularies, table names, column names, metric labels -----
ROBOT_MODELS = ("Figure-01", "Optimus-Gen2", "Atlas-Next", "Apollo-1")
FAILURE_TAGS = (
    "GRASP_FAIL",
    "OVER_TORQUE",
    "VISION_OCCLUSION",
    "PATH_PLAN_TIMEOUT",
    "MOTOR_OVERHEAT",
)
NO_FAILURE = "NO_FAILURE"
FACILITIES = ("Texas_Giga_01", "Berlin_Giga_02")
REGIONS = ("NA", "EU", "APAC")
PLAN_TIERS = ("FREE", "PRO", "ENTERPRISE")
STUDY_IDS = ("ONC-204", "CARD-118", "NEU-330")
AGE_BRACKETS = ("18-29", "30-45", "46-65", "66+")
DEFAULT_PROFILE = "ROBOTICS"
DEFAULT_METRIC = ("mean_signal", "mean")
# ------------------------------------------------------------------------------


def declare(**columns: T.DataType) -> T.StructType:
    """A schema of nullable columns, in the order given."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


@dataclass(frozen=True)
class Profile:
    """Everything a domain declares.

    ``signal`` lists (tier, table, column) candidates for the downsampled
    channel in order of preference; ``metric`` is its label and aggregate.
    """

    name: str
    bronze_table: str
    schema: T.StructType
    sensitive: tuple[str, ...]
    vocabulary: dict[str, tuple[str, ...]]
    index_name: str
    metric: tuple[str, str]
    signal: tuple[tuple[str, str, str], ...]

    @property
    def database_prefix(self) -> str:
        return self.name.lower()


ROBOTICS = Profile(
    name="ROBOTICS",
    bronze_table="robot_signals",
    schema=declare(
        timestamp=T.TimestampNTZType(),
        robot_id=T.StringType(),
        robot_model_id=T.StringType(),
        joint_positions=T.ArrayType(T.FloatType()),
        camera_frame_uri=T.StringType(),
        failure_type_tag=T.StringType(),
        success_flag=T.BooleanType(),
    ),
    sensitive=("robot_id",),
    vocabulary={"failure_type_tag": FAILURE_TAGS, "robot_model_id": ROBOT_MODELS},
    index_name="robotics_episodes",
    metric=("peak_torque_nm", "max"),
    signal=(("silver", "silver_robot_signals", "peak_joint_pos"),),
)

MANUFACTURING = Profile(
    name="MANUFACTURING",
    bronze_table="plc_registers",
    schema=declare(
        timestamp=T.TimestampNTZType(),
        facility_id=T.StringType(),
        register_id=T.StringType(),
        measured_voltage=T.FloatType(),
        temperature_c=T.FloatType(),
        pressure_bar=T.FloatType(),
        anomaly_flag=T.BooleanType(),
    ),
    sensitive=("register_id",),
    vocabulary={"facility_id": FACILITIES},
    index_name="manufacturing_faults",
    metric=("mean_voltage_v", "mean"),
    signal=(
        ("silver", "silver_plc_registers", "measured_voltage"),
        ("bronze", "plc_registers", "measured_voltage"),
    ),
)

HEALTH_TECH = Profile(
    name="HEALTH_TECH",
    bronze_table="wearable_biometrics",
    schema=declare(
        timestamp=T.TimestampNTZType(),
        patient_id_hashed=T.StringType(),
        heart_rate_variability=T.IntegerType(),
        sleep_efficiency=T.FloatType(),
        region=T.StringType(),
    ),
    sensitive=("patient_id_hashed",),
    vocabulary={"region": REGIONS},
    index_name="health_cohort_narratives",
    metric=("mean_hrv_ms", "mean"),
    signal=(
        ("silver", "silver_wearable_biometrics", "heart_rate_variability"),
        ("bronze", "wearable_biometrics", "heart_rate_variability"),
    ),
)

COMMERCIAL = Profile(
    name="COMMERCIAL",
    bronze_table="subscription_events",
    schema=declare(
        timestamp=T.TimestampNTZType(),
        customer_id_hashed=T.StringType(),
        plan_tier=T.StringType(),
        region=T.StringType(),
        monthly_revenue=T.FloatType(),
        tenure_months=T.IntegerType(),
        churned_flag=T.BooleanType(),
    ),
    sensitive=("customer_id_hashed",),
    vocabulary={"plan_tier": PLAN_TIERS, "region": REGIONS},
    index_name="commercial_accounts",
    metric=("mean_monthly_revenue", "mean"),
    signal=(
        ("silver", "silver_subscription_events", "monthly_revenue"),
        ("bronze", "subscription_events", "monthly_revenue"),
    ),
)

CLINICAL = Profile(
    name="CLINICAL",
    bronze_table="ecrf_observations",
    schema=declare(
        timestamp=T.TimestampNTZType(),
        patient_id_hashed=T.StringType(),
        study_id=T.StringType(),
        age_bracket=T.StringType(),
        region=T.StringType(),
        adverse_event_flag=T.BooleanType(),
    ),
    sensitive=("patient_id_hashed",),
    vocabulary={"study_id": STUDY_IDS, "region": REGIONS},
    index_name="clinical_ecrf_narratives",
    metric=("mean_adverse_event_rate", "mean"),
    signal=(
        ("silver", "silver_ecrf_observations", "adverse_event_flag"),
        ("bronze", "ecrf_observations", "adverse_event_flag"),
    ),
)

PROFILES: dict[str, Profile] = {
    p.name: p for p in (ROBOTICS, MANUFACTURING, HEALTH_TECH, COMMERCIAL, CLINICAL)
}


def resolve_profile(name: str | None = None) -> Profile:
    """Look a profile up by name; blanks and case do not matter, none is ROBOTICS."""
    key = DEFAULT_PROFILE if name is None else name.strip().upper()
    if key not in PROFILES:
        raise ValueError(f"unknown profile {name!r}; expected one of {', '.join(PROFILES)}")
    return PROFILES[key]


def metric_spec(profile: Profile | str) -> tuple[str, str]:
    """Label and aggregate of the downsampled channel; unknown names get the default."""
    if isinstance(profile, str):
        known = PROFILES.get(profile.strip().upper())
        return known.metric if known else DEFAULT_METRIC
    return profile.metric
