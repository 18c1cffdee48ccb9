"""The Silver and Gold product of every profile: builder, contract, tests."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.operators import gold, silver
from tidemark.operators.quality import DataTests
from tidemark.profiles import (
    AGE_BRACKETS,
    CLINICAL,
    COMMERCIAL,
    FACILITIES,
    FAILURE_TAGS,
    HEALTH_TECH,
    MANUFACTURING,
    NO_FAILURE,
    PLAN_TIERS,
    REGIONS,
    ROBOT_MODELS,
    ROBOTICS,
    STUDY_IDS,
    Profile,
    declare,
)

# --- Fixed values: names that must never appear in a Gold product -------------
PATIENT_NAMES = (
    "patient_id_hashed",
    "patient_id",
    "mrn",
    "ssn",
    "dob",
    "email",
    "full_name",
    "patient_name",
)
CUSTOMER_NAMES = ("customer_id_hashed", "customer_id", "email", "full_name", "customer_name")
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Product:
    """One table to build: from what, to which contract, under which tests."""

    name: str
    tier: str
    build: Callable[[DataFrame], DataFrame]
    contract: T.StructType
    tests: DataTests


@dataclass(frozen=True)
class ProductLine:
    """Silver is built from Bronze, Gold from Silver."""

    profile: Profile
    silver: Product
    gold: Product


def _extended(profile: Profile, after: str | None = None, **extra: T.DataType) -> T.StructType:
    """The Bronze columns and the derived ones, at the end or after a column."""
    fields = list(profile.schema.fields)
    place = len(fields) if after is None else profile.schema.names.index(after) + 1
    return T.StructType([*fields[:place], *declare(**extra).fields, *fields[place:]])


def _silver(build, contract, not_null, accepted) -> Product:
    tests = DataTests(not_null=not_null, accepted=accepted)
    return Product(build.__name__, "silver", build, contract, tests)


def _gold(build, key, values, contract, not_null, forbidden) -> Product:
    tests = DataTests(
        not_null=(key, *not_null), accepted={key: values}, unique=(key,), forbidden=forbidden
    )
    return Product(build.__name__, "gold", build, contract, tests)


_LINES = (
    ProductLine(
        ROBOTICS,
        _silver(
            silver.silver_robot_signals,
            _extended(ROBOTICS, after="joint_positions", peak_joint_pos=T.FloatType()),
            ("timestamp", "robot_id", "robot_model_id", "success_flag"),
            {"robot_model_id": ROBOT_MODELS, "failure_type_tag": (*FAILURE_TAGS, NO_FAILURE)},
        ),
        _gold(
            gold.gold_robot_health,
            "robot_model_id",
            ROBOT_MODELS,
            declare(
                robot_model_id=T.StringType(),
                episode_count=T.LongType(),
                success_count=T.LongType(),
                failure_count=T.LongType(),
                success_rate=T.DoubleType(),
            ),
            ("episode_count", "success_rate"),
            ("robot_id",),
        ),
    ),
    ProductLine(
        MANUFACTURING,
        _silver(
            silver.silver_plc_registers,
            _extended(MANUFACTURING, sla_breach=T.BooleanType()),
            ("timestamp", "facility_id", "register_id", "anomaly_flag", "sla_breach"),
            {"facility_id": FACILITIES},
        ),
        _gold(
            gold.gold_facility_health,
            "facility_id",
            FACILITIES,
            declare(
                facility_id=T.StringType(),
                sample_count=T.LongType(),
                avg_voltage=T.DoubleType(),
                avg_temperature_c=T.DoubleType(),
                avg_pressure_bar=T.DoubleType(),
                anomaly_count=T.LongType(),
                sla_breach_count=T.LongType(),
            ),
            ("sample_count",),
            ("register_id",),
        ),
    ),
    ProductLine(
        HEALTH_TECH,
        _silver(
            silver.silver_wearable_biometrics,
            _extended(HEALTH_TECH),
            ("timestamp", "patient_id_hashed", "region"),
            {"region": REGIONS},
        ),
        _gold(
            gold.gold_cohort_summary,
            "region",
            REGIONS,
            declare(
                region=T.StringType(),
                patient_count=T.LongType(),
                avg_hrv=T.DoubleType(),
                avg_sleep_efficiency=T.DoubleType(),
                low_hrv_readings=T.LongType(),
            ),
            ("patient_count",),
            PATIENT_NAMES,
        ),
    ),
    ProductLine(
        COMMERCIAL,
        _silver(
            silver.silver_subscription_events,
            _extended(COMMERCIAL, lifetime_value=T.FloatType()),
            ("timestamp", "customer_id_hashed", "plan_tier", "region", "churned_flag"),
            {"plan_tier": PLAN_TIERS, "region": REGIONS},
        ),
        _gold(
            gold.gold_account_health,
            "plan_tier",
            PLAN_TIERS,
            declare(
                plan_tier=T.StringType(),
                account_count=T.LongType(),
                avg_monthly_revenue=T.DoubleType(),
                avg_lifetime_value=T.DoubleType(),
                churned_count=T.LongType(),
                churn_rate=T.DoubleType(),
            ),
            ("account_count", "churn_rate"),
            CUSTOMER_NAMES,
        ),
    ),
    ProductLine(
        CLINICAL,
        _silver(
            silver.silver_ecrf_observations,
            _extended(CLINICAL),
            tuple(CLINICAL.schema.names),
            {"study_id": STUDY_IDS, "age_bracket": AGE_BRACKETS, "region": REGIONS},
        ),
        _gold(
            gold.gold_study_safety,
            "study_id",
            STUDY_IDS,
            declare(
                study_id=T.StringType(),
                patient_count=T.LongType(),
                observation_count=T.LongType(),
                adverse_event_count=T.LongType(),
                adverse_event_rate=T.DoubleType(),
            ),
            ("patient_count", "observation_count"),
            PATIENT_NAMES,
        ),
    ),
)

PRODUCT_LINES: dict[str, ProductLine] = {line.profile.name: line for line in _LINES}
