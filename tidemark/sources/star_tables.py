"""Domain Bronze tables derived from the star-schema and event test tables.

Pure projections: they add no shuffle, and the parquet scan below them reads
only the columns a query ends up needing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.masking import MaskingKey
from tidemark.operators.governance import mask_sensitive
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
    PROFILES,
    REGIONS,
    ROBOT_MODELS,
    ROBOTICS,
    STUDY_IDS,
)
from tidemark.sources.alignment import align_to_schema

EPISODE_START = "2026-01-01 00:00:00"
EPISODE_SPACING_US = 20_000


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is looked up in the file once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _pick(values: Sequence[str], number: Column) -> Column:
    """The value at ``number`` modulo the list's length."""
    position = F.pmod(number, F.lit(len(values)))
    cases = F.when(position == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        cases = cases.when(position == i, value)
    return cases


def plc_registers_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as controller readings."""
    df = table(spark, folder, "lineitem").select(
        F.col("l_shipdate").alias("timestamp"),
        F.when(F.col("l_linestatus") == "O", FACILITIES[0]).otherwise(FACILITIES[1]).alias("facility_id"),
        F.concat(F.lit("REG-"), F.col("l_suppkey").cast("string")).alias("register_id"),
        (10 + 0.15 * F.col("l_quantity")).alias("measured_voltage"),
        (70 + 300 * F.col("l_discount")).alias("temperature_c"),
        (6 + 50 * F.col("l_tax")).alias("pressure_bar"),
        (F.col("l_returnflag") == "R").alias("anomaly_flag"),
    )
    return align_to_schema(df, MANUFACTURING.schema)


def wearable_biometrics_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Events as wearable readings."""
    df = table(spark, folder, "events").select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("PAT-"), F.col("user_id").cast("string")).alias("patient_id_hashed"),
        F.floor("value").cast("int").alias("heart_rate_variability"),
        (F.col("value") / 100).alias("sleep_efficiency"),
        _pick(REGIONS, F.col("user_id")).alias("region"),
    )
    return align_to_schema(df, HEALTH_TECH.schema)


def ecrf_observations_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Events as trial observations."""
    df = table(spark, folder, "events").select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("PAT-"), F.col("user_id").cast("string")).alias("patient_id_hashed"),
        _pick(STUDY_IDS, F.col("event_id")).alias("study_id"),
        _pick(AGE_BRACKETS, F.col("user_id")).alias("age_bracket"),
        _pick(REGIONS, F.col("user_id")).alias("region"),
        (F.col("event_type") == "error").alias("adverse_event_flag"),
    )
    return align_to_schema(df, CLINICAL.schema)


def subscription_events_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as subscription events."""
    df = table(spark, folder, "orders").select(
        F.col("o_orderdate").alias("timestamp"),
        F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id_hashed"),
        _pick(PLAN_TIERS, F.col("o_custkey")).alias("plan_tier"),
        _pick(REGIONS, F.col("o_custkey")).alias("region"),
        (F.col("o_totalprice") / 1000).alias("monthly_revenue"),
        (F.col("o_orderkey") % 60 + 1).cast("int").alias("tenure_months"),
        (F.col("o_orderstatus") == "F").alias("churned_flag"),
    )
    return align_to_schema(df, COMMERCIAL.schema)


def robot_signals_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Embedding vectors as robot episodes; all numbers are joints."""
    number = F.col("vec_id")
    success = number % 5 != 0
    start = F.unix_micros(F.lit(EPISODE_START).cast("timestamp"))
    df = table(spark, folder, "embeddings").select(
        F.timestamp_micros(start + number * EPISODE_SPACING_US)
        .cast("timestamp_ntz")
        .alias("timestamp"),
        F.concat(F.lit("serial-"), (number % 8).cast("string")).alias("robot_id"),
        _pick(ROBOT_MODELS, F.col("label")).alias("robot_model_id"),
        F.col("embedding").alias("joint_positions"),
        F.concat(F.lit("frames/"), F.lpad(number.cast("string"), 9, "0"), F.lit(".jpg")).alias(
            "camera_frame_uri"
        ),
        F.when(success, NO_FAILURE)
        .otherwise(_pick(FAILURE_TAGS, F.col("label")))
        .alias("failure_type_tag"),
        success.alias("success_flag"),
    )
    return align_to_schema(df, ROBOTICS.schema)


_RAW = {
    ROBOTICS.name: robot_signals_raw,
    MANUFACTURING.name: plc_registers_raw,
    HEALTH_TECH.name: wearable_biometrics_raw,
    COMMERCIAL.name: subscription_events_raw,
    CLINICAL.name: ecrf_observations_raw,
}


def raw(spark: SparkSession, folder: str, profile_name: str) -> DataFrame:
    """A profile's rows before masking."""
    return _RAW[profile_name](spark, folder)


def bronze(spark: SparkSession, folder: str, profile_name: str, key: MaskingKey) -> DataFrame:
    """A profile's masked Bronze rows."""
    return mask_sensitive(raw(spark, folder, profile_name), PROFILES[profile_name], key)
