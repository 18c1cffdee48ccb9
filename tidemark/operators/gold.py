"""Gold: one rollup per domain.

Each is a single group-by over a handful of keys, so partial aggregation leaves
a few rows per task before the shuffle however skewed the keys are. Distinct
patients are first grouped by (key, patient), which spreads a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import count_true, flag_as_double, round_half_away

# --- Fixed value --------------------------------------------------------------
LOW_HRV = 35
# ------------------------------------------------------------------------------


def order_by_key(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(F.col(key).asc_nulls_last())


def _mean(column: str, digits: int) -> Column:
    return round_half_away(F.avg(column), digits)


def _rate(flag: str, digits: int) -> Column:
    return round_half_away(F.avg(flag_as_double(F.col(flag))), digits)


def _rollup(df: DataFrame, key: str, **measures: Column) -> DataFrame:
    aggregates = [column.alias(name) for name, column in measures.items()]
    return order_by_key(df.groupBy(key).agg(*aggregates), key)


def gold_robot_health(silver: DataFrame) -> DataFrame:
    """A null flag is neither success nor failure but stays in the rate's base."""
    return _rollup(
        silver,
        "robot_model_id",
        episode_count=F.count(F.lit(1)),
        success_count=count_true(F.col("success_flag")),
        failure_count=count_true(~F.col("success_flag")),
        success_rate=_rate("success_flag", 3),
    )


def gold_facility_health(silver: DataFrame) -> DataFrame:
    return _rollup(
        silver,
        "facility_id",
        sample_count=F.count(F.lit(1)),
        avg_voltage=_mean("measured_voltage", 3),
        avg_temperature_c=_mean("temperature_c", 3),
        avg_pressure_bar=_mean("pressure_bar", 3),
        anomaly_count=count_true(F.col("anomaly_flag")),
        sla_breach_count=count_true(F.col("sla_breach")),
    )


def gold_cohort_summary(silver: DataFrame) -> DataFrame:
    return _rollup(
        silver,
        "region",
        patient_count=F.count_distinct("patient_id_hashed"),
        avg_hrv=_mean("heart_rate_variability", 2),
        avg_sleep_efficiency=_mean("sleep_efficiency", 3),
        low_hrv_readings=count_true(F.col("heart_rate_variability") < LOW_HRV),
    )


def gold_account_health(silver: DataFrame) -> DataFrame:
    """``account_count`` counts events, not distinct accounts."""
    return _rollup(
        silver,
        "plan_tier",
        account_count=F.count(F.lit(1)),
        avg_monthly_revenue=_mean("monthly_revenue", 2),
        avg_lifetime_value=_mean("lifetime_value", 2),
        churned_count=count_true(F.col("churned_flag")),
        churn_rate=_rate("churned_flag", 3),
    )


def gold_study_safety(silver: DataFrame) -> DataFrame:
    return _rollup(
        silver,
        "study_id",
        patient_count=F.count_distinct("patient_id_hashed"),
        observation_count=F.count(F.lit(1)),
        adverse_event_count=count_true(F.col("adverse_event_flag")),
        adverse_event_rate=_rate("adverse_event_flag", 4),
    )
