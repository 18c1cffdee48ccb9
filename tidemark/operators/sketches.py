"""Distinct patients as mergeable sketches, beside the exact counts of Gold.

A sketch per key and day is some ten kilobytes whatever the number of patients.
Sketches of later rows are appended as rows of their own; any span of days, or all
keys together, is a merge of sketches, and Silver is not read again.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.lakehouse import Lakehouse

#: Registers of a sketch as a power of two.
LOG_REGISTERS = 14
SKETCH_TABLE = "patient_sketches"


def relative_error(log_registers: int = LOG_REGISTERS) -> float:
    """Standard error of a merged sketch, as a share of the count."""
    return 1.04 / sqrt(1 << log_registers)


def patient_sketches(
    silver: DataFrame,
    key: str,
    patient: str = "patient_id_hashed",
    moment: str = "timestamp",
    log_registers: int = LOG_REGISTERS,
) -> DataFrame:
    """(key, day, patients, observations); null patients count as observations only.

    Sketches are filled before the shuffle, so a hot key sends one per task.
    """
    return silver.groupBy(F.col(key).alias("key"), F.to_date(moment).alias("day")).agg(
        F.hll_sketch_agg(patient, log_registers).alias("patients"),
        F.count(F.lit(1)).alias("observations"),
    )


def append_sketches(lake: Lakehouse, silver: DataFrame, key: str, table: str = SKETCH_TABLE) -> int:
    """Sketch rows not sketched before and append them; returns sketches written."""
    return lake.append_product("gold", table, patient_sketches(silver, key))


def distinct_patients(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct patients and observations per ``by`` (of all, without)."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("patients")).alias("patient_count"),
        F.sum("observations").alias("observation_count"),
    )
