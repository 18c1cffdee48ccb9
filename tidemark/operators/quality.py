"""Contracts and data tests.

Row tests are conditional counts, so all tests of a product are one aggregation
(or ride along with a write as observed metrics). Failing counts of zero pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import count_true
from tidemark.session import materialize

#: Types no longer than a hash.
_SHORT = (T.IntegralType, T.FractionalType, T.BooleanType, T.DatetimeType, T.TimestampNTZType)


class ContractError(RuntimeError):
    """A product's columns differ from its contract."""


class QualityError(RuntimeError):
    """A data test found failing rows."""


@dataclass(frozen=True)
class DataTests:
    """Declared tests of one product."""

    not_null: tuple[str, ...] = ()
    accepted: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    unique: tuple[str, ...] = ()
    forbidden: tuple[str, ...] = ()


# --- single tests -------------------------------------------------------------
def null_count(column: str) -> Column:
    return count_true(F.col(column).isNull())


def unaccepted_count(column: str, values: Sequence[str]) -> Column:
    """Rows outside the list; null is not judged."""
    return count_true(~F.col(column).isin(*values))


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.agg(null_count(column).alias("failing"))


def test_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.agg(unaccepted_count(column, values).alias("failing"))


def _may_repeat(df: DataFrame, column: str) -> DataFrame:
    """The column in rows whose hash another row shares; only hashes are shuffled.

    The shared hashes are written down, so their size is known: few of them are
    broadcast, and where none is shared no value moves.
    """
    hashed = df.select(column, F.xxhash64(column).alias("_hash"))
    counts = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    shared = materialize(counts.filter(F.col("_n") > 1).select("_hash"), "shared")
    return hashed.join(shared, "_hash", "left_semi").select(column)


def test_unique(df: DataFrame, column: str) -> DataFrame:
    """Number of non-null values that occur more than once.

    Values longer than a hash (text, binary, nested) are first told apart by their
    hashes, and only those with a shared hash are grouped by value.
    """
    values = df.filter(F.col(column).isNotNull()).select(column)
    if not isinstance(df.schema[column].dataType, _SHORT):
        values = _may_repeat(values, column)
    repeated = (
        values.groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )
    return repeated.agg(F.count(F.lit(1)).alias("failing"))


def forbidden_columns(df: DataFrame, forbidden: Sequence[str]) -> list[str]:
    """Columns whose name is forbidden, whatever the letter case."""
    banned = {name.lower() for name in forbidden}
    return [c for c in df.columns if c.lower() in banned]


def test_no_sensitive_columns(df: DataFrame, forbidden: Sequence[str]) -> DataFrame:
    """One row per offending column; only the schema is read."""
    offending = [(name,) for name in forbidden_columns(df, forbidden)]
    return df.sparkSession.createDataFrame(offending, "column_name string")


def contract_violations(
    schema: T.StructType, contract: T.StructType
) -> list[tuple[str, str, str | None, str | None]]:
    """(column, problem, expected, actual), by name and regardless of order."""
    actual = {f.name: f.dataType.simpleString() for f in schema.fields}
    expected = {f.name: f.dataType.simpleString() for f in contract.fields}
    found = []
    for name, kind in expected.items():
        if name not in actual:
            found.append((name, "missing", kind, None))
        elif actual[name] != kind:
            found.append((name, "mismatched", kind, actual[name]))
    found += [(n, "extra", None, k) for n, k in actual.items() if n not in expected]
    return found


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Violations as rows; only the schema is read."""
    return df.sparkSession.createDataFrame(
        contract_violations(df.schema, contract),
        "column_name string, problem string, expected string, actual string",
    )


# --- all tests of a product ---------------------------------------------------
def row_test_metrics(tests: DataTests) -> dict[str, Column]:
    """Failing-row counts by test name; every one is a plain aggregate."""
    metrics = {f"not_null:{c}": null_count(c) for c in tests.not_null}
    metrics |= {f"accepted:{c}": unaccepted_count(c, v) for c, v in tests.accepted.items()}
    return metrics


def _unpivot(one_row: DataFrame, names: Sequence[tuple[str, str]]) -> DataFrame:
    entries = [
        F.struct(F.lit(label).alias("name"), F.col(f"`{column}`").alias("value"))
        for column, label in names
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.name", "e.value")


def quality_report(df: DataFrame, tests: DataTests) -> DataFrame:
    """(test, failing) for every declared row test, null and value tests in one pass."""
    metrics = row_test_metrics(tests)
    parts = []
    if metrics:
        counted = df.agg(*[column.alias(name) for name, column in metrics.items()])
        parts.append(
            _unpivot(counted, [(n, n) for n in metrics]).select(
                F.col("name").alias("test"), F.col("value").alias("failing")
            )
        )
    for column in tests.unique:
        parts.append(test_unique(df, column).select(F.lit(f"unique:{column}").alias("test"), "failing"))
    if not parts:
        return df.sparkSession.createDataFrame([], "test string, failing bigint")
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
