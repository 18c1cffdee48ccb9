"""Joins of stored products without a shuffle.

Both sides are written in the same buckets of the join column. A value with very
many rows would make one bucket long, so its rows are dealt to numbered slices,
and the rows of the other side that match it are stored once per slice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize
from tidemark.sources.lakehouse import Lakehouse

SLICE_ROWS = 1_000_000
_SEED = 17
_SLICES = ("_slice", "_other_slice")


@dataclass(frozen=True)
class StoredJoin:
    """Two bucketed tables of one tier that :func:`join_stored` joins."""

    tier: str
    left: str
    right: str
    on: str
    how: str


def _hot(df: DataFrame, on: str, slice_rows: int, name: str) -> DataFrame | None:
    """(value, slices) of the values with more than ``slice_rows`` rows; few by that very number."""
    counts = df.groupBy(on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_rows)
    hot = counts.select(F.col(on).alias("_value"), F.ceil(F.col("n") / slice_rows).cast("int").alias(name))
    hot = materialize(hot, "hot")
    return None if hot.isEmpty() else hot


def _with_slices(df: DataFrame, on: str, hot: DataFrame | None, slices: str) -> DataFrame:
    if hot is None:
        return df.withColumn(slices, F.lit(1))
    joined = df.join(hot, df[on].eqNullSafe(hot["_value"]), "left").drop("_value")
    return joined.withColumn(slices, F.coalesce(F.col(slices), F.lit(1)))


def _dealt(slices: str):
    return F.floor(F.rand(_SEED) * F.col(slices)).cast("int")


def _each(slices: str):
    return F.explode(F.sequence(F.lit(0), F.col(slices) - 1))


def _write(lake: Lakehouse, tier: str, table: str, df: DataFrame, on: str, buckets: int) -> None:
    lake.ensure_namespaces([tier])
    keys = [on, *_SLICES]
    (
        df.repartition(buckets, *keys)
        .write.format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", lake.new_location(tier, table))
        .saveAsTable(lake.identifier(tier, table))
    )


def store_for_join(
    lake: Lakehouse,
    tier: str,
    name: str,
    left: DataFrame,
    right: DataFrame,
    on: str,
    buckets: int,
    how: str = "inner",
    slice_rows: int = SLICE_ROWS,
) -> StoredJoin:
    """Write both sides in ``buckets`` buckets of ``on``: one shuffle each, once.

    For ``inner`` joins values with many rows are split on both sides. ``left``,
    ``left_semi`` and ``left_anti`` need every left row once, so only left values
    are split there. Rows without a value never match: they are left out where
    the join drops them, and dealt out evenly where it keeps them. The sides must
    be readable again in the same order, as files are.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a stored join is inner, left, left_semi or left_anti, not {how}")
    first, second = _SLICES
    right = right.filter(F.col(on).isNotNull())
    if how in ("inner", "left_semi"):
        left = left.filter(F.col(on).isNotNull())
    hot_left = _hot(left, on, slice_rows, "_n_left")
    hot_right = _hot(right, on, slice_rows, "_n_right") if how == "inner" else None
    counts = ("_n_left", "_n_right")

    def counted(df: DataFrame) -> DataFrame:
        return _with_slices(_with_slices(df, on, hot_left, counts[0]), on, hot_right, counts[1])

    own = counted(left).withColumn(first, _dealt("_n_left"))
    own = own.withColumn(second, _each("_n_right")) if how == "inner" else own.withColumn(second, F.lit(0))
    other = counted(right).withColumn(first, _each("_n_left")).withColumn(second, _dealt("_n_right"))
    stored = StoredJoin(tier, f"{name}_left", f"{name}_right", on, how)
    _write(lake, tier, stored.left, own.drop(*counts), on, buckets)
    _write(lake, tier, stored.right, other.drop(*counts), on, buckets)
    return stored


def join_stored(lake: Lakehouse, stored: StoredJoin) -> DataFrame:
    """Join bucket by bucket: no row of either side moves."""
    left = lake.read_product(stored.tier, stored.left)
    right = lake.read_product(stored.tier, stored.right)
    return left.join(right.hint("merge"), [stored.on, *_SLICES], stored.how).drop(*_SLICES)
