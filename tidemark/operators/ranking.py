"""Dense positions over a total order, without a single-task sort.

``row_number() over (partition by k order by t)`` sends each key to one task;
one hot key would hold a third of all rows there. Here the order is cut in
buckets, so a hot key spans as many tasks as it has buckets, and only the
buckets' counts are put in sequence. Nothing is sampled or stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import whole_division

#: Widths of a bucket of the first order column: seconds of a time, else numbers.
BUCKET_SECONDS = 3_600
BUCKET_SPAN = 65_536

_KEY, _SPOT, _PART, _BEFORE = "_key_part", "_spot", "_part", "_before"


def _bucket(name: str, kind: T.DataType, width: int | None) -> Column:
    """A number that never falls as the column rises; null stays null."""
    column = F.col(name)
    if isinstance(kind, T.TimestampType):
        return whole_division(F.unix_seconds(column), width or BUCKET_SECONDS)
    if isinstance(kind, T.TimestampNTZType):
        # By its parts: a cast would move it where a time zone's clock jumps.
        days = F.unix_date(column.cast("date")).cast("bigint")
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
        return whole_division(days * 86_400 + seconds, width or BUCKET_SECONDS)
    if isinstance(kind, T.IntegralType):
        return whole_division(column, width or BUCKET_SPAN)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # Not a number sorts after all numbers.
        part = F.floor(column / F.lit(width or BUCKET_SPAN))
        return F.when(F.isnan(column), F.lit(2**63 - 1)).otherwise(part)
    return column


def position_in(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "position",
    width: int | None = None,
    start: DataFrame | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row within ``by`` in ``order``.

    ``order`` must be total for a repeatable result, and ``df`` must give the
    same rows each time it is computed: it is read once for the counts of the
    buckets and once for the places within them. ``width`` is that of a bucket
    of the first order column, in seconds or numbers; it bounds what one task
    sorts of a key and changes no result. Rows without a first order column are
    cut by the second. ``start`` may give, per key of ``by``, a column ``name``
    that the counting begins at (absent: 0). ``keep`` names the columns still
    needed; the others are only sorted by.
    """
    kept = list(df.columns if keep is None else dict.fromkeys([*by, *keep]))
    first = _bucket(order[0], df.schema[order[0]].dataType, width)
    second = F.lit(None)
    if len(order) > 1:
        second = F.when(F.col(order[0]).isNull(), _bucket(order[1], df.schema[order[1]].dataType, width))
    # One struct for key and bucket: structs are equal where both hold null, so one
    # partitioning serves the window and the join.
    part = F.struct(first.alias("first"), second.alias("second"))
    cut = df.select("*", F.struct(*by, part.alias(_PART)).alias(_KEY))

    runs = cut.groupBy(_KEY).agg(F.count(F.lit(1)).alias("_rows"))
    runs = runs.select(_KEY, "_rows", f"{_KEY}.*")
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy(_PART).rowsBetween(
        Window.unboundedPreceding, -1
    )
    runs = runs.withColumn(_BEFORE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    if start is not None:
        begin = start.select(*by, F.col(name).alias("_begin"))
        runs = _join_on(runs, begin, by, "left").withColumn(
            _BEFORE, F.col(_BEFORE) + F.coalesce(F.col("_begin"), F.lit(0))
        )
    runs = runs.select(_KEY, _BEFORE)

    within = Window.partitionBy(_KEY).orderBy(*order)
    placed = cut.select(*kept, _KEY, (F.row_number().over(within) - 1).alias(_SPOT))
    position = (F.col(_BEFORE) + F.col(_SPOT)).cast("bigint")
    return placed.join(runs, _KEY).select(*kept, position.alias(name))


def position_by_digest(
    df: DataFrame, digest: str, tie: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """Add the 0-based position in the order of a hex digest column, then ``tie``.

    Digests are uniform, so their first 16 bits cut the rows in even, bounded
    groups without sampling or storing anything; counts per group (65,536 rows
    at most, hence broadcast) give each group its offset.
    """
    grouped = df.withColumn(_PART, F.conv(F.substring(digest, 1, 4), 16, 10).cast("int"))
    earlier = Window.partitionBy(F.lit(0)).orderBy(_PART).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        grouped.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(_PART, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(_BEFORE))
    )
    within = Window.partitionBy(_PART).orderBy(digest, *tie)
    placed = grouped.withColumn(_SPOT, F.row_number().over(within) - 1)
    position = (F.col(_BEFORE) + F.col(_SPOT)).cast("bigint")
    return placed.join(F.broadcast(offsets), _PART).select(*df.columns, position.alias(name))


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join that matches null keys too and keeps the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])
