"""Cost attribution from run results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_away

# --- Fixed values -------------------------------------------------------------
COST_PER_SECOND = 0.05
COST_DIGITS = 4
UNKNOWN = "?"
# ------------------------------------------------------------------------------


def cost_attribution(
    results: DataFrame, cost_per_second: float = COST_PER_SECOND
) -> DataFrame:
    """Cost per executed node from (data_product, unique_id, status, execution_time).

    The cost is taken from the unrounded seconds; a missing time counts as 0.
    """
    seconds = F.coalesce(F.col("execution_time").cast("double"), F.lit(0.0))
    return results.withColumns(
        {
            "node": F.coalesce("unique_id", F.lit(UNKNOWN)),
            "status": F.coalesce("status", F.lit(UNKNOWN)),
            "execution_time_s": round_half_away(seconds, COST_DIGITS),
            "estimated_cost_usd": round_half_away(seconds * F.lit(cost_per_second), COST_DIGITS),
        }
    ).drop("unique_id", "execution_time")


def sort_by_cost(costs: DataFrame, *tie_break: str) -> DataFrame:
    """Longest first; equal times keep the order of ``tie_break``."""
    return costs.orderBy(F.col("execution_time_s").desc(), *tie_break)


def total_cost(costs: DataFrame, *by: str) -> DataFrame:
    """Sum of the already rounded costs, overall or per ``by``."""
    total = round_half_away(F.coalesce(F.sum("estimated_cost_usd"), F.lit(0.0)), COST_DIGITS)
    return costs.groupBy(*by).agg(total.alias("total_cost_usd"))
