"""Masking of whole products, joins on masked ids, and role-based views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.masking import MaskingKey
from tidemark.profiles import Profile

# --- Fixed values: privileged roles -------------------------------------------
GOVERNANCE_ADMIN = "DATA_GOVERNANCE_ADMIN"
SECURITY_OPERATIONS = "SECURITY_OPERATIONS"
GROUP_GOVERNANCE_ADMINS = "data_governance_admins"
GROUP_SECURITY_OPERATIONS = "security_operations"
# ------------------------------------------------------------------------------

SECURE_VIEW_MODES = ("hmac", "null", "deny")


def mask_sensitive(
    df: DataFrame,
    profile: Profile,
    key: MaskingKey,
    role: str | None = None,
    unmask_role: str | None = None,
) -> DataFrame:
    """Mask the profile's sensitive columns; same columns, same order."""
    return df.withColumns(
        {c: key.mask(F.col(c), role, unmask_role) for c in profile.sensitive if c in df.columns}
    )


def masked_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join two products whose ids were masked with the same salt.

    An ordinary equi-join: the planner broadcasts a side it knows to be small,
    and the adaptive skew join splits the partition of a hot id.
    """
    return left.join(right, on, how)


def secure_view(
    df: DataFrame,
    profile: Profile,
    roles: str | Iterable[str],
    mode: str = "hmac",
    key: MaskingKey | None = None,
) -> DataFrame:
    """What holders of ``roles`` may see of a product.

    ``hmac``: the two privileged roles see the values, all others the full digest.
    ``null``: only the two groups see rows, and only security operations sees ids.
    ``deny``: sensitive columns exist only for the privileged roles.
    """
    held = {roles} if isinstance(roles, str) else set(roles)
    if mode == "hmac":
        if held & {GOVERNANCE_ADMIN, SECURITY_OPERATIONS}:
            return df
        if key is None:
            raise ValueError("the hmac view needs a masking key")
        return df.withColumns({c: key.hmac_hex(F.col(c)) for c in profile.sensitive})
    if mode == "null":
        if GROUP_SECURITY_OPERATIONS in held:
            return df
        hidden = df.withColumns(
            {c: F.lit(None).cast(df.schema[c].dataType) for c in profile.sensitive}
        )
        return hidden.filter(F.lit(GROUP_GOVERNANCE_ADMINS in held))
    if mode == "deny":
        if held & {GOVERNANCE_ADMIN, SECURITY_OPERATIONS}:
            return df
        return df.drop(*profile.sensitive)
    raise ValueError(f"unknown mode {mode!r}; expected one of {', '.join(SECURE_VIEW_MODES)}")
