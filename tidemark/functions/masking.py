"""Keyed masking of identifiers with built-in functions only.

HMAC-SHA256 is written as two nested ``sha2`` calls over the key pads. The pads
live in a one-row relation that is read through a scalar subquery, so neither
they nor the salt show up in plans, explain output or the event log, and no
join is needed. The same expression works in batch and in streaming queries.
"""

from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: token format and salts known to be unsafe ------------------
TOKEN_PREFIX = "masked_sha256:"
TOKEN_HEX_DIGITS = 16
MIN_SALT_LENGTH = 16
UNSAFE_SALTS = frozenset(
    {"changeme", "change-me", "please-change-me-in-production", "test", "secret"}
)
UNSAFE_PREFIXES = ("replace-",)
UNSAFE_PARTS = ("local-dev",)
# ------------------------------------------------------------------------------

SALT_VARIABLE = "TIDEMARK_MASKING_SALT"
_SHA256_BLOCK = 64


class InsecureSaltError(RuntimeError):
    """The masking salt is missing, a placeholder, or too short."""


def assert_salt(salt: str | None = None) -> str:
    """Return a usable salt or raise; nothing may be masked without one.

    Without an argument the salt is taken from ``TIDEMARK_MASKING_SALT``.
    The error text never repeats the salt.
    """
    if salt is None:
        salt = os.environ.get(SALT_VARIABLE, "")
    salt = salt.strip()
    if not salt:
        raise InsecureSaltError("the masking salt is unset")
    if (
        salt in UNSAFE_SALTS
        or salt.startswith(UNSAFE_PREFIXES)
        or any(part in salt for part in UNSAFE_PARTS)
    ):
        raise InsecureSaltError("the masking salt is a known placeholder")
    if len(salt) < MIN_SALT_LENGTH:
        raise InsecureSaltError(f"the masking salt needs at least {MIN_SALT_LENGTH} characters")
    return salt


def key_pads(salt: str) -> tuple[bytes, bytes]:
    """Inner and outer HMAC pads of a salt (RFC 2104)."""
    key = salt.encode("utf-8")
    if len(key) > _SHA256_BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_SHA256_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


class MaskingKey:
    """A checked salt bound to a session; builds masking expressions."""

    def __init__(self, spark: SparkSession, salt: str | None = None) -> None:
        inner, outer = key_pads(assert_salt(salt))
        self._pads: DataFrame = spark.createDataFrame(
            pa.table({"inner_pad": pa.array([inner]), "outer_pad": pa.array([outer])})
        )

    def _pad(self, name: str) -> Column:
        return self._pads.select(name).scalar()

    def hmac_hex(self, value: Column) -> Column:
        """Full HMAC-SHA256 of a string column as 64 hex digits."""
        inner = F.sha2(F.concat(self._pad("inner_pad"), F.encode(value, "UTF-8")), 256)
        return F.sha2(F.concat(self._pad("outer_pad"), F.unhex(inner)), 256)

    def mask(
        self,
        value: Column,
        role: str | None = None,
        unmask_role: str | None = None,
        length: int = TOKEN_HEX_DIGITS,
    ) -> Column:
        """Deterministic token for a string; null and "" stay as they are.

        Equal plaintexts give equal tokens, so masked ids stay join keys. When an
        unmask role is named and ``role`` equals it, the plaintext is returned.
        """
        if unmask_role is not None and role == unmask_role:
            return value
        token = F.concat(F.lit(TOKEN_PREFIX), F.substring(self.hmac_hex(value), 1, length))
        # Only the last branch is computed, and it is never null: a test for null
        # on the token then folds to one on the plaintext, without any hashing.
        empty = F.lit("")
        return F.when(value == empty, empty).when(value.isNotNull(), F.coalesce(token, empty))
