"""Tiered tables of one profile, kept in the Spark catalog.

Tables are parquet with an explicit location. Appends add files to the current
location; an overwrite writes a new location first and then repoints the table,
so a failed or retried job never leaves a half-replaced table and a table may be
rebuilt from itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.profiles import Profile
from tidemark.session import delete_path, list_folder
from tidemark.sources.alignment import align_to_schema

TIERS = ("bronze", "silver", "gold")
_STREAM_FED = "tidemark.stream_fed"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


@dataclass(frozen=True)
class Staged:
    """A written but not yet visible table version."""

    tier: str
    table: str
    path: str
    schema: T.StructType
    rows: int
    metrics: dict[str, int] = field(default_factory=dict)
    base: tuple[str, ...] | None = None


class ConcurrentChangeError(RuntimeError):
    """A table changed between the staging of its new version and the publishing."""


class Lakehouse:
    """Reads and writes the tier tables of one profile below one root folder."""

    def __init__(
        self, spark: SparkSession, profile: Profile, root: str, prefix: str | None = None
    ) -> None:
        self.spark = spark
        self.profile = profile
        self.prefix = prefix or profile.database_prefix
        self.root = f"{root.rstrip('/')}/{self.prefix}"

    # --- names -----------------------------------------------------------------
    def database(self, tier: str) -> str:
        return f"{self.prefix}_{tier}"

    def identifier(self, tier: str, table: str) -> str:
        return f"{self.database(tier)}.{table}"

    def ensure_namespaces(self, tiers: Iterable[str] = TIERS) -> None:
        """Create the tier databases; existing ones are left alone."""
        for tier in tiers:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database(tier)} "
                f"LOCATION '{self.root}/{tier}'"
            )

    def _versions(self, tier: str, table: str) -> str:
        return f"{self.root}/{tier}/{table}"

    def new_location(self, tier: str, table: str) -> str:
        """An unused folder for a version of the table."""
        return f"{self._versions(tier, table)}/v-{uuid.uuid4().hex}"

    # --- reading ---------------------------------------------------------------
    def exists(self, tier: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.identifier(tier, table))

    def read_product(self, tier: str, table: str) -> DataFrame:
        """The table as a lazy DataFrame; a missing table raises."""
        return self.spark.table(self.identifier(tier, table))

    def first_available(
        self, candidates: Sequence[tuple[str, str, str]]
    ) -> tuple[DataFrame, str] | None:
        """First (tier, table, column) that exists and holds a non-null value."""
        for tier, table, column in candidates:
            if not self.exists(tier, table):
                continue
            df = self.read_product(tier, table)
            if column not in df.columns:
                continue
            if df.filter(F.col(column).isNotNull()).select(F.lit(1)).limit(1).take(1):
                return df, column
        return None

    # --- writing ---------------------------------------------------------------
    def _create(self, tier: str, table: str, schema: T.StructType, location: str) -> None:
        self.ensure_namespaces([tier])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.identifier(tier, table)} ({_ddl(schema)}) "
            f"USING parquet LOCATION '{location}'"
        )

    def _target(
        self, tier: str, table: str, df: DataFrame, expected: T.StructType | None
    ) -> DataFrame:
        """Align to the expected schema, then to the existing table's, which wins."""
        if expected is not None:
            df = align_to_schema(df, expected)
        if self.exists(tier, table):
            df = align_to_schema(df, self.read_product(tier, table).schema)
        return df

    def append_product(
        self,
        tier: str,
        table: str,
        df: DataFrame,
        expected_schema: T.StructType | None = None,
    ) -> int:
        """Append and return the number of rows written, counted during the write.

        Creation uses IF NOT EXISTS, so of two first writers both append.
        """
        df = self._target(tier, table, df, expected_schema)
        if not self.exists(tier, table):
            self._create(tier, table, df.schema, self.new_location(tier, table))
            df = self._target(tier, table, df, None)
        if self.table_property(tier, table, _STREAM_FED):
            raise ValueError(
                f"{self.identifier(tier, table)} is fed by a stream; append to another table"
            )
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(
            self.identifier(tier, table)
        )
        return int(seen.get["rows"])

    def stage(
        self,
        tier: str,
        table: str,
        df: DataFrame,
        metrics: Sequence[Column] = (),
        expected_schema: T.StructType | None = None,
    ) -> Staged:
        """Write a new version out of sight, gathering ``metrics`` in the same pass."""
        base = self._content(tier, table)
        df = self._target(tier, table, df, expected_schema)
        path = self.new_location(tier, table)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.parquet(path)
        values = {k: int(v or 0) for k, v in seen.get.items()}
        return Staged(tier, table, path, df.schema, values.pop("rows"), values, base)

    def staged_frame(self, staged: Staged) -> DataFrame:
        return self.spark.read.schema(staged.schema).parquet(staged.path)

    def location(self, tier: str, table: str) -> str:
        """The folder that a table points to."""
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.identifier(tier, table)}").collect()
        return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")

    def _content(self, tier: str, table: str) -> tuple[str, ...] | None:
        """Where a table lies and the names of its files; None if it does not exist."""
        if not self.exists(tier, table):
            return None
        location = self.location(tier, table)
        names = (path.rstrip("/").rsplit("/", 1)[-1] for path in list_folder(self.spark, location))
        return (location, *sorted(name for name in names if not name.startswith(("_", "."))))

    def publish(self, staged: Staged) -> int:
        """Make a staged version the table's content.

        What was appended or published since the version was staged would be lost,
        so the table must still be what it was then; else nothing changes.
        """
        name = self.identifier(staged.tier, staged.table)
        if self._content(staged.tier, staged.table) != staged.base:
            raise ConcurrentChangeError(f"{name} has changed since its new version was made; make it anew")
        if self.exists(staged.tier, staged.table):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{staged.path}'")
            self.spark.catalog.refreshTable(name)
        else:
            self._create(staged.tier, staged.table, staged.schema, staged.path)
        return staged.rows

    def publish_tiers(self, staged: Iterable[Staged]) -> dict[str, int]:
        """Publish several staged tables; returns rows per ``tier.table``."""
        return {f"{s.tier}.{s.table}": self.publish(s) for s in staged}

    def overwrite_product(
        self,
        tier: str,
        table: str,
        df: DataFrame,
        expected_schema: T.StructType | None = None,
    ) -> int:
        """Replace all rows; an existing table keeps its schema."""
        return self.publish(self.stage(tier, table, df, expected_schema=expected_schema))

    def upsert_product(
        self, tier: str, table: str, df: DataFrame, key: str, version: str | None = None
    ) -> int:
        """Insert rows, replacing those with the same key; returns rows in the table.

        Of rows with one key that with the highest ``version`` wins; without a
        ``version`` keys must not repeat. A null key names no row and is refused.
        """
        keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        bad = F.col(key).isNull() if version is not None else F.col(key).isNull() | (F.col("n") > 1)
        refused = keys.filter(bad).take(1)
        if refused:
            raise ValueError(f"key {refused[0][key]!r} is null or repeated; nothing was written")
        if version is not None:
            latest = F.max_by(F.struct(*df.columns), version).alias("_row")
            df = df.groupBy(key).agg(latest).select("_row.*")
        if self.exists(tier, table):
            current = self.read_product(tier, table)
            incoming = align_to_schema(df, current.schema)
            kept = current.join(incoming.select(key), key, "left_anti").select(*current.columns)
            df = kept.unionByName(incoming)
        return self.overwrite_product(tier, table, df)

    def remove_old_versions(self, tier: str, table: str) -> int:
        """Delete the versions the table no longer points to; returns how many.

        Overwrites and failed builds leave them behind. Run it when no reader of
        an old version and no build of a new one is under way.
        """
        name = self.location(tier, table).rsplit("/", 1)[-1]
        old = [
            path
            for path in list_folder(self.spark, self._versions(tier, table))
            if path.rstrip("/").rsplit("/", 1)[-1] != name
        ]
        return sum(delete_path(self.spark, path) for path in old)

    def export_parquet(self, tier: str, table: str, path: str) -> str:
        """Write a table as a parquet drop for other tools."""
        self.read_product(tier, table).write.mode("overwrite").parquet(path)
        return path

    # --- table properties ------------------------------------------------------
    def table_property(self, tier: str, table: str, key: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.identifier(tier, table)}").collect()
        return {r["key"]: r["value"] for r in rows}.get(key)

    def set_table_property(self, tier: str, table: str, key: str, value: str) -> None:
        self.spark.sql(
            f"ALTER TABLE {self.identifier(tier, table)} SET TBLPROPERTIES ('{key}' = '{value}')"
        )

    def create_stream_table(self, tier: str, table: str, schema: T.StructType) -> None:
        """Create the table a stream will feed, and mark it as such.

        The file sink tracks its own files, so files appended by other writers
        would not be seen; the mark makes :meth:`append_product` refuse. For the
        same reason a table that already holds rows of others is refused here.
        """
        if not self.exists(tier, table):
            self._create(tier, table, schema, self.new_location(tier, table))
        elif not self.table_property(tier, table, _STREAM_FED) and not self.read_product(tier, table).isEmpty():
            raise ValueError(
                f"{self.identifier(tier, table)} holds rows a stream's table would hide; feed another table"
            )
        self.set_table_property(tier, table, _STREAM_FED, "true")
