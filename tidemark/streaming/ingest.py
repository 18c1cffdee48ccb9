"""Continuous feeds into Bronze."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.masking import MaskingKey
from tidemark.operators.flywheel import LIVE_SCHEMA, LIVE_TABLE
from tidemark.operators.governance import mask_sensitive
from tidemark.sources.alignment import align_to_schema
from tidemark.sources.lakehouse import Lakehouse


def trigger(once: bool, interval: str) -> dict:
    return {"availableNow": True} if once else {"processingTime": interval}


def stream_bronze_ingest(
    lake: Lakehouse,
    stream: DataFrame,
    checkpoint: str,
    salt: str | None = None,
    table: str | None = None,
    once: bool = False,
    interval: str = "30 seconds",
) -> StreamingQuery:
    """Mask and append a raw stream to a Bronze table of its own.

    The file sink commits each micro-batch atomically, so a restart neither
    loses nor repeats rows. Every micro-batch is a plain projection.
    """
    profile = lake.profile
    table = table or f"{profile.bronze_table}_feed"
    masked = mask_sensitive(stream, profile, MaskingKey(lake.spark, salt))
    lake.create_stream_table("bronze", table, profile.schema)
    return (
        align_to_schema(masked, profile.schema)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger(once, interval))
        .toTable(lake.identifier("bronze", table))
    )


def checkpoint_id(lake: Lakehouse, checkpoint: str) -> str:
    """The id Spark wrote into a checkpoint when it was made."""
    text = lake.spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def append_scores(
    lake: Lakehouse,
    events: DataFrame,
    checkpoint: str,
    feed: str | None = None,
    once: bool = False,
    interval: str = "30 seconds",
) -> StreamingQuery:
    """Append a stream of inference events to the live table, batch by batch.

    The batches begun and appended are kept as table properties under the feed's
    name (by default made from the checkpoint's path) and the checkpoint's own
    id, which Spark makes anew with every new checkpoint. So a batch that Spark
    replays is not appended twice, and a renewed checkpoint, whose numbers begin
    at 0 again, skips nothing. If the driver failed between append and mark, the
    repeated batch leaves out events whose id the table already has.
    """
    name = feed or hashlib.sha256(checkpoint.encode("utf-8")).hexdigest()[:16]

    def append(batch: DataFrame, number: int) -> None:
        if not lake.exists("bronze", LIVE_TABLE):
            lake.append_product("bronze", LIVE_TABLE, lake.spark.createDataFrame([], LIVE_SCHEMA))
        mark = f"tidemark.batch.{name}.{checkpoint_id(lake, checkpoint)}"
        done = lake.table_property("bronze", LIVE_TABLE, f"{mark}.done")
        if done is not None and int(done) >= number:
            return
        begun = lake.table_property("bronze", LIVE_TABLE, f"{mark}.begun")
        if begun is not None and int(begun) == number:
            # The broken batch was written by another session; look at the files anew.
            lake.spark.catalog.refreshTable(lake.identifier("bronze", LIVE_TABLE))
            known = lake.read_product("bronze", LIVE_TABLE).select("inference_id")
            batch = batch.join(known, "inference_id", "left_anti")
        lake.set_table_property("bronze", LIVE_TABLE, f"{mark}.begun", str(number))
        lake.append_product("bronze", LIVE_TABLE, batch, LIVE_SCHEMA)
        lake.set_table_property("bronze", LIVE_TABLE, f"{mark}.done", str(number))

    return (
        events.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger(once, interval))
        .foreachBatch(append)
        .start()
    )
