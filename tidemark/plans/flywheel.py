"""Robotics flywheel over lakehouse tables: episodes, shards, scored inference."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame

from tidemark.functions.embedding import DIGEST_BACKBONE, Embedder
from tidemark.operators import flywheel
from tidemark.profiles import ROBOTICS
from tidemark.sources.lakehouse import Lakehouse


def build_episodes(
    lake: Lakehouse, limit: int | None = None, backbone: Embedder = DIGEST_BACKBONE
) -> int:
    """Embed Silver signals (else Bronze) into ``gold.vla_episodes``; rows written."""
    if lake.profile.name != ROBOTICS.name:
        raise ValueError("episode vectors are only defined for the ROBOTICS profile")
    for tier, table in (("silver", "silver_robot_signals"), ("bronze", ROBOTICS.bronze_table)):
        if lake.exists(tier, table):
            break
    else:
        return 0
    episodes = flywheel.embed_episodes(lake.read_product(tier, table), limit=limit, backbone=backbone)
    return lake.overwrite_product(
        "gold", flywheel.EPISODES_TABLE, episodes, flywheel.EPISODE_SCHEMA
    )


def write_shards(
    lake: Lakehouse,
    folder: str,
    samples_per_shard: int = flywheel.SAMPLES_PER_SHARD,
    shuffle_seed: int = flywheel.SHUFFLE_SEED,
) -> DataFrame:
    """Training shards of every episode in ``gold.vla_episodes``."""
    episodes = lake.read_product("gold", flywheel.EPISODES_TABLE)
    return flywheel.write_training_shards(episodes, folder, samples_per_shard, shuffle_seed)


def closed_loop(
    lake: Lakehouse, model_version: str, deployment_env: str, batch_us: int | None = None
) -> int:
    """Score every episode and append the events to ``bronze.live_inference``."""
    stamp = time.time_ns() // 1000 if batch_us is None else batch_us
    episodes = lake.read_product("gold", flywheel.EPISODES_TABLE)
    events = flywheel.live_events(episodes, model_version, deployment_env, stamp)
    return lake.append_product("bronze", flywheel.LIVE_TABLE, events, flywheel.LIVE_SCHEMA)
