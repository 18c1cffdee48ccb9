"""Episode vectors, scores, and training shards of the robotics profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.embedding import DIGEST_BACKBONE, Embedder
from tidemark.functions.numeric import whole_division
from tidemark.functions.text import display
from tidemark.operators.ranking import position_by_digest, position_in
from tidemark.profiles import FAILURE_TAGS, ROBOTICS, Profile, declare
from tidemark.session import materialize, shared_folder
from tidemark.sources.shards import FIRST, SAMPLE_COLUMNS, list_training_shards, write_shards

# --- Fixed values: schemas, score constants, shard layout ---------------------
EPISODES_TABLE = "vla_episodes"
EPISODE_SCHEMA = declare(
    episode_id=T.StringType(),
    robot_model_id=T.StringType(),
    failure_type_tag=T.StringType(),
    success_flag=T.BooleanType(),
    vla_feature_vector=T.ArrayType(T.FloatType()),
    feature_dim=T.IntegerType(),
    backbone=T.StringType(),
)
LIVE_TABLE = "live_inference"
LIVE_SCHEMA = declare(
    inference_id=T.StringType(),
    episode_id=T.StringType(),
    robot_model_id=T.StringType(),
    model_version=T.StringType(),
    ts_us=T.LongType(),
    policy_confidence=T.DoubleType(),
    is_failure=T.BooleanType(),
    failure_type_tag=T.StringType(),
    deployment_env=T.StringType(),
)
CONFIDENCE_BASE, CONFIDENCE_SPAN, CONFIDENCE_GAIN = 0.5, 0.45, 4.0
CONFIDENCE_MIN, CONFIDENCE_MAX, FAILURE_BELOW = 0.01, 0.99, 0.55
TAG_SCALE = 1000
SAMPLES_PER_SHARD = 64
SHUFFLE_SEED = 42
# ------------------------------------------------------------------------------

EPISODE_ORDER = ("timestamp", "robot_id", "camera_frame_uri")


def embed_episodes(
    signals: DataFrame,
    profile: Profile = ROBOTICS,
    limit: int | None = None,
    backbone: Embedder = DIGEST_BACKBONE,
    order: Sequence[str] = EPISODE_ORDER,
    width: int | None = None,
) -> DataFrame:
    """One vector per robot row, numbered ``robot_id-00000`` in ``order``.

    The backbone sees the text ``camera_frame_uri|[joints]``. ``limit`` takes the
    first rows in ``order``; by default every row is embedded.
    """
    if profile.name != ROBOTICS.name:
        raise ValueError("episode vectors are only defined for the ROBOTICS profile")
    carried = ["robot_id", "robot_model_id", "failure_type_tag", "success_flag"]
    key = F.concat_ws(
        "|",
        F.coalesce("camera_frame_uri", F.lit("")),
        display(F.col("joint_positions"), T.ArrayType(T.FloatType())),
    )
    keyed = signals.select(*dict.fromkeys([*order, *carried]), key.alias("_key"))
    if limit is not None:
        keyed = keyed.orderBy(*order).limit(limit)
    numbered = position_in(keyed, [*order, "_key"], width=width, keep=[*carried, "_key"])
    # Zero-padded to five digits, longer numbers in full.
    number = F.col("position").cast("string")
    padded = F.when(F.length(number) < 5, F.lpad(number, 5, "0")).otherwise(number)
    robot = F.coalesce("robot_id", F.lit("None"))
    return (
        numbered.withColumn("vla_feature_vector", backbone.embed(F.col("_key")))
        .withColumn("episode_id", F.concat(robot, F.lit("-"), padded))
        .withColumn("success_flag", F.coalesce("success_flag", F.lit(False)))
        .withColumn("feature_dim", F.size("vla_feature_vector"))
        .withColumn("backbone", F.lit(backbone.name))
        .select(*EPISODE_SCHEMA.names)
    )


def _total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda total, v: total + v.cast("double"))


def score_episodes(episodes: DataFrame, vector: str = "vla_feature_vector") -> DataFrame:
    """Add policy_confidence, is_failure and scored_tag; sums are in double.

    An empty or undefined mean gives the lowest confidence.
    """
    scored = episodes.withColumn("_total", _total(F.col(vector)))
    mean = F.try_divide(F.col("_total"), F.size(vector))
    raw = F.lit(CONFIDENCE_BASE) + F.lit(CONFIDENCE_SPAN) * F.tanh(mean * F.lit(CONFIDENCE_GAIN))
    clipped = F.least(F.lit(CONFIDENCE_MAX), F.greatest(F.lit(CONFIDENCE_MIN), raw))
    confidence = F.when(mean.isNull() | F.isnan(mean), CONFIDENCE_MIN).otherwise(clipped)
    number = F.pmod(
        F.floor(F.abs(F.coalesce("_total", F.lit(0.0)) * F.lit(TAG_SCALE))).cast("bigint"),
        F.lit(len(FAILURE_TAGS)),
    ).cast("int")
    tag = F.element_at(F.array(*[F.lit(t) for t in FAILURE_TAGS]), number + 1)
    return (
        scored.withColumn("policy_confidence", confidence)
        .withColumn("is_failure", F.col("policy_confidence") < F.lit(FAILURE_BELOW))
        .withColumn("scored_tag", F.when(F.col("is_failure"), tag))
        .drop("_total")
    )


def live_events(
    episodes: DataFrame, model_version: str, deployment_env: str, batch_us: int | None = None
) -> DataFrame:
    """Inference events of one scoring batch, in the live table's schema.

    The id is a digest of (model, episode, batch), so it neither depends on row
    order nor repeats between batches. ``batch_us`` defaults to the query's time.
    """
    stamp = F.unix_micros(F.current_timestamp()) if batch_us is None else F.lit(batch_us)
    digest = F.sha2(
        F.concat_ws("|", F.lit(model_version), F.col("episode_id"), stamp.cast("string")), 256
    )
    scored = score_episodes(episodes)
    return scored.select(
        F.concat(F.lit("inf-"), F.substring(digest, 1, 32)).alias("inference_id"),
        "episode_id",
        "robot_model_id",
        F.lit(model_version).alias("model_version"),
        stamp.cast("bigint").alias("ts_us"),
        "policy_confidence",
        "is_failure",
        F.col("scored_tag").alias("failure_type_tag"),
        F.lit(deployment_env).alias("deployment_env"),
    )


# --- training shards ----------------------------------------------------------
def shard_manifest(
    episodes: DataFrame,
    samples_per_shard: int = SAMPLES_PER_SHARD,
    shuffle_seed: int = SHUFFLE_SEED,
) -> DataFrame:
    """Episodes with their shard and place in it after a global shuffle.

    The shuffle is an order by a seeded digest of the id, so it is the same on
    every run and cluster size.
    """
    seeded = F.sha2(F.concat_ws(":", F.lit(str(shuffle_seed)), F.col("episode_id")), 256)
    keyed = episodes.withColumn("_shuffle", seeded)
    placed = position_by_digest(keyed, "_shuffle", ["episode_id"])
    return (
        placed.withColumn("shard", whole_division(F.col("position"), samples_per_shard))
        .withColumn("place", F.pmod(F.col("position"), F.lit(samples_per_shard)).cast("int"))
        .drop("_shuffle", "position")
    )


#: Runs that the shuffled order is cut in at most; each is written by one task.
MOST_RUNS = 65_536


def _runs(episodes: DataFrame, samples_per_shard: int, shuffle_seed: int) -> DataFrame:
    """Samples with ``first``, the position their run begins at, a run whole in one partition.

    Ids alone are shuffled to number the order and find where runs begin, at whole
    shards; these bounds (:data:`MOST_RUNS` at most, hence broadcast) then send each
    vector straight to the task that writes it, so vectors are shuffled once.
    ``episodes`` must give the same rows each time it is computed.
    """
    spark = episodes.sparkSession
    seeded = F.sha2(F.concat_ws(":", F.lit(str(shuffle_seed)), F.col("episode_id")), 256)
    part = F.conv(F.substring("_shuffle", 1, 4), 16, 10).cast("int")
    ids = (
        episodes.select(seeded.alias("_shuffle"))
        .groupBy("_shuffle")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_part", part)
    )
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ids.groupBy("_part").agg(F.sum("_rows").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("_part").orderBy("_shuffle").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("_before") + F.coalesce(F.sum("_rows").over(within), F.lit(0))
    begins = ids.join(F.broadcast(offsets), "_part").select("_part", "_shuffle", begin.alias(FIRST))

    shards = -(-episodes.count() // samples_per_shard)
    span = samples_per_shard * max(1, -(-shards // MOST_RUNS))
    # Samples of one id stay in one run, which then ends at a later whole shard.
    cuts = (
        begins.filter(F.pmod(F.col(FIRST), F.lit(samples_per_shard)) == 0)
        .groupBy(whole_division(F.col(FIRST), span).alias("_span"))
        .agg(F.min_by(F.struct("_part", "_shuffle", FIRST), FIRST).alias("_cut"))
        .select("_cut.*")
    )
    cuts = materialize(cuts, "runs")
    inside = cuts.groupBy("_part").agg(F.sort_array(F.collect_list(F.struct("_shuffle", FIRST))).alias("_cuts"))
    parts = spark.range(1 << 16).select(F.col("id").cast("int").alias("_part")).join(inside, "_part", "left")
    parts = parts.withColumn("_open", F.max(F.array_max("_cuts")[FIRST]).over(earlier))

    keyed = episodes.withColumn("_shuffle", seeded).withColumn("_part", part).join(F.broadcast(parts), "_part")
    last = F.array_max(F.filter("_cuts", lambda cut: cut["_shuffle"] <= F.col("_shuffle")))[FIRST]
    runs = keyed.select("*", F.coalesce(last, "_open").alias(FIRST)).select(FIRST, "_shuffle", *SAMPLE_COLUMNS)
    return runs.repartition(FIRST).sortWithinPartitions(FIRST, "_shuffle", *SAMPLE_COLUMNS)


def write_training_shards(
    episodes: DataFrame,
    folder: str,
    samples_per_shard: int = SAMPLES_PER_SHARD,
    shuffle_seed: int = SHUFFLE_SEED,
) -> DataFrame:
    """Write one tar of .npy and .json members per shard; returns (shard, path, samples).

    Each task writes whole shards of a fixed number of samples. ``folder`` is a
    place every executor can reach, a new one per run; on a cluster a machine's
    own disk is refused unless it lies in the shared checkpoint folder. Shards
    appear, and the manifest beside the folder after them, when the whole job has
    succeeded; a failed one leaves no shard. A repeated task writes the same
    bytes, so a lost executor leaves neither half nor doubled shards.
    """
    spark = episodes.sparkSession
    folder = shared_folder(spark, folder).rstrip("/")
    write_shards(_runs(episodes, samples_per_shard, shuffle_seed), folder, samples_per_shard, shuffle_seed)
    return list_training_shards(spark, folder).orderBy("shard")
