"""Registered queries: each runs an operator over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.embedding import digest_embedding as digest
from tidemark.functions.embedding import hashed_words
from tidemark.functions.masking import MaskingKey
from tidemark.functions.text import extract_terms as terms
from tidemark.operators import (
    colocated,
    costs,
    flywheel,
    frames,
    gold,
    governance,
    quality,
    retrieval,
    silver,
    sketches,
    vector_index,
)
from tidemark.operators.ranking import position_in
from tidemark.operators.topk import vector_topk as nearest
from tidemark.plans import assistant, end_to_end, medallion, signals
from tidemark.plans import flywheel as flywheel_plan
from tidemark.plans.products import PRODUCT_LINES
from tidemark.profiles import (
    CLINICAL,
    COMMERCIAL,
    FACILITIES,
    HEALTH_TECH,
    MANUFACTURING,
    REGIONS,
    ROBOTICS,
    Profile,
)
from tidemark.session import materialize, scratch_path
from tidemark.sources import star_tables
from tidemark.sources.alignment import align_to_schema as align
from tidemark.sources.lakehouse import Lakehouse
from tidemark.sources.run_results import parse_run_results
from tidemark.sources.run_results import read_run_results as read_results
from tidemark.sources.shards import read_training_shards
from tidemark.streaming import stateful
from tidemark.streaming.downsample import read_time_frames, write_time_frames
from tidemark.streaming.downsample import stream_downsample_time as time_frames
from tidemark.streaming.index_feed import stream_index
from tidemark.streaming.ingest import append_scores as stream_scores
from tidemark.streaming.ingest import stream_bronze_ingest as stream_ingest
from tidemark.streaming.run_feed import read_feed_results, read_quarantine, stream_run_results

#: For checks only: the SQL side needs the same key.
CHECK_SALT = "tidemark-check-salt-0123456789"
BATCH_US = 1_767_225_600_000_000
WORDS = {"region": REGIONS, "connective": ("that", "the", "et", "und", "la", "der")}

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _placed(df: DataFrame) -> DataFrame:
    """With ``place``, the position of each row in the order in which ``df`` gives them out."""
    given = materialize(df.withColumn("_given", F.monotonically_increasing_id()), "ordered")
    return position_in(given, ["_given"], name="place").drop("_given")


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _key(spark: SparkSession) -> MaskingKey:
    return MaskingKey(spark, CHECK_SALT)


def _bronze(spark: SparkSession, folder: str, profile: Profile) -> DataFrame:
    return star_tables.bronze(spark, folder, profile.name, _key(spark))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return star_tables.table(spark, folder, name)


def _lake(spark: SparkSession, profile: Profile) -> Lakehouse:
    """A lakehouse of its own below the shared folder."""
    return Lakehouse(
        spark, profile, scratch_path(spark, "lake"), prefix=f"check_{uuid.uuid4().hex[:12]}"
    )


# --- Silver and Gold ----------------------------------------------------------
def _joints_apart(df: DataFrame) -> DataFrame:
    """The joint list as seven plain columns."""
    joints = {f"joint_{i + 1}": F.col("joint_positions")[i].cast("double") for i in range(7)}
    return df.withColumns(joints).drop("joint_positions")


@query
def silver_robot_signals(spark, folder):
    return _joints_apart(silver.silver_robot_signals(_bronze(spark, folder, ROBOTICS)))


@query
def silver_robot_joints(spark, folder):
    """The whole joint list, one row per place."""
    signals = silver.silver_robot_signals(_bronze(spark, folder, ROBOTICS))
    own = signals.select("timestamp", "robot_id", F.posexplode("joint_positions").alias("place", "value"))
    return own.withColumns({"place": F.col("place").cast("bigint"), "value": F.col("value").cast("double")})


@query
def silver_plc_registers(spark, folder):
    return silver.silver_plc_registers(_bronze(spark, folder, MANUFACTURING))


@query
def silver_wearable_biometrics(spark, folder):
    # A whole-number column with nulls is compared as double.
    return silver.silver_wearable_biometrics(_bronze(spark, folder, HEALTH_TECH)).withColumn(
        "heart_rate_variability", F.col("heart_rate_variability").cast("double")
    )


@query
def silver_subscription_events(spark, folder):
    return silver.silver_subscription_events(_bronze(spark, folder, COMMERCIAL))


@query
def silver_ecrf_observations(spark, folder):
    return silver.silver_ecrf_observations(_bronze(spark, folder, CLINICAL))


@query
def gold_robot_health(spark, folder):
    return gold.gold_robot_health(silver.silver_robot_signals(_bronze(spark, folder, ROBOTICS)))


@query
def gold_facility_health(spark, folder):
    return gold.gold_facility_health(
        silver.silver_plc_registers(_bronze(spark, folder, MANUFACTURING))
    )


@query
def gold_cohort_summary(spark, folder):
    return gold.gold_cohort_summary(
        silver.silver_wearable_biometrics(_bronze(spark, folder, HEALTH_TECH))
    )


@query
def gold_account_health(spark, folder):
    return gold.gold_account_health(
        silver.silver_subscription_events(_bronze(spark, folder, COMMERCIAL))
    )


@query
def gold_study_safety(spark, folder):
    return gold.gold_study_safety(
        silver.silver_ecrf_observations(_bronze(spark, folder, CLINICAL))
    )


@query
def gold_patient_sketches(spark, folder):
    """Patients per study and in all, from sketches of two halves of Silver, against the exact counts."""
    lake = _lake(spark, CLINICAL)
    observations = silver.silver_ecrf_observations(_bronze(spark, folder, CLINICAL))
    early = F.dayofmonth("timestamp") <= 15
    sketches.append_sketches(lake, observations.filter(early), "study_id")
    sketches.append_sketches(lake, observations.filter(~early), "study_id")
    stored = lake.read_product("gold", sketches.SKETCH_TABLE)
    estimates = sketches.distinct_patients(stored, "key").unionByName(
        sketches.distinct_patients(stored).withColumn("key", F.lit("all"))
    )
    each = F.explode(F.array("study_id", F.lit("all"))).alias("key")
    exact = observations.select(each, "patient_id_hashed").groupBy("key").agg(
        F.count_distinct("patient_id_hashed").alias("exact")
    )
    off = F.abs(F.col("patient_count") - F.col("exact"))
    bound = F.greatest(F.lit(1.0), 4 * sketches.relative_error() * F.col("exact"))
    return estimates.join(exact, "key").select(
        "key", "exact", "observation_count", (off <= bound).alias("within_bound")
    )


@query
def order_by_key(spark, folder):
    """Where each key stands in the five Gold products, and a missing key among them."""
    golds = {
        "robot_model_id": gold_robot_health, "facility_id": gold_facility_health, "region": gold_cohort_summary,
        "plan_tier": gold_account_health, "study_id": gold_study_safety,
    }
    placed = [
        _placed(product(spark, folder).select(F.lit(key).alias("product"), F.col(key).alias("key")))
        for key, product in golds.items()
    ]
    robots = _bronze(spark, folder, ROBOTICS)
    nameless = robots.withColumn("robot_model_id", F.nullif("robot_model_id", F.lit("Optimus-Gen2")))
    ordered = gold.gold_robot_health(silver.silver_robot_signals(nameless))
    placed.append(_placed(ordered.select(F.lit("nameless").alias("product"), F.col("robot_model_id").alias("key"))))
    return reduce(DataFrame.unionByName, placed)


@query
def align_to_schema(spark, folder):
    """Reordered, cast, one column missing, one too many."""
    batch = _table(spark, folder, "customer").select(
        F.col("c_acctbal").alias("monthly_revenue"),
        F.col("c_custkey").alias("customer_id_hashed"),
        F.col("c_nationkey").cast("bigint").alias("tenure_months"),
        F.col("c_mktsegment").alias("plan_tier"),
        F.col("c_name").alias("not_declared"),
    )
    return align(batch, COMMERCIAL.schema)


@query
def drop_null_identifier(spark, folder):
    return silver.drop_null_identifier(_dirty(spark, folder), "facility_id")


@query
def null_out_of_range(spark, folder):
    df = _table(spark, folder, "events").select("event_id", "value", "user_id")
    kept = silver.null_out_of_range(df, {"value": (5, 200), "user_id": (10, 100)})
    return kept.withColumn("user_id", F.col("user_id").cast("double"))


@query
def threshold_breach(spark, folder):
    limits = (("l_quantity", "<", 3.0), ("l_quantity", ">=", 49.0), ("l_tax", "<=", 0.0))
    return _table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", silver.threshold_breach(limits).alias("breach")
    )


# --- tables -------------------------------------------------------------------
@query
def append_product(spark, folder):
    """Two appends of the same masked batch, read back."""
    lake = _lake(spark, MANUFACTURING)
    raw = star_tables.plc_registers_raw(spark, folder)
    medallion.ingest(lake, raw, CHECK_SALT)
    medallion.ingest(lake, raw, CHECK_SALT)
    return lake.read_product("bronze", MANUFACTURING.bronze_table)


@query
def overwrite_product(spark, folder):
    """A table rebuilt from itself: customers in debt are dropped."""
    lake = _lake(spark, COMMERCIAL)
    lake.append_product("gold", "customers", _table(spark, folder, "customer"))
    kept = lake.read_product("gold", "customers").filter("c_acctbal >= 0")
    lake.overwrite_product("gold", "customers", kept)
    return lake.read_product("gold", "customers")


@query
def upsert_product(spark, folder):
    """Balances of the customers in debt are set to zero."""
    lake = _lake(spark, COMMERCIAL)
    customers = _table(spark, folder, "customer")
    lake.append_product("gold", "customers", customers)
    changed = customers.filter("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    lake.upsert_product("gold", "customers", changed, "c_custkey")
    return lake.read_product("gold", "customers")


@query
def export_parquet(spark, folder):
    """Bronze as a parquet drop, scanned as a source with its declared schema."""
    lake = _lake(spark, CLINICAL)
    medallion.ingest(lake, star_tables.ecrf_observations_raw(spark, folder), CHECK_SALT)
    path = lake.export_parquet("bronze", CLINICAL.bronze_table, scratch_path(spark, "drop"))
    return spark.read.schema(CLINICAL.schema).parquet(path)


@query
def enforce(spark, folder):
    """Bronze to published Gold through tables, contracts and tests."""
    lake = _lake(spark, COMMERCIAL)
    medallion.ingest(lake, star_tables.subscription_events_raw(spark, folder), CHECK_SALT)
    medallion.enforce(lake, CHECK_SALT)
    return lake.read_product("gold", "gold_account_health")


@query
def enforce_profiles(spark, folder):
    """Every measure of the Gold tables that the five builds publish."""
    measures = []
    for name, line in PRODUCT_LINES.items():
        lake = _lake(spark, line.profile)
        medallion.ingest(lake, star_tables.raw(spark, folder, name), CHECK_SALT)
        medallion.enforce(lake, CHECK_SALT)
        published = lake.read_product("gold", line.gold.name)
        key, *others = published.columns
        values = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in others]
        apart = published.select(F.col(key).alias("key"), F.explode(F.array(*values)).alias("m"))
        measures.append(apart.select(F.lit(line.gold.name).alias("product"), "key", "m.measure", "m.value"))
    return reduce(DataFrame.unionByName, measures)


@query
def first_available(spark, folder):
    """Frames of the channel found in Bronze, as no Silver exists."""
    lake = _lake(spark, MANUFACTURING)
    medallion.ingest(lake, star_tables.plc_registers_raw(spark, folder), CHECK_SALT)
    return signals.profile_frames(
        lake, "facility_id", ["timestamp", "register_id", "measured_voltage"]
    )


# --- governance ---------------------------------------------------------------
@query
def mask_sensitive(spark, folder):
    df = _table(spark, folder, "customer").select(
        "c_custkey", F.col("c_name").alias("customer_id_hashed"), "c_mktsegment"
    )
    return governance.mask_sensitive(df, COMMERCIAL, _key(spark))


@query
def mask_column(spark, folder):
    """A token, a longer one, and what the unmasking role reads."""
    key, name = _key(spark), F.col("c_name")
    role = governance.SECURITY_OPERATIONS
    return _table(spark, folder, "customer").select(
        "c_custkey",
        key.mask(name).alias("token"),
        key.mask(name, length=64).alias("long_token"),
        key.mask(name, "ML_RESEARCHER", role).alias("for_others"),
        key.mask(name, role, role).alias("for_security"),
    )


@query
def masked_join(spark, folder):
    key = _key(spark)
    orders = _table(spark, folder, "orders").select(
        "o_orderkey", key.mask(F.col("o_custkey").cast("string")).alias("masked_id")
    )
    customers = _table(spark, folder, "customer").select(
        key.mask(F.col("c_custkey").cast("string")).alias("masked_id"), "c_name", "c_mktsegment"
    )
    return governance.masked_join(orders, customers, "masked_id")


@query
def masked_join_stored(spark, folder):
    """The same from two bucketed tables; customers with more than 20 orders are in slices."""
    key, lake = _key(spark), _lake(spark, COMMERCIAL)
    orders = _table(spark, folder, "orders").select(
        "o_orderkey", key.mask(F.col("o_custkey").cast("string")).alias("masked_id")
    )
    customers = _table(spark, folder, "customer").select(
        key.mask(F.col("c_custkey").cast("string")).alias("masked_id"), "c_name", "c_mktsegment"
    )
    stored = colocated.store_for_join(
        lake, "gold", "order_customers", orders, customers, "masked_id", buckets=8, slice_rows=20
    )
    return colocated.join_stored(lake, stored)


def _accounts(spark, folder):
    return star_tables.subscription_events_raw(spark, folder)


@query
def secure_view_hmac(spark, folder):
    return governance.secure_view(
        _accounts(spark, folder), COMMERCIAL, "ML_RESEARCHER", "hmac", _key(spark)
    )


@query
def secure_view_null(spark, folder):
    """A governance admin sees the rows but not the ids."""
    return governance.secure_view(
        _accounts(spark, folder), COMMERCIAL, governance.GROUP_GOVERNANCE_ADMINS, "null"
    )


@query
def row_security_filter(spark, folder):
    """What each group sees: all, rows without ids, and for anyone else nothing."""
    holders = {
        "operations": governance.GROUP_SECURITY_OPERATIONS,
        "admins": governance.GROUP_GOVERNANCE_ADMINS,
        "others": "ML_RESEARCHER",
    }
    views = [
        governance.secure_view(_accounts(spark, folder), COMMERCIAL, role, "null")
        .withColumn("holder", F.lit(holder))
        for holder, role in holders.items()
    ]
    return reduce(DataFrame.unionByName, views)


@query
def secure_view_deny(spark, folder):
    return governance.secure_view(_accounts(spark, folder), COMMERCIAL, "ML_RESEARCHER", "deny")


@query
def publish_tiers(spark, folder):
    """Every table of every domain, built, published and counted."""
    counts = []
    for name, line in PRODUCT_LINES.items():
        lake = _lake(spark, line.profile)
        medallion.ingest(lake, star_tables.raw(spark, folder, name), CHECK_SALT)
        medallion.enforce(lake, CHECK_SALT)
        for product in (line.silver, line.gold):
            counts.append(
                lake.read_product(product.tier, product.name).agg(
                    F.lit(f"{product.tier}.{product.name}").alias("table_name"),
                    F.count(F.lit(1)).alias("row_count"),
                )
            )
    return reduce(DataFrame.unionByName, counts)


# --- data tests ---------------------------------------------------------------
def _dirty(spark, folder):
    """Controller readings with missing and unknown facilities and a missing flag."""
    line = F.col("l_linenumber")
    return _table(spark, folder, "lineitem").select(
        F.col("l_shipdate").alias("timestamp"),
        F.when(line == 7, F.lit(None).cast("string"))
        .when((line == 6) & (F.col("l_quantity") > 45), "Elsewhere_09")
        .when(F.col("l_linestatus") == "O", FACILITIES[0])
        .otherwise(FACILITIES[1])
        .alias("facility_id"),
        F.col("l_suppkey").cast("string").alias("REGISTER_ID"),
        F.col("l_orderkey").alias("order_key"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R").alias("anomaly_flag"),
    )


@query
def test_not_null(spark, folder):
    return quality.test_not_null(_dirty(spark, folder), "anomaly_flag")


@query
def test_accepted_values(spark, folder):
    return quality.test_accepted_values(_dirty(spark, folder), "facility_id", FACILITIES)


@query
def test_unique(spark, folder):
    return quality.test_unique(_dirty(spark, folder), "order_key")


@query
def test_unique_tokens(spark, folder):
    """The same of masked order keys, told apart by their hashes first."""
    token = _key(spark).mask(F.col("order_key").cast("string"))
    return quality.test_unique(_dirty(spark, folder).withColumn("token", token), "token")


@query
def test_no_sensitive_columns(spark, folder):
    return quality.test_no_sensitive_columns(_dirty(spark, folder), ("register_id", "ssn"))


@query
def check_contract(spark, folder):
    return quality.check_contract(
        _dirty(spark, folder), PRODUCT_LINES["MANUFACTURING"].silver.contract
    )


@query
def quality_report(spark, folder):
    """Every declared test of a product at once."""
    tests = quality.DataTests(
        not_null=("timestamp", "facility_id", "anomaly_flag"),
        accepted={"facility_id": FACILITIES},
        unique=("order_key",),
    )
    return quality.quality_report(_dirty(spark, folder), tests)


# --- frames -------------------------------------------------------------------
def _heart_rates(spark, folder):
    return _table(spark, folder, "events").select(
        "event_type", "ts", "event_id", F.floor("value").cast("int").alias("hrv")
    )


_HRV = dict(profile=HEALTH_TECH.name, label=HEALTH_TECH.metric[0], mode=HEALTH_TECH.metric[1])


@query
def assign_frames(spark, folder):
    return frames.assign_frames(_heart_rates(spark, folder), "event_type", ["ts", "event_id"])


@query
def drop_nulls_in_signal(spark, folder):
    signal = silver.null_out_of_range(_heart_rates(spark, folder), {"hrv": (5, 200)})
    return frames.drop_nulls_in_signal(signal, "hrv")


@query
def signal_downsample(spark, folder):
    return frames.signal_downsample(
        _heart_rates(spark, folder), "hrv", "event_type", ["ts", "event_id"], **_HRV
    )


@query
def signal_downsample_max(spark, folder):
    """Peak joint position per robot model."""
    df = _table(spark, folder, "embeddings").select(
        F.col("label").alias("model"), "vec_id", F.array_max("embedding").alias("peak")
    )
    label, mode = ROBOTICS.metric
    return frames.signal_downsample(df, "peak", "model", ["vec_id"], mode, ROBOTICS.name, label)


def _hourly(spark, folder):
    df = _heart_rates(spark, folder)
    first, last = df.agg(F.min("ts"), F.max("ts")).first()
    start: datetime = first.replace(minute=0, second=0, microsecond=0)
    end = last.replace(minute=0, second=0, microsecond=0) + timedelta(hours=1)
    return frames.idle_frames(
        df, "hrv", "event_type", "ts", start=start, end=end, step_us=3_600_000_000, **_HRV
    )


@query
def idle_frames(spark, folder):
    return _hourly(spark, folder)


@query
def frame_history(spark, folder):
    history = frames.frame_history(_hourly(spark, folder), "event_type", chunk=200)
    return history.withColumn("history_avg", F.round("history_avg", 10))


@query
def frame_history_resets(spark, folder):
    """The alert with an operator who resets every stream after every fifth frame."""
    hourly = _hourly(spark, folder)
    resets = hourly.filter(F.col("frame") % 5 == 2).select("event_type", "frame")
    history = frames.frame_history(hourly, "event_type", chunk=200, resets=resets)
    return history.select("event_type", "frame", "status", "hardware_status")


@query
def latest_history(spark, folder):
    state = frames.latest_history(_hourly(spark, folder), "event_type")
    return state.select(
        "event_type",
        "latest_frame",
        F.size("history").alias("points"),
        # In whole ten-thousandths: the sum must not depend on its order.
        F.aggregate(
            F.transform("history", lambda v: F.round(v * 10_000).cast("bigint")),
            F.lit(0).cast("bigint"),
            lambda total, v: total + v,
        ).alias("total"),
        F.element_at("history", -1).alias("newest"),
        "hardware_status",
    )


def _feed(df: DataFrame, moment: str = "ts", late: str = "0", parts: int = 4) -> DataFrame:
    """A table as a stream of ``parts`` micro-batches in the order of arrival.

    ``late`` is by how many microseconds a row arrives after ``moment``.
    """
    spark = df.sparkSession
    feed = scratch_path(spark, "feed")
    arrival = F.unix_micros(F.col(moment).cast("timestamp")) + F.expr(late)
    arriving = df.withColumn("_arrival", arrival)
    first, last = arriving.agg(F.min("_arrival"), F.max("_arrival")).first()
    step = (last - first) // parts + 1
    for part in range(parts):
        begin = first + part * step
        (
            arriving.filter(F.col("_arrival").between(begin, begin + step - 1))
            .drop("_arrival").coalesce(1).write.mode("append").parquet(feed)
        )
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(feed)


#: Events arrive up to six minutes late; the streams wait for ten.
_LATE = "event_id % 7 * 60000000"
_TEN = "10 minutes"


@query
def stream_downsample_time(spark, folder):
    """Time frames of events that arrive up to six minutes late, in four micro-batches."""
    written = scratch_path(spark, "frames")
    stream = _feed(_heart_rates(spark, folder), late=_LATE)
    framed = time_frames(stream, "hrv", "event_type", "ts", step_us=600_000_000, delay=_TEN, **_HRV)
    write_time_frames(framed, written, scratch_path(spark, "checkpoint"), once=True).awaitTermination()
    return read_time_frames(spark, written, "event_type")


def _written(spark: SparkSession, frames: DataFrame) -> DataFrame:
    """What a stream of frames gives out by its last micro-batch."""
    written = scratch_path(spark, "frames")
    stateful.write_frames(frames, written, scratch_path(spark, "checkpoint"), once=True).awaitTermination()
    return spark.read.schema(frames.schema).parquet(written)


@query
def stream_count_frames(spark, folder):
    """Full frames of exactly 17 samples from late events, in four micro-batches."""
    stream = _feed(_heart_rates(spark, folder), late=_LATE)
    return _written(
        spark,
        stateful.stream_count_frames(stream, "hrv", "event_type", ["ts", "event_id"], span=_TEN, delay=_TEN, **_HRV),
    )


@query
def stream_idle_frames(spark, folder):
    """Hourly frames and gaps of the same stream, up to its last watermark."""
    rates = _heart_rates(spark, folder)
    start = rates.agg(F.min("ts")).first()[0].replace(minute=0, second=0, microsecond=0)
    ranges = stateful.stream_idle_frames(
        _feed(rates, late=_LATE), "hrv", "event_type", "ts", start=start, step_us=3_600_000_000, delay=_TEN, **_HRV
    )
    return stateful.expand_idle(_written(spark, ranges), start, 3_600_000_000)


@query
def stream_frame_history(spark, folder):
    """History and alerts of a stream of frames, with resets from a second stream."""
    hourly = _hourly(spark, folder)
    resets = hourly.filter(F.col("frame") % 5 == 2).select(
        "event_type", "frame", (F.col("frame_start") + F.expr("INTERVAL 30 MINUTES")).alias("frame_start")
    )
    history = stateful.stream_frame_history(
        _feed(hourly, "frame_start", "frame % 3 * 3600000000"), "event_type", "frame_start",
        resets=_feed(resets, "frame_start"), span="1 hour", delay="2 days",
    )
    return _written(spark, history).withColumn("history_avg", F.round("history_avg", 10))


@query
def stream_bronze_ingest(spark, folder):
    lake = _lake(spark, CLINICAL)
    raw = _feed(_table(spark, folder, "events")).select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("PAT-"), F.col("user_id").cast("string")).alias("patient_id_hashed"),
        F.col("event_type").alias("study_id"),
        (F.col("event_type") == "error").alias("adverse_event_flag"),
    )
    stream_ingest(
        lake, raw, scratch_path(spark, "checkpoint"), CHECK_SALT, once=True
    ).awaitTermination()
    return lake.read_product("bronze", f"{CLINICAL.bronze_table}_feed")


# --- retrieval ----------------------------------------------------------------
@query
def extract_terms(spark, folder):
    """Terms in whole documents and conversation turns."""
    documents = _table(spark, folder, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("source_id"), "text"
    )
    turns = _table(spark, folder, "conversations").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("source_id"), "text"
    )
    found = documents.unionByName(turns).withColumn("filters", terms(F.col("text"), WORDS))
    return found.select("source_id", *[F.col("filters")[f].alias(f) for f in WORDS])


def _raw_accounts(spark, folder):
    raw = star_tables.subscription_events_raw(spark, folder)
    return governance.mask_sensitive(raw, COMMERCIAL, _key(spark))


def _chunks(bronze):
    return retrieval.build_chunks(bronze, COMMERCIAL).select(
        "id", "text", *[F.col("metadata")[f].alias(f) for f in ("plan_tier", "region", "profile")]
    )


@query
def build_chunks(spark, folder):
    return _chunks(_raw_accounts(spark, folder))


@query
def build_chunks_repeated(spark, folder):
    """Every row twice, and those of one customer in sixteen three times."""
    rows = _raw_accounts(spark, folder)
    some = rows.filter(F.col("customer_id_hashed").endswith("0"))
    return _chunks(rows.unionByName(rows).unionByName(some))


@query
def build_chunks_profiles(spark, folder):
    """Chunks of the other four profiles, with lists, and a missing value in every ninth row."""
    parts = []
    for profile in (ROBOTICS, MANUFACTURING, HEALTH_TECH, CLINICAL):
        bronze = _bronze(spark, folder, profile)
        missing = F.second("timestamp") % 9 == 4 if profile is not MANUFACTURING else F.day("timestamp") % 9 == 4
        last = profile.schema.names[-1]
        chunks = retrieval.build_chunks(bronze.withColumn(last, F.when(~missing, F.col(last))), profile)
        terms_found = F.array_join(F.transform(F.array_sort(F.map_entries("metadata")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
        parts.append(chunks.select("id", "text", terms_found.alias("metadata")))
    return reduce(DataFrame.unionByName, parts)


@query
def stream_index_chunks(spark, folder):
    """The index fed from Bronze in three runs; the third brings rows that are there already."""
    lake, checkpoint = _lake(spark, COMMERCIAL), scratch_path(spark, "checkpoint")
    rows = _raw_accounts(spark, folder)
    odd = F.col("tenure_months") % 2 == 1
    again = rows.unionByName(rows.filter(F.col("customer_id_hashed").endswith("0")))
    for part in (rows.filter(odd), rows.filter(~odd), again):
        lake.append_product("bronze", COMMERCIAL.bronze_table, part, COMMERCIAL.schema)
        stream_index(lake, checkpoint).awaitTermination()
    index = lake.read_product(assistant.INDEX_TIER, COMMERCIAL.index_name)
    return index.select("id", "text", *[F.col("metadata")[f].alias(f) for f in ("plan_tier", "region", "profile")])


@query
def filter_by_terms(spark, folder):
    return retrieval.filter_by_terms(
        _bronze(spark, folder, COMMERCIAL),
        {"plan_tier": "PRO", "region": "EU"},
        ["timestamp", "customer_id_hashed", "monthly_revenue"],
    )


@query
def metadata_prefilter(spark, folder):
    condition = retrieval.metadata_prefilter({"plan_tier": "ENTERPRISE", "region": "APAC"})
    return _bronze(spark, folder, COMMERCIAL).filter(condition)


@query
def limit_rows(spark, folder):
    events = _table(spark, folder, "events").select("event_id", "ts", "event_type")
    return retrieval.limit_rows(events, [F.col("ts").desc(), "event_id"], 64)


@query
def embed_text(spark, folder):
    """The non-zero components of the word vectors of whole documents."""
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    vectors = retrieval.embed_text(documents, hashed_words(64))
    return (
        vectors.select("doc_id", F.posexplode("embedding").alias("place", "v"))
        .filter("v > 0")
        .select("doc_id", F.col("place").cast("bigint").alias("bucket"), F.col("v").cast("double").alias("tf"))
    )


@query
def vector_topk(spark, folder):
    """The five vectors nearest to each label's centre, within the label."""
    vectors = _table(spark, folder, "embeddings")
    centres = (
        vectors.select("label", F.posexplode("embedding").alias("place", "v"))
        .groupBy("label", "place")
        .agg(F.avg("v").alias("v"))
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("place", "v"))).alias("entries"))
        .select(F.col("label").alias("query_id"), F.col("entries.v").alias("embedding"))
        .withColumn("within", F.col("query_id"))
    )
    found = nearest(
        centres, vectors, 5, corpus_id="vec_id", where={"label": ("within", "label")}
    )
    return found.withColumn("score", F.round("score", 6))


@query
def vector_topk_blocks(spark, folder):
    """The five vectors nearest to each one whose id 50 divides, in blocks of four queries."""
    vectors = _table(spark, folder, "embeddings")
    asked = vectors.filter(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    found = nearest(asked, vectors, 5, corpus_id="vec_id", block=4)
    return found.withColumn("score", F.round("score", 6))


@query
def vector_index_topk(spark, folder):
    """The same through an index of vector lists; every second one asks for its own label only."""
    vectors = _table(spark, folder, "embeddings")
    index = vector_index.build(vectors, "vec_id", fields={"label": "label"})
    asked = vectors.filter(F.col("vec_id") % 50 == 0).select(
        F.col("vec_id").alias("query_id"), "embedding", F.when(F.col("vec_id") % 100 == 0, F.col("label")).alias("label")
    )
    found = vector_index.search(index, asked, 5, where={"label": "label"})
    return found.withColumnRenamed("id", "vec_id").withColumn("score", F.round("score", 6))


def _questions(spark, folder):
    """One question per nation and market segment found among the customers."""
    groups = _table(spark, folder, "customer").select("c_nationkey", "c_mktsegment").distinct()
    nations = _table(spark, folder, "nation")
    number = F.col("n_nationkey")
    tier = F.when(number % 4 == 0, "FREE").when(number % 4 == 1, "pro").when(
        number % 4 == 2, "Enterprise"
    ).otherwise("revenue")
    area = F.when(number % 3 == 0, "NA").when(number % 3 == 1, "EU").otherwise("anywhere")
    return groups.join(nations, F.col("c_nationkey") == number).select(
        F.concat_ws("/", "n_name", "c_mktsegment").alias("question_id"),
        F.concat_ws(
            " ", F.lit("which"), tier, F.lit("accounts in"), area,
            F.lit("churned_flag=True like"), "n_name", "c_mktsegment",
        ).alias("question"),
    )


def _row_text(row):
    """Every value of a row; money in cents, so that no float is printed."""
    return F.concat_ws(
        "/",
        F.unix_micros(row["timestamp"].cast("timestamp")).cast("string"),
        row["customer_id_hashed"],
        row["plan_tier"],
        row["region"],
        F.round(row["monthly_revenue"].cast("double") * 100).cast("bigint").cast("string"),
        row["tenure_months"].cast("string"),
        row["churned_flag"].cast("string"),
    )


def _answers_flat(answers: DataFrame) -> DataFrame:
    return answers.select(
        "question_id",
        F.col("filters")["plan_tier"].alias("plan_tier"),
        F.col("filters")["region"].alias("region"),
        F.array_join("matched_ids", ",").alias("matched_ids"),
        F.size("rows").alias("row_count"),
        F.array_join(F.transform("rows", _row_text), ",").alias("matched_rows"),
        "answer",
    )


@query
def retrieve(spark, folder):
    bronze = _raw_accounts(spark, folder)
    embedder = hashed_words()
    index = retrieval.embed_text(retrieval.build_chunks(bronze, COMMERCIAL), embedder)
    answers = retrieval.retrieve(
        _questions(spark, folder), index, bronze, COMMERCIAL, embedder,
        order=["timestamp", "customer_id_hashed"],
    )
    return _answers_flat(answers)


@query
def ask(spark, folder):
    """The same answers through a stored Bronze table and index."""
    lake = _lake(spark, COMMERCIAL)
    raw = star_tables.subscription_events_raw(spark, folder)
    medallion.ingest(lake, raw, CHECK_SALT)
    assistant.build_index(lake)
    return _answers_flat(assistant.ask(lake, _questions(spark, folder)))


@query
def asset_chain(spark, folder):
    """Ingest, build, publish, index and ask as one run, with the rows of each step."""
    lake = _lake(spark, COMMERCIAL)
    raw = star_tables.subscription_events_raw(spark, folder)
    report = end_to_end.run(lake, raw, _questions(spark, folder), CHECK_SALT)
    return _answers_flat(report.answers).withColumns(
        {
            "ingested": F.lit(report.ingested).cast("bigint"),
            "indexed": F.lit(report.indexed).cast("bigint"),
            "silver_rows": F.lit(report.published["silver.silver_subscription_events"]).cast("bigint"),
            "gold_rows": F.lit(report.published["gold.gold_account_health"]).cast("bigint"),
        }
    )


# --- flywheel -----------------------------------------------------------------
@query
def digest_embedding(spark, folder):
    """Digest vectors of whole documents, one row per component."""
    vectors = _table(spark, folder, "documents").select(
        "doc_id", digest(F.col("text")).alias("vector")
    )
    return vectors.select("doc_id", F.posexplode("vector").alias("place", "v")).select(
        "doc_id", F.col("place").cast("bigint").alias("place"), F.round(F.col("v").cast("double"), 6).alias("v")
    )


def _episodes(spark, folder):
    return flywheel.embed_episodes(
        silver.silver_robot_signals(_bronze(spark, folder, ROBOTICS))
    )


@query
def embed_episodes(spark, folder):
    return _episodes(spark, folder).select(
        "episode_id", "robot_model_id", "failure_type_tag", "success_flag", "feature_dim", "backbone"
    )


def _signed_episodes(spark, folder):
    """Embeddings as episode vectors: signed, so that some of them fail."""
    return _table(spark, folder, "embeddings").select(
        F.concat(F.lit("ep-"), F.col("vec_id").cast("string")).alias("episode_id"),
        F.col("label").cast("string").alias("robot_model_id"),
        F.lit(None).cast("string").alias("failure_type_tag"),
        F.lit(True).alias("success_flag"),
        F.col("embedding").alias("vla_feature_vector"),
        F.size("embedding").alias("feature_dim"),
        F.lit("given").alias("backbone"),
    )


@query
def score_episodes(spark, folder):
    return flywheel.score_episodes(_signed_episodes(spark, folder)).select(
        "episode_id",
        F.round("policy_confidence", 9).alias("policy_confidence"),
        "is_failure",
        "scored_tag",
    )


@query
def closed_loop(spark, folder):
    """Episodes scored and appended to the live table."""
    lake = _lake(spark, ROBOTICS)
    lake.overwrite_product(
        "gold", flywheel.EPISODES_TABLE, _signed_episodes(spark, folder), flywheel.EPISODE_SCHEMA
    )
    flywheel_plan.closed_loop(lake, "policy_v1", "simulation", BATCH_US)
    return lake.read_product("bronze", flywheel.LIVE_TABLE).withColumn(
        "policy_confidence", F.round("policy_confidence", 9)
    )


@query
def append_scores(spark, folder):
    """Inference events of a stream of vectors, appended batch by batch."""
    lake = _lake(spark, ROBOTICS)
    arrived = _table(spark, folder, "embeddings").withColumn("at", F.timestamp_seconds("vec_id"))
    episodes = _feed(arrived, "at").select(
        F.concat(F.lit("ep-"), F.col("vec_id").cast("string")).alias("episode_id"),
        F.col("label").cast("string").alias("robot_model_id"),
        F.col("embedding").alias("vla_feature_vector"),
    )
    events = flywheel.live_events(episodes, "policy_v1", "simulation", BATCH_US)
    stream_scores(
        lake, events, scratch_path(spark, "checkpoint"), once=True
    ).awaitTermination()
    return lake.read_product("bronze", flywheel.LIVE_TABLE).withColumn(
        "policy_confidence", F.round("policy_confidence", 9)
    )


@query
def write_training_shards(spark, folder):
    """Which episode went to which shard, read back from the shards published."""
    target = scratch_path(spark, "tars")
    written = flywheel.write_training_shards(_signed_episodes(spark, folder), target)
    samples = read_training_shards(spark, target).select("episode_id", "shard", "place")
    return samples.join(written.select("shard", "samples"), "shard")


# --- costs --------------------------------------------------------------------
def _runs(spark, folder):
    """Every event as a run artifact: a JSON document with one or two results."""
    seconds = F.col("value") / 1000
    first = F.struct(
        F.col("event_type").alias("unique_id"),
        F.when(F.col("user_id") % 7 == 0, F.lit(None)).otherwise("success").alias("status"),
        seconds.alias("execution_time"),
    )
    second = F.struct(
        F.lit(None).cast("string").alias("unique_id"),
        F.lit("error").alias("status"),
        F.lit(None).cast("double").alias("execution_time"),
    )
    results = F.when(F.col("user_id") % 5 == 0, F.array(first, second)).otherwise(F.array(first))
    return _table(spark, folder, "events").select(
        "event_id",
        F.lit("HEALTH_TECH").alias("data_product"),
        F.to_json(F.struct(results.alias("results"))).alias("document"),
    )


@query
def read_run_results(spark, folder):
    """The artifacts written as files, one document per line, and read back."""
    path = scratch_path(spark, "artifacts")
    _runs(spark, folder).select(F.col("document").alias("value")).write.text(path)
    results = read_results(spark, path, "HEALTH_TECH", one_per_line=True)
    return results.groupBy("data_product", "position", "unique_id", "status").agg(
        F.count(F.lit(1)).alias("results"),
        F.count("execution_time").alias("timed"),
        F.max("execution_time").alias("longest"),
    )


def _run_feed(spark, folder):
    """The artifacts as a feed of files; every eleventh document is cut off, every thirteenth has no list."""
    source, target = scratch_path(spark, "artifacts"), scratch_path(spark, "run_feed")
    number, document = F.col("event_id"), F.col("document")
    given = F.when(number % 11 == 3, F.expr("left(document, length(document) - 5)")).when(
        number % 13 == 5, F.concat(F.lit('{"run": '), number.cast("string"), F.lit("}"))
    ).otherwise(document)
    _runs(spark, folder).select(given.alias("value")).repartition(4, "value").write.text(source)
    stream_run_results(
        spark, source, target, scratch_path(spark, "checkpoint"), "HEALTH_TECH", one_per_line=True, once=True, files=1
    ).awaitTermination()
    return target


@query
def stream_run_results_good(spark, folder):
    """Results of the good documents of the feed, in several micro-batches."""
    results = read_feed_results(spark, _run_feed(spark, folder))
    return results.groupBy("data_product", "position", "unique_id", "status").agg(
        F.count(F.lit(1)).alias("results"),
        F.count("execution_time").alias("timed"),
        F.max("execution_time").alias("longest"),
    )


@query
def stream_run_results_quarantine(spark, folder):
    """The bad documents of the same feed, with the reason."""
    bad = read_quarantine(spark, _run_feed(spark, folder))
    return bad.groupBy("reason").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count("file").alias("with_file"),
        # Without digits and exponents, which other engines print in other ways.
        F.sum(F.length(F.regexp_replace("document", "[0-9.eE-]", ""))).alias("characters"),
    )


@query
def cost_attribution(spark, folder):
    results = parse_run_results(_runs(spark, folder), "document")
    return costs.sort_by_cost(costs.cost_attribution(results), "event_id", "position")


@query
def sort_by_cost(spark, folder):
    """Where each node stands when the longest come first."""
    results = parse_run_results(_runs(spark, folder), "document")
    ordered = costs.sort_by_cost(costs.cost_attribution(results), "event_id", "position")
    return _placed(ordered.select("event_id", "position", "node", "execution_time_s"))


@query
def total_cost(spark, folder):
    results = parse_run_results(_runs(spark, folder), "document")
    return costs.total_cost(costs.cost_attribution(results), "data_product", "node")
