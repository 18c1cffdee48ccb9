import hashlib
import io
import json
import math
import tarfile
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.embedding import DIGEST_BACKBONE, Embedder, digest_embedding
from tidemark.operators import flywheel
from tidemark.plans import flywheel as plan
from tidemark.plans import medallion
from tidemark.profiles import FAILURE_TAGS, HEALTH_TECH, ROBOTICS

T0 = datetime(2026, 1, 1)


def _signals(spark, n=16):
    rows = [
        (T0 + timedelta(milliseconds=20 * i), f"serial-{i % 8}", "Apollo-1", [float(i)], f"f{i}", "NO_FAILURE",
         None if i == 3 else True)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, ROBOTICS.schema)


def test_digest_vector(spark):
    texts = ["", "abc", "ünï", "x" * 50_000, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    got = {r.t: r.v for r in df.select("t", digest_embedding(F.col("t")).alias("v")).collect()}
    for t in texts:
        raw = np.frombuffer(hashlib.sha256((t or "").encode()).digest() * 4, np.uint8) / 255.0
        want = (raw / (np.linalg.norm(raw) + 1e-8)).astype(np.float32)
        np.testing.assert_array_equal(np.array(got[t], np.float32), want)


def test_episodes(spark):
    out = flywheel.embed_episodes(_signals(spark).repartition(5), width=5)
    assert out.schema.simpleString() == flywheel.EPISODE_SCHEMA.simpleString()
    rows = sorted(out.collect(), key=lambda r: r.episode_id[-5:])
    assert [r.episode_id for r in rows] == [f"serial-{i % 8}-{i:05d}" for i in range(16)]
    assert all(r.feature_dim == len(r.vla_feature_vector) == 128 for r in rows)
    assert rows[3].success_flag is False and rows[4].success_flag is True
    assert {r.backbone for r in rows} == {"digest/sha256"}
    assert len({tuple(r.vla_feature_vector) for r in rows}) == 16
    assert flywheel.embed_episodes(_signals(spark), limit=5).count() == 5


def test_other_profiles_are_refused(spark, lake):
    with pytest.raises(ValueError, match="ROBOTICS"):
        flywheel.embed_episodes(_signals(spark), HEALTH_TECH)
    with pytest.raises(ValueError, match="ROBOTICS"):
        plan.build_episodes(lake(HEALTH_TECH))


def test_backbone_can_be_plugged_in(spark):
    flat = Embedder("flat", lambda key: F.array(F.lit(1.0).cast("float"), F.length(key).cast("float")))
    row = flywheel.embed_episodes(_signals(spark, 1), backbone=flat).first()
    assert row.vla_feature_vector == [1.0, len("f0|[0.0]")] and row.backbone == "flat"


def test_scores(spark):
    vectors = [[0.5, -0.5], [-0.3, -0.4, 0.1], [3.0, 4.0], [-9.0], [0.01, 0.02], [1.2345, -1.3], []]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i int, vla_feature_vector array<double>")
    rows = flywheel.score_episodes(df).orderBy("i").collect()
    for v, r in zip(vectors[:-1], rows):
        confidence = min(0.99, max(0.01, 0.5 + 0.45 * math.tanh(np.mean(v) * 4)))
        assert r.policy_confidence == pytest.approx(confidence, abs=1e-12)
        assert r.is_failure == (confidence < 0.55)
        tag = FAILURE_TAGS[int(abs(sum(v) * 1000)) % 5] if confidence < 0.55 else None
        assert r.scored_tag == tag
    assert rows[-1].policy_confidence == 0.01 and rows[-1].is_failure


def test_closed_loop_over_tables(spark, lake, salt):
    house = lake(ROBOTICS)
    assert plan.build_episodes(house) == 0
    medallion.ingest(house, _signals(spark).fillna(False, ["success_flag"]), salt)
    assert plan.build_episodes(house) == 16  # from Bronze
    medallion.enforce(house, salt)
    assert plan.build_episodes(house, limit=16) == 16  # from Silver
    assert plan.closed_loop(house, "m1", "lab", 7) == 16
    assert plan.closed_loop(house, "m1", "lab") == 16
    live = house.read_product("bronze", flywheel.LIVE_TABLE)
    assert live.schema.simpleString() == flywheel.LIVE_SCHEMA.simpleString()
    assert live.select("inference_id").distinct().count() == 32
    assert live.filter("ts_us = 7").count() == 16


def test_shards(spark, tmp_path):
    episodes = flywheel.embed_episodes(_signals(spark))
    folder = f"file://{tmp_path}/shards"
    out = flywheel.write_training_shards(episodes, folder, samples_per_shard=7).collect()
    assert [(r.shard, r.samples) for r in out] == [(0, 7), (1, 7), (2, 2)]
    files = sorted((tmp_path / "shards").iterdir())
    assert [f.name for f in files] == ["shard-00000.tar", "shard-00001.tar", "shard-00002.tar"]
    stored = {r.episode_id: r for r in episodes.collect()}
    names = []
    for f in files:
        with tarfile.open(f) as tar:
            for member in tar.getmembers():
                key, kind = member.name.rsplit(".", 1)
                data = tar.extractfile(member).read()
                if kind == "npy":
                    names.append(key)
                    vector = np.load(io.BytesIO(data))
                    assert vector.dtype == np.float32
                    assert list(vector) == stored[key].vla_feature_vector
                else:
                    assert json.loads(data) == {
                        f: stored[key][f] for f in ("robot_model_id", "failure_type_tag", "success_flag", "backbone")
                    }
    assert sorted(names) == sorted(stored) and names != sorted(names)
    before = [f.read_bytes() for f in files]
    flywheel.write_training_shards(episodes.repartition(3), folder, samples_per_shard=7)
    assert [f.read_bytes() for f in sorted((tmp_path / "shards").iterdir())] == before
    order = [r.episode_id for r in flywheel.shard_manifest(episodes, 7, 1).orderBy("shard", "place").collect()]
    assert order != names and sorted(order) == sorted(names)


def test_no_episodes_no_shards(spark, tmp_path):
    none = spark.createDataFrame([], flywheel.EPISODE_SCHEMA)
    assert flywheel.write_training_shards(none, f"file://{tmp_path}/s").collect() == []


def test_default_backbone_name():
    assert DIGEST_BACKBONE.name == "digest/sha256"


def test_shards_on_a_cluster_need_a_shared_folder(spark):
    from types import SimpleNamespace

    from tidemark.session import shared_folder

    assert shared_folder(spark, "/data/shards") == "file:/data/shards"
    cluster = SimpleNamespace(
        _jsc=spark._jsc,
        _jvm=spark._jvm,
        conf={"spark.checkpoint.dir": "/shared/ck"},
        sparkContext=SimpleNamespace(master="spark://host:7077"),
    )
    assert shared_folder(cluster, "/shared/ck/run1") == "file:/shared/ck/run1"
    for folder in ("/data/shards", "file:///data/shards", "/shared/ck2"):
        with pytest.raises(ValueError, match="reach"):
            shared_folder(cluster, folder)
