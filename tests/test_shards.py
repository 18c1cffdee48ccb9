import json
import tarfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import flywheel
from tidemark.sources import shards


def _samples(spark, n, ids=None):
    rows = [(f"ep-{i if ids is None else ids[i]}", "m", None, i % 2 == 0, [float(i), 0.5], 2, "b") for i in range(n)]
    return spark.createDataFrame(rows, flywheel.EPISODE_SCHEMA)


def _listing(folder):
    return {f.relative_to(folder).as_posix(): f.read_bytes() for f in sorted(folder.rglob("*")) if f.is_file()}


def test_samples_come_back_in_the_shuffled_order(spark, tmp_path):
    given = _samples(spark, 50).repartition(3)
    flywheel.write_training_shards(given, f"file://{tmp_path}/s", 8)
    got = shards.read_training_shards(spark, f"{tmp_path}/s")
    placed = flywheel.shard_manifest(given, 8).select(*got.columns)
    assert got.exceptAll(placed).count() == placed.exceptAll(got).count() == 0
    assert json.loads((tmp_path / "s.manifest.json").read_text()) == {
        "shards": 7, "samples": 50, "samples_per_shard": 8, "shuffle_seed": 42,
    }
    assert sorted(f.name for f in tmp_path.iterdir()) == ["s", "s.manifest.json"]


@pytest.mark.parametrize("most", [1, 3])
def test_long_runs_give_the_same_shards(spark, tmp_path, monkeypatch, most):
    given = _samples(spark, 50)
    flywheel.write_training_shards(given, f"file://{tmp_path}/a", 8)
    monkeypatch.setattr(flywheel, "MOST_RUNS", most)
    flywheel.write_training_shards(given.repartition(5), f"file://{tmp_path}/b", 8)
    assert _listing(tmp_path / "a") == _listing(tmp_path / "b")


def test_repeated_and_missing_ids_and_vectors_stay(spark, tmp_path):
    given = _samples(spark, 40, [i % 7 if i < 30 else i for i in range(40)])
    given = given.withColumn("episode_id", F.when(F.col("episode_id") != "ep-33", F.col("episode_id")))
    given = given.withColumn("vla_feature_vector", F.when(F.col("episode_id") != "ep-34", F.col("vla_feature_vector")))
    flywheel.write_training_shards(given, f"file://{tmp_path}/s", 4)
    got = shards.read_training_shards(spark, f"{tmp_path}/s").drop("shard", "place")
    want = given.select(*got.columns).fillna("None", ["episode_id"])
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    sizes = [r.samples for r in shards.list_training_shards(spark, f"{tmp_path}/s").collect()]
    assert sizes == [4] * 10


def test_failed_job_leaves_no_shard_and_keeps_published_ones(spark, tmp_path):
    good = _samples(spark, 40)
    late = F.when(F.col("episode_id") != "ep-7", F.col("robot_model_id"))
    bad = good.withColumn("robot_model_id", F.coalesce(late, F.raise_error(F.lit("broken sample"))))
    with pytest.raises(Exception, match="broken sample"):
        flywheel.write_training_shards(bad, f"file://{tmp_path}/s", 8)
    assert list(tmp_path.iterdir()) == []
    with pytest.raises(FileNotFoundError, match="published"):
        shards.read_training_shards(spark, f"{tmp_path}/s")
    flywheel.write_training_shards(good, f"file://{tmp_path}/s", 8)
    before = _listing(tmp_path)
    with pytest.raises(Exception, match="broken sample"):
        flywheel.write_training_shards(bad, f"file://{tmp_path}/s", 8)
    assert _listing(tmp_path) == before


def _batch(positions, first):
    rows = [
        {"first": first, "episode_id": f"e{i}", "vla_feature_vector": [float(i)], "robot_model_id": None,
         "failure_type_tag": None, "success_flag": True, "backbone": "b"}
        for i in positions
    ]
    return pa.RecordBatch.from_pylist(rows)


def test_killed_and_repeated_tasks_write_each_shard_once(tmp_path):
    writer = shards.ShardWriter(f"file:{tmp_path}/s", 4, 0)

    def breaks_off():
        yield _batch(range(6), 0)
        raise OSError("executor lost")

    with pytest.raises(OSError):
        writer.write(breaks_off())
    assert not (tmp_path / "s").exists()
    messages = [writer.write(iter([_batch(range(6), 0), _batch(range(6, 8), 0)])), writer.write(iter([]))]
    messages += [writer.write(iter([_batch(range(8, 11), 8)])) for _ in range(2)][:1]
    writer.commit(messages)
    names = []
    for file in sorted((tmp_path / "s").iterdir()):
        with tarfile.open(file) as tar:
            names.append([m.name[:-4] for m in tar if m.name.endswith(".npy")])
    assert names == [["e0", "e1", "e2", "e3"], ["e4", "e5", "e6", "e7"], ["e8", "e9", "e10"]]


@pytest.mark.parametrize("runs", [[(0, 8), (12, 4)], [(0, 8), (0, 8)], [(0, 6), (6, 4)], [(4, 4)]])
def test_commit_refuses_gaps_and_doubles(tmp_path, runs):
    writer = shards.ShardWriter(f"file:{tmp_path}/s", 4, 0)
    writer.write(iter([_batch(range(8), 0)]))
    with pytest.raises(RuntimeError, match="missing or doubled"):
        writer.commit([shards.RunsWritten(runs)])
    writer.abort([])
    assert list(tmp_path.iterdir()) == []


def test_lost_or_short_shards_fail_the_reader(spark, tmp_path):
    flywheel.write_training_shards(_samples(spark, 20), f"file://{tmp_path}/s", 8)
    (tmp_path / "s" / "shard-00001.tar").unlink()
    with pytest.raises(Exception, match="shard-00001"):
        shards.read_training_shards(spark, f"{tmp_path}/s").collect()


def test_vectors_are_shuffled_once(spark):
    text = flywheel._runs(_samples(spark, 20), 8, 42)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("RepartitionByExpression") == 1
    assert "Aggregate" not in text.split("Join Inner")[0]
