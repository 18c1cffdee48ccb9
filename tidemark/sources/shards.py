"""Training shards as a Spark data source that publishes all of a job or nothing.

Tasks write whole tars into a folder of unfinished ones beside the target. Only
when every task has succeeded are they moved into place and the manifest
written; a job that fails takes its unfinished tars away again. Readers go by
the manifest, so they see the shards of a whole job or none.
"""

from __future__ import annotations

import io
import json
import tarfile
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.session import folder_store, shared_folder

FORMAT = "tidemark_shards"

# --- Fixed values: shard layout -----------------------------------------------
SHARD_NAME = "shard-{:05d}.tar"
SHARD_METADATA = ("robot_model_id", "failure_type_tag", "success_flag", "backbone")
# ------------------------------------------------------------------------------

#: Position, in the order of all samples, of the first one of a row's run.
FIRST = "first"
SAMPLE_COLUMNS = ("episode_id", "vla_feature_vector", *SHARD_METADATA)
_PARTS = "parts"


def manifest_path(folder: str) -> str:
    return f"{folder.rstrip('/')}.manifest.json"


def _tar(samples: Sequence[dict]) -> bytes:
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w") as tar:
        for sample in samples:
            vector = io.BytesIO()
            np.save(vector, np.asarray(sample["vla_feature_vector"], np.float32), allow_pickle=False)
            meta = {name: sample[name] for name in SHARD_METADATA}
            for suffix, payload in (
                ("npy", vector.getvalue()),
                ("json", json.dumps(meta).encode("utf-8")),
            ):
                member = tarfile.TarInfo(f"{sample['episode_id']}.{suffix}")
                member.size = len(payload)
                tar.addfile(member, io.BytesIO(payload))
    return buffer.getvalue()


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
    for batch in batches:
        vectors = batch.column("vla_feature_vector")
        plain = batch.select([FIRST, "episode_id", *SHARD_METADATA]).to_pylist()
        for row, vector in zip(plain, vectors):
            row["vla_feature_vector"] = vector.values if vector.is_valid else None
            yield row.pop(FIRST), row


@dataclass
class RunsWritten(WriterCommitMessage):
    """The runs of one task: position of the first sample, number of samples."""

    runs: list[tuple[int, int]]


class ShardWriter(DataSourceArrowWriter):
    """Rows sorted by run and order, a run whole in one task, as tars of ``samples`` each.

    A run begins at a multiple of ``samples`` and only the last one may end in the
    middle of a shard, so every shard is written by one task, which holds one
    shard at a time. A repeated task writes the same bytes under the same name.
    """

    def __init__(self, folder: str, samples: int, seed: int) -> None:
        self.folder, self.samples, self.seed = folder.rstrip("/"), samples, seed
        self.unfinished = f"{self.folder}.unfinished-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> RunsWritten:
        store, root = folder_store(self.unfinished)
        runs: list[tuple[int, int]] = []
        first, written, pending = None, 0, []

        def put() -> None:
            parts = f"{root}/{_PARTS}"
            store.create_dir(parts, recursive=True)
            part = f"{parts}/{uuid.uuid4().hex}"
            with store.open_output_stream(part) as out:
                out.write(_tar(pending))
            store.move(part, f"{root}/{SHARD_NAME.format((first + written) // self.samples)}")

        for begin, sample in _samples(iterator):
            if pending and (begin != first or len(pending) == self.samples):
                put()
                written, pending = written + len(pending), []
            if begin != first:
                if first is not None:
                    runs.append((first, written))
                first, written = begin, 0
            pending.append(sample)
        if pending:
            put()
            runs.append((first, written + len(pending)))
        return RunsWritten(runs)

    def commit(self, messages: list[RunsWritten | None]) -> None:
        """Move the shards into place, then publish the manifest.

        A new folder appears by one rename where the store can rename folders. An
        existing folder gets its shards one by one; its old manifest goes first.
        """
        total = 0
        for first, rows in sorted(run for message in messages if message for run in message.runs):
            if first != total or first % self.samples:
                raise RuntimeError(f"samples {total} to {first} are missing or doubled; nothing was published")
            total += rows
        shards = -(-total // self.samples)
        store, target = folder_store(self.folder)
        _, unfinished = folder_store(self.unfinished)
        _, manifest = folder_store(manifest_path(self.folder))
        _delete(store, manifest)
        if shards:
            _delete(store, f"{unfinished}/{_PARTS}")
            new = store.get_file_info(target).type == fs.FileType.NotFound
            if new and store.type_name in ("local", "hdfs"):
                store.move(unfinished, target)
            else:
                store.create_dir(target, recursive=True)
                for number in range(shards):
                    name = SHARD_NAME.format(number)
                    store.move(f"{unfinished}/{name}", f"{target}/{name}")
        _delete(store, unfinished)
        store.create_dir(target.rsplit("/", 1)[0], recursive=True)
        draft = f"{manifest}.{uuid.uuid4().hex}"
        content = {"shards": shards, "samples": total, "samples_per_shard": self.samples, "shuffle_seed": self.seed}
        with store.open_output_stream(draft) as out:
            out.write(json.dumps(content).encode("utf-8"))
        store.move(draft, manifest)

    def abort(self, messages: list[RunsWritten | None]) -> None:
        """Take the unfinished shards away; published ones stay as they are."""
        _delete(*folder_store(self.unfinished))


def _delete(store: fs.FileSystem, path: str) -> None:
    kind = store.get_file_info(path).type
    if kind == fs.FileType.Directory:
        store.delete_dir(path)
    elif kind != fs.FileType.NotFound:
        store.delete_file(path)


class ShardSink(DataSource):
    """``df.write.format("tidemark_shards")`` with options folder, samples, seed."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        given = self.options
        return ShardWriter(given["folder"], int(given["samples"]), int(given["seed"]))


def write_shards(runs: DataFrame, folder: str, samples: int, seed: int) -> None:
    """Write rows of (first, sample columns), in order and each run whole in one partition."""
    spark = runs.sparkSession
    spark.dataSource.register(ShardSink)
    options = {"folder": folder, "samples": str(samples), "seed": str(seed)}
    runs.select(FIRST, *SAMPLE_COLUMNS).write.format(FORMAT).options(**options).mode("append").save()


def _manifest(spark: SparkSession, folder: str) -> tuple[dict, str]:
    store, root = folder_store(shared_folder(spark, folder).rstrip("/"))
    path = manifest_path(root)
    if store.get_file_info(path).type == fs.FileType.NotFound:
        raise FileNotFoundError(f"no shards have been published at {folder}")
    with store.open_input_stream(path) as given:
        return json.loads(given.read()), root


def list_training_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The published shards as (shard, path, samples); unpublished folders raise."""
    content, root = _manifest(spark, folder)
    each = content["samples_per_shard"]
    name = F.concat(F.lit(f"{root}/"), F.format_string("shard-%05d.tar", "id"))
    samples = F.least(F.lit(each).cast("bigint"), F.lit(content["samples"]).cast("bigint") - F.col("id") * each)
    return spark.range(content["shards"]).select(F.col("id").alias("shard"), name.alias("path"), samples.alias("samples"))


def read_training_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Samples of the published shards, with shard and place in it.

    A tar that is gone, cut off or holds another number of samples than the
    manifest states fails the query.
    """
    place = shared_folder(spark, folder).rstrip("/")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = folder_store(place)
        for frame in frames:
            for shard, path, samples in zip(frame["shard"], frame["path"], frame["samples"]):
                rows = []
                with store.open_input_file(path) as given, tarfile.open(fileobj=given) as tar:
                    for member in tar:
                        key, kind = member.name.rsplit(".", 1)
                        payload = tar.extractfile(member).read()
                        if kind == "npy":
                            vector = np.load(io.BytesIO(payload), allow_pickle=False)
                            rows.append({"shard": shard, "place": len(rows), "episode_id": key,
                                         "vla_feature_vector": vector if vector.ndim else None})
                        else:
                            rows[-1] |= json.loads(payload)
                if len(rows) != samples:
                    raise ValueError(f"{path} holds {len(rows)} samples, not {samples}")
                yield pd.DataFrame(rows)

    schema = ("shard bigint, place int, episode_id string, vla_feature_vector array<float>, "
              "robot_model_id string, failure_type_tag string, success_flag boolean, backbone string")
    shards = list_training_shards(spark, folder)
    return shards.mapInPandas(read, schema)
