"""Token ids of documents in binary files with Elias-Fano document boundaries.

A shard holds the ids of consecutive documents, one after the other, and three
rising sequences in Elias-Fano code: where each document stops, and the sorted
document ids (those below zero apart). So a document's place is found by select,
with no table of 64-bit offsets.

Layout, little-endian: ``TMTOK1\\0\\0``, byte width of an id (u32), counts of
documents without an id, with a negative one, and of all (3 x u64), ids (u64),
then stops, negative ids (as distance from the most negative), other ids (as
distance from the least), their two bases (2 x i64 before them), and the ids.

Cases: a null text is empty and has only the end id; documents without a doc_id
come first; documents with equal doc_id stand in the order of their text; an
empty table gives no shard. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import elias_fano
from tidemark.llm.common import own_columns, partitions, prepare, remote, texts
from tidemark.llm.files import locate, remove_unfinished, shared_folder, whole_file
from tidemark.llm.tokens import encoded, encoder
from tidemark.session import materialize

MAGIC = b"TMTOK1\0\0"
_HEAD = struct.Struct("<8sIQQQQqq")

#: A task closes a shard at so many bytes of ids, or so many documents.
SHARD_BYTES = 32 << 20
SHARD_DOCS = 1 << 18

#: Rows given out at a time when shards are read.
READ_ROWS = 1 << 13

MANIFEST = "path string, shard long, docs long, ids long"


def shard_bytes(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
    """A shard's parts in order. ``doc_ids`` rise, nulls first; ``ends`` are the stops."""
    missing = sum(value is None for value in doc_ids)
    known = np.array(doc_ids[missing:], np.int64)
    below = int(np.searchsorted(known, 0))
    bases = (int(known[0]) if below else 0, int(known[below]) if below < len(known) else 0)
    yield _HEAD.pack(MAGIC, ids.dtype.itemsize, missing, below, len(doc_ids), len(ids), *bases)
    yield elias_fano.encode(ends)
    for part, base in ((known[:below], bases[0]), (known[below:], bases[1])):
        yield elias_fano.encode(part.view(np.uint64) - np.uint64(base & (1 << 64) - 1))
    yield ids.tobytes()


class Shard:
    """A shard read from its bytes: documents by position."""

    def __init__(self, data: bytes) -> None:
        view = memoryview(data)
        magic, width, self.missing, below, self.docs, count, *bases = _HEAD.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size
        self.stops = elias_fano.EliasFano(view[at:])
        at += self.stops.size
        self.known = []  # with their bases; left in code until asked for
        for base in bases:
            part = elias_fano.EliasFano(view[at:])
            at += part.size
            self.known.append((base, part))
        counts = [len(part) for _, part in self.known]
        if counts != [below, self.docs - self.missing - below] or len(self.stops) != self.docs:
            raise ValueError("the shard's counts disagree")
        self.ids = np.frombuffer(view, f"<u{width}", count, at)

    def _doc_ids(self) -> Iterator[int | None]:
        yield from repeat(None, self.missing)
        for base, part in self.known:
            for value in part:
                yield base + value

    def doc_ids(self) -> list[int | None]:
        return list(self._doc_ids())

    def document(self, i: int) -> np.ndarray:
        """Ids of the document at position ``i``, by select."""
        begin = self.stops.select(i - 1) if i else 0
        return self.ids[begin : self.stops.select(i)]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Each document's id, place of its first id, and ids."""
        begin = 0
        for doc_id, stop in zip(self._doc_ids(), self.stops, strict=True):
            yield doc_id, begin, self.ids[begin:stop]
            begin = stop


def _write(batches, vocabulary: str, folder: str, end: int, plain_specials: bool):
    task = TaskContext.get().partitionId()
    held: list[np.ndarray] = []
    doc_ids: list[int | None] = []
    size = written = 0

    def close() -> pa.RecordBatch:
        path = f"{folder}/shard-{task:06d}-{written:06d}.tok"
        ends = np.cumsum([len(part) for part in held])
        with whole_file(path) as stream:
            for part in shard_bytes(doc_ids, ends, np.concatenate(held)):
                stream.write(part)
        return pa.RecordBatch.from_pydict(
            {"path": [path], "shard": [task << 32 | written], "docs": [len(held)], "ids": [int(ends[-1])]}
        )

    for batch in batches:
        numbers = batch.column("doc_id").to_pylist()
        found = encoded(vocabulary, texts(batch.column("text")), end, plain_specials)
        for doc_id, ids in zip(numbers, found, strict=True):
            held.append(ids)
            doc_ids.append(doc_id)
            size += ids.nbytes
            if size >= SHARD_BYTES or len(held) >= SHARD_DOCS:
                yield close()
                held, doc_ids, size, written = [], [], 0, written + 1
    if held:
        yield close()


def _read(batches):
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            store, place = locate(path)
            with store.open_input_file(place) as stream:
                shard = Shard(stream.read())
            found = shard.documents()
            while rows := [
                (doc_id, start + begin, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                for doc_id, begin, ids in islice(found, READ_ROWS)
            ]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )


def write_store(
    docs: DataFrame, vocabulary: str, folder: str, end: int = 0, plain_specials: bool = False
) -> DataFrame:
    """Write the documents' ids as shards into ``folder``, in order of doc_id.

    Returns the manifest: path, shard (rising with doc_id), documents and ids of
    each, and ``start``, the number of ids in all shards before. Texts are dealt
    to tasks by ranges of doc_id, in one shuffle; a task holds one shard's ids.
    """
    spark = docs.sparkSession
    prepare(spark)

    ordered = (
        own_columns(docs, doc_id="long", text="string")
        .repartitionByRange(partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    written = ordered.mapInArrow(remote(_write, vocabulary, folder, end, plain_specials), MANIFEST)
    manifest = materialize(written, "token-manifest")
    remove_unfinished(spark, folder)
    # One row a shard, so a single ordered window is small.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_store(manifest: DataFrame) -> DataFrame:
    """Documents from the shards: doc_id, start, n_tokens, ids_crc32, one task a shard or more."""
    spark = manifest.sparkSession
    prepare(spark)

    return (
        manifest.select("path", "start")
        .repartition(partitions(spark), "path")
        .mapInArrow(remote(_read), "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def encode_documents(
    spark: SparkSession, docs: DataFrame, vocabulary: str, plain_specials: bool = False
) -> DataFrame:
    """Write all documents to a new store in the shared folder and read it back."""
    encoder(vocabulary, plain_specials)  # fail here if the file is not a tokenizer
    folder = shared_folder(spark, "token-store")
    return read_store(write_store(docs, vocabulary, folder, plain_specials=plain_specials))
