"""Documents packed into sequences of bounded length by first-fit decreasing.

Documents are dealt at random, by a hash of their place, to groups of about
:data:`GROUP_DOCS`. In a group each document is cut into full sequences and a
rest; the rests are placed longest first, each in the first sequence with room.
A tournament tree over the sequences' free room finds that one in log n steps.
Only lengths are shuffled; ids stay where they were made.

Cases: a null text is empty and has only the end id; repeated rows are documents
of their own; equal lengths go by (doc_id, place); an empty table gives no row.
Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, partitions, prepare, ragged, remote, remote_group, texts
from tidemark.llm.tokens import encoded

SEQUENCE = 2048
GROUP_DOCS = 8192
END = 1

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each item (at most ``capacity`` long).

    ``room`` is a complete binary tree over the bins: a leaf has a bin's free
    room, a node the larger of its children's. Going left where the left child
    has room finds the first bin that fits.
    """
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        length, node = int(lengths[item]), 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - room[node]
        room[node] -= length
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def place(tokens: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Pieces of documents with so many tokens: document, start, length, sequence, offset.

    Sequences are numbered from 0: those of the rests first, then the full ones.
    """
    full, rest = tokens // capacity, tokens % capacity
    part = np.flatnonzero(rest)
    bins, offsets = first_fit_decreasing(rest[part], capacity)
    used = int(bins.max()) + 1 if len(bins) else 0
    document = np.repeat(np.arange(len(tokens)), full)
    begin = np.cumsum(full) - full
    return {
        "document": np.concatenate([document, part]),
        "start": np.concatenate([(np.arange(len(document)) - begin[document]) * capacity, full[part] * capacity]),
        "length": np.concatenate([np.full(len(document), capacity), rest[part]]),
        "sequence": np.concatenate([used + np.arange(len(document)), bins]),
        "offset": np.concatenate([np.zeros(len(document), np.int64), offsets]),
    }


def _cut(batches, vocabulary: str, capacity: int, end: int, plain_specials: bool):
    for batch in batches:
        tokens, sums, counts = [], [], []
        for ids in encoded(vocabulary, texts(batch.column("text")), end, plain_specials):
            tokens.append(len(ids))
            wide = ids.astype("<u4")
            own = [zlib.crc32(wide[i : i + capacity]) for i in range(0, len(wide), capacity)]
            sums += own
            counts.append(len(own))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("slot"),
                pa.array(tokens, pa.int64()),
                ragged(np.array(sums, np.int64), np.concatenate([[0], np.cumsum(counts)]), pa.int64()),
            ],
            ["doc_id", "slot", "doc_tokens", "sums"],
        )


def cut_documents(
    docs: DataFrame, vocabulary: str, capacity: int = SEQUENCE, end: int = END, plain_specials: bool = False
) -> DataFrame:
    """doc_id, slot (place of the row), doc_tokens, and the checksum of each cut piece."""
    prepare(docs.sparkSession)
    return (
        own_columns(docs, doc_id="long", text="string")
        .withColumn("slot", F.monotonically_increasing_id())
        .mapInArrow(
            remote(_cut, vocabulary, capacity, end, plain_specials),
            "doc_id long, slot long, doc_tokens long, sums array<long>",
        )
    )


def _fill(key, table: pa.Table, capacity: int) -> pa.Table:
    table = table.sort_by([("doc_id", "ascending"), ("slot", "ascending")])
    tokens = table.column("doc_tokens").to_numpy()
    got = place(tokens, capacity)
    sums = table.column("sums").combine_chunks()
    first = sums.offsets.to_numpy()[:-1]
    flat = sums.values.to_numpy()
    document = got["document"]
    return pa.table(
        {
            "doc_id": table.column("doc_id").take(pa.array(document)),
            "start": got["start"],
            "length": got["length"],
            "ids_crc32": flat[first[document] + got["start"] // capacity],
            "doc_tokens": tokens[document],
            "sequence_id": (key[0].as_py() << 32) + got["sequence"],
            "offset": got["offset"],
        }
    )


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = SEQUENCE, group_docs: int = GROUP_DOCS,
    plain_specials: bool = False,
) -> DataFrame:
    """One row per piece: where it lies in its document, and in which sequence.

    ``sequence_id`` is the group's number times 2**32 plus the sequence's in it.
    """
    spark = docs.sparkSession
    groups = max(1, -(-docs.count() // group_docs))

    return (
        cut_documents(docs, vocabulary, capacity, plain_specials=plain_specials)
        .withColumn("lot", F.pmod(F.xxhash64("slot"), F.lit(groups)))
        .repartition(partitions(spark), "lot")
        .groupBy("lot")
        .applyInArrow(remote_group(_fill, capacity), PIECES)
    )


def assemble(pieces: DataFrame, ids: DataFrame) -> DataFrame:
    """Sequences of token ids from pieces and ``ids`` (doc_id, ids array): sequence_id, ids.

    For callers who want the sequences themselves; doc_id must be unique. A
    sequence is at most its capacity long, so collecting its pieces is bounded.
    """
    own = pieces.join(ids.select("doc_id", "ids"), "doc_id").select(
        "sequence_id",
        F.struct("offset", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids")).alias("piece"),
    )
    return own.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list("piece")), lambda piece: piece["ids"])).alias("ids")
    )
