"""Near-duplicate documents by SimHash and BK-trees.

1. A document's fingerprint has a bit where more than half of the 64-bit hashes
   of its word shingles have it, repeats included. Equal fingerprints become one.
2. The 64 bits are cut in ``radius + 2`` fields. Fingerprints that differ in at
   most ``radius`` bits agree in two fields at least, so every pair of fields
   deals the fingerprints to shards by their bits there, and no link is lost.
3. A shard's members form a BK-tree: a child hangs on its parent by their integer
   distance, and a search follows only the edges within the radius of its own
   distance to the parent. A shard with more than :data:`SHARD` members is cut in
   slices with a tree each; a slice's tree is sent to every slice that has to be
   looked up in it. (All trees together grow with the data, so what is sent is
   always one of these, not a Spark broadcast of the whole.)
4. Of the links found together only a spanning forest is kept, so a large group
   of near copies gives about one link a member; components follow by
   alternating large-star and small-star.

Cases: texts that are null or without words have fingerprint zero and are linked
like any other; a text of fewer words than a shingle has its whole sequence as
one; repeated rows are rows of their own; rows without doc_id are linked but
never name a component, and one of such rows alone has a null component_id; an
empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.bk_tree import Forest, Labels
from tidemark.llm.common import join_split, own_columns, partitions, prepare, remote, runs
from tidemark.llm.graph import components
from tidemark.session import materialize

#: Members of one BK-tree, and members of small shards looked at together.
SHARD = 8192
#: Bytes of a text cut in words at a time.
BLOCK = 1 << 20

_TABLE = bytes(
    0x20 if byte in (0x20, *range(0x09, 0x0E)) else byte + 32 if 0x41 <= byte <= 0x5A else byte
    for byte in range(256)
)
#: Every 16th bit; the sums of 65,535 such numbers do not run into each other.
_LANES = np.uint64(0x0001_0001_0001_0001)
_MOST = 65_535


def _shingle_hashes(text: str | None, size: int, seed: int) -> list[np.ndarray]:
    """64-bit hashes of a text's shingles, in pieces of bounded size."""
    data, out, carried, at = (text or "").encode().translate(_TABLE), [], [], 0
    while at < len(data):
        cut = data.find(b" ", at + BLOCK) if len(data) - at > BLOCK else -1
        cut = len(data) if cut < 0 else cut
        words = carried + data[at:cut].split()
        carried, at = words[-(size - 1) :] if size > 1 else [], cut
        if len(words) >= size:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate([[0], ends[:-1]])
            spans = zip(starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)
            out.append(np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - size + 1))
    if not out and carried:
        out.append(np.array([xxh64_intdigest(b" ".join(carried), seed)], np.uint64))
    return out


def fingerprint(pieces: list[list[np.ndarray]]) -> np.ndarray:
    """For each text's hashes the bits that more than half of them have; zero without any."""
    parts, owner = [], []
    for i, own in enumerate(pieces):
        for hashes in own:
            for begin in range(0, len(hashes), _MOST):
                parts.append(hashes[begin : begin + _MOST])
                owner.append(i)
    counts = np.zeros((len(pieces), 64), np.int64)
    if not parts:
        return np.zeros(len(pieces), np.uint64)
    lengths = np.array([len(part) for part in parts])
    starts, flat = np.cumsum(lengths) - lengths, np.concatenate(parts)
    for bit in range(16):
        sums = np.add.reduceat((flat >> np.uint64(bit)) & _LANES, starts)
        for lane in range(4):
            own = (sums >> np.uint64(16 * lane)) & np.uint64(0xFFFF)
            np.add.at(counts[:, bit + 16 * lane], owner, own.astype(np.int64))
    total = np.bincount(owner, lengths, len(pieces)).astype(np.int64)
    bits = 2 * counts > total[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def _prints(batches, size: int, seed: int):
    for batch in batches:
        values, pieces, held = [], [], 0
        for text in batch.column("text").to_pylist():
            pieces.append(_shingle_hashes(text, size, seed))
            held += sum(map(len, pieces[-1]))
            if held > 1 << 18:
                values.append(fingerprint(pieces))
                pieces, held = [], 0
        values.append(fingerprint(pieces))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.concatenate(values).view(np.int64))], ["doc_id", "print"]
        )


def prints(docs: DataFrame, size: int = 4, seed: int = 42) -> DataFrame:
    """doc_id and print, the fingerprint as a signed long, of every document; no shuffle."""
    prepare(docs.sparkSession)
    own = own_columns(docs, doc_id="long", text="string")
    return own.mapInArrow(remote(_prints, size, seed), "doc_id long, print long")


def shard_keys(radius: int) -> list[Column]:
    """A number for each two of radius + 2 fields of the bits, different for different fields."""
    cuts = np.linspace(0, 64, radius + 3).round().astype(int).tolist()
    masks = [sum(1 << bit for bit in range(a, b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    signed = [int(np.uint64(x | y).astype(np.int64)) for x, y in combinations(masks, 2)]
    return [F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(mask).cast("long"))) for i, mask in enumerate(signed)]


def _links(batches, radius: int):
    """Links of rows sorted by (shard, tree, slice, looked_up): spanning forests of what is near."""
    held, rows, number = [], 0, 0

    def found():
        values = np.concatenate([part for part, *_ in held])
        groups = np.concatenate([np.full(len(part), n) for part, _, n, _ in held])
        tree = np.concatenate([np.full(len(part), not up) for part, up, *_ in held])
        query = np.concatenate([np.full(len(part), up or alone) for part, up, _, alone in held])
        names, label = np.unique(values, return_inverse=True)
        label, known = label.ravel(), Labels(len(names))
        forest = Forest(values[tree], groups[tree])
        own, asked = label[tree], label[query]
        for a, b in forest.near(values[query], groups[query], radius):
            for high, low in known.merge(asked[a], own[b]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[high].view(np.int64)), pa.array(names[low].view(np.int64))], ["a", "b"]
                )

    for (_, tree, part, up), group in runs(batches, ["shard", "tree", "slice", "looked_up"]):
        values = np.concatenate([batch.column("print").to_numpy() for batch in group]).view(np.uint64)
        if not up:
            # The rows looked up in a tree follow its own members.
            if rows >= SHARD:
                yield from found()
                held, rows = [], 0
            number += 1
        held.append((values, bool(up), number, tree == part))
        rows += len(values)
    if held:
        yield from found()


def link(found: DataFrame, radius: int = 4) -> DataFrame:
    """Links a, b that connect all fingerprints (column print, distinct) within ``radius`` bits."""
    members = materialize(found.select(F.explode(F.array(*shard_keys(radius))).alias("shard"), "print"), "shards")
    many = members.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slices = F.expr(f"cast((n - 1) div {SHARD} + 1 as int)")
    own = F.pmod(F.xxhash64("print"), F.col("slices")).cast("int")
    met = (
        members.join(many, "shard")
        .withColumn("slices", slices)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    )
    placed = met.select(
        "shard", F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("slice"),
        (F.col("own") > F.col("other")).cast("int").alias("looked_up"), "print",
    )
    keys = ["shard", "tree", "slice"]
    return (
        placed.repartition(partitions(found.sparkSession), *keys)
        .sortWithinPartitions(*keys, "looked_up")
        .mapInArrow(remote(_links, radius), "a long, b long")
    )


def near_duplicates(docs: DataFrame, radius: int = 4, size: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per document.

    Documents are linked when their fingerprints differ in at most ``radius``
    bits; component_id is the least doc_id that links reach, itself included.
    """
    shown = materialize(prints(docs, size, seed), "prints")
    classes = materialize(shown.groupBy("print").agg(F.min("doc_id").alias("least")), "classes")
    found = components(link(classes.select("print"), radius)).toDF("print", "root")
    rooted = classes.join(found, "print", "left").withColumn("root", F.coalesce("root", "print"))
    rooted = materialize(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(join_split(rooted.select("print", "root"), named, "root"), "named")
    return join_split(shown, named.select("print", "component_id"), "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )
