"""A Merkle manifest of a dataset: a tree per source, and one over their roots.

1. Every row becomes a leaf, the SHA-256 of its fields with their byte counts.
   The leaves of a tree (one for each source) are numbered in their order: they
   are dealt by ranges, and the ranges' counts give the offsets.
2. Leaves are packed in aligned blocks of ``fanout ** HEIGHT``; a block is the
   unit that exchanges. Its own levels are hashed in one place.
3. Butterfly: in round r a block meets the blocks whose number differs from its
   own in digit r alone (to the base of the fanout), an aligned group of at most
   ``fanout``. Each puts in the root of the subtree it has covered so far, and
   each hashes the common parent for itself, so all blocks below a node hold its
   digest, and with the siblings swapped on the way every block has the upper
   part of its proofs once the last round ends; nothing is sent back down. In a
   last subtree that is not full, a block also stands in for those it lacks.
4. The trees' roots are leaves of the tree above and go the same way.

A tree of any size costs one row per block and round; a source with a third of
all rows is as many blocks as it has leaves.

Cases: a null field is ``-``, which no other value gives; a null source is a tree
of its own, before all others; leaves of equal doc_id are ordered by digest, and
repeated rows are leaves of their own, null doc_id before all numbers. A tree of
one leaf has that leaf as root. An empty table gives no row. Only the five fields
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, partitions, prepare, remote
from tidemark.session import materialize

#: Levels of a block's own: 16 ** 3 leaves with the usual fanout.
HEIGHT = 3
#: Blocks of one tree that meet one copy of the tree's upper path.
SLICE = 1024
#: Rows of one Arrow batch of proofs, each some KB.
ROWS = 512

FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
_PATH = "array<struct<left: string, right: string>>"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    written = [F.col("`" + f + "`") if isinstance(f, str) else f for f in fields]
    written = [f.cast("string") for f in written]
    parts = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in written]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof lead to."""
    return F.aggregate(
        proof, leaf, lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]), 256)
    )


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, lowest level first, from left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _parents(nodes: list[str], fanout: int) -> list[str]:
    runs = ("".join(nodes[i : i + fanout]) for i in range(0, len(nodes), fanout))
    return [sha256(run.encode()).hexdigest() for run in runs]


def _levels(leaves: list[str], fanout: int, alone: bool) -> list[list[str]]:
    """A block's levels from leaves to root; the only block of a tree ends at one node."""
    levels = [leaves]
    while len(levels[-1]) > 1 if alone else len(levels) <= HEIGHT:
        levels.append(_parents(levels[-1], fanout))
    return levels


def _roots(batches, fanout: int):
    for batch in batches:
        alone = [n == 1 for n in batch.column("blocks").to_pylist()]
        held = [
            _levels(leaves, fanout, single)[-1][0]
            for leaves, single in zip(batch.column("leaf").to_pylist(), alone, strict=True)
        ]
        names = ["tree", "block", "blocks"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(held, pa.string())], [*names, "held"])


def _proofs(batches, fanout: int):
    """A row per leaf: its own columns, digest and the siblings up to the tree's root."""
    for batch in batches:
        members = batch.column("members")
        for row in range(len(batch)):
            own = members[row].values
            leaves = own.field("leaf").to_pylist()
            levels = _levels(leaves, fanout, batch.column("blocks")[row].as_py() == 1)
            texts = ["".join(level) for level in levels[:-1]]
            above = batch.column("path")[row].as_py() or []
            upper = batch.column("above")[row].as_py() or []
            above = [(step["left"], step["right"]) for step in above + upper]
            ends = {name: batch.column(name)[row] for name in ("subroot", "root")}
            for begin in range(0, len(leaves), ROWS):
                stop = min(begin + ROWS, len(leaves))
                left, right = [], []
                for i in range(begin, stop):
                    place = i
                    for text in texts:
                        group, digit = divmod(place, fanout)
                        run = text[64 * fanout * group : 64 * fanout * (group + 1)]
                        left.append(run[: 64 * digit])
                        right.append(run[64 * digit + 64 :])
                        place = group
                    for step in above:
                        left.append(step[0])
                        right.append(step[1])
                size = len(texts) + len(above)
                offsets = pa.array(range(0, size * (stop - begin) + 1, size) if size else [0] * (stop - begin + 1), pa.int32())
                steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"])
                part = own.slice(begin, stop - begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.field("row"),
                        part.field("leaf"),
                        *(pa.repeat(ends[name], stop - begin) for name in ("subroot", "root")),
                        pa.ListArray.from_arrays(offsets, steps),
                    ],
                    ["row", "leaf", "subroot", "root", "proof"],
                )


def _packed(rows: DataFrame, order: Sequence[str], fanout: int) -> DataFrame:
    """Leaves (tree, order, leaf, row) as blocks: tree, block, blocks of the tree, members."""
    spark = rows.sparkSession
    # Rows alike in all of their order are told apart by a stored number, so no range is theirs alone.
    marked = materialize(rows.withColumn("_mark", F.monotonically_increasing_id()), "leaves")
    keys = ["tree", *order, "leaf", "_mark"]
    # Within a partition the ids run on by one, and partitions ascend in the order.
    laid = materialize(
        marked.repartitionByRange(partitions(spark), *keys)
        .sortWithinPartitions(*keys)
        .select("tree", "leaf", "row", F.monotonically_increasing_id().alias("_seq")),
        "ordered",
    ).withColumn("_part", F.shiftright("_seq", 33))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    size = fanout**HEIGHT
    runs = (
        laid.groupBy("tree", "_part")
        .agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select(
            "tree", "_part", "_first",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(whole).alias("_all"),
        )
    )
    place = F.col("_before") + F.col("_seq") - F.col("_first")
    return materialize(
        laid.join(runs, ["tree", "_part"])
        .withColumn("_place", place)
        .withColumn("block", F.expr(f"_place div {size}"))
        .groupBy("tree", "block")
        .agg(
            F.max(F.expr(f"(_all - 1) div {size} + 1")).alias("blocks"),
            F.array_sort(F.collect_list(F.struct("_place", "leaf", "row"))).alias("members"),
        ),
        "blocks",
    )


def _exchange(blocks: DataFrame, fanout: int) -> DataFrame:
    """tree, block, blocks, held (the tree's root) and path (siblings above the block)."""
    rounds, span = [], 1
    now = blocks.select("tree", "block", "blocks", F.col("members.leaf").alias("leaf")).mapInArrow(
        remote(_roots, fanout), "tree string, block long, blocks long, held string"
    )
    now = materialize(now.withColumn("path", F.array().cast(_PATH)), "exchange")
    most = now.agg(F.max("blocks")).first()[0] or 0
    while span < most:
        rounds.append(now.where(F.col("blocks") <= span))
        now = materialize(_round(now.where(F.col("blocks") > span), span, fanout), "exchange")
        span *= fanout
    rounds.append(now)
    done = rounds[0]
    for more in rounds[1:]:
        done = done.union(more)
    return done


def _round(now: DataFrame, span: int, fanout: int) -> DataFrame:
    """Blocks that differ in one digit alone swap the roots of their subtrees of ``span`` blocks."""
    subtree = F.expr(f"block div {span}")
    last = F.expr(f"(blocks - 1) div {span}")
    spot = F.col("block") % span
    # In a last subtree of fewer blocks each also speaks for those that are not there.
    present = F.col("blocks") - last * span
    short = (subtree == last) & (last % fanout != 0) & (present < span)
    spots = F.when(short, F.sequence(spot, F.lit(span - 1).cast("long"), present)).otherwise(F.array(spot))
    sent = now.select(
        "tree", "block", "blocks", "held", "path", spot.alias("_own"),
        F.expr(f"block div {span * fanout}").alias("_parent"),
        (subtree % fanout).cast("int").alias("_digit"),
        F.explode(spots).alias("_spot"),
    )
    real = F.col("_own") == F.col("_spot")
    member = F.struct("_digit", "held", "block", "blocks", real.alias("real"), F.when(real, F.col("path")).alias("path"))
    met = sent.groupBy("tree", "_parent", "_spot").agg(F.array_sort(F.collect_list(member)).alias("group"))
    met = met.withColumn("digests", F.col("group.held"))
    met = met.select(
        "tree", "digests", F.sha2(F.array_join("digests", ""), 256).alias("held"),
        F.explode(F.filter("group", lambda x: x["real"])).alias("x"),
    )
    digit = F.col("x._digit")
    step = F.struct(
        F.array_join(F.slice("digests", F.lit(1), digit), "").alias("left"),
        F.array_join(F.slice("digests", digit + 2, F.lit(fanout)), "").alias("right"),
    )
    return met.select(
        "tree", "x.block", "x.blocks", "held", F.concat("x.path", F.array(step)).cast(_PATH).alias("path")
    )


def _prove(blocks: DataFrame, tops: DataFrame, fanout: int) -> DataFrame:
    """Rows with their proofs; ``tops`` has tree, block, path, subroot, root and above."""
    row = blocks.schema["members"].dataType.elementType["row"].dataType.simpleString()
    return blocks.join(tops.drop("blocks"), ["tree", "block"]).mapInArrow(
        remote(_proofs, fanout),
        f"row {row}, leaf string, subroot string, root string, proof {_PATH}",
    )


def manifest(rows: DataFrame, fanout: int = 16) -> DataFrame:
    """row, leaf, subroot, root and proof for leaves in trees.

    ``rows`` has ``tree`` (a string that orders the trees by its UTF-8 bytes),
    ``rank`` (the order within a tree, null first), ``leaf`` (a digest) and
    ``row``, a struct that goes through. ``proof`` lists the digests left and
    right of the path for every level, through subroot up to root.
    """
    prepare(rows.sparkSession)
    blocks = _packed(rows, ["rank"], fanout)
    lower = materialize(_exchange(blocks, fanout), "lower")
    trees = lower.where("block = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("rank"), F.col("held").alias("leaf"),
        F.struct(F.col("tree").alias("name"), "blocks").alias("row"),
    )
    upper_blocks = _packed(trees, ["rank"], fanout)
    upper = _exchange(upper_blocks, fanout).select(
        "tree", "block", "path", F.col("held").alias("subroot"), F.col("held").alias("root"),
        F.array().cast(_PATH).alias("above"),
    )
    # A copy of the tree's upper path for every so many of its blocks: no tree is one hot key.
    slices = F.sequence(F.lit(0).cast("long"), F.expr(f"(row.blocks - 1) div {SLICE}"))
    tops = _prove(upper_blocks, upper, fanout).select(
        F.col("row.name").alias("tree"), F.explode(slices).alias("_slice"),
        F.col("leaf").alias("subroot"), "root", F.col("proof").alias("above"),
    )
    lower = lower.withColumn("_slice", F.expr(f"block div {SLICE}"))
    return _prove(blocks, lower.join(tops, ["tree", "_slice"]).drop("_slice", "held"), fanout)


def _lowered(name: str) -> Column:
    return F.translate(name, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaves of documents, a tree for each source.

    ``row`` holds doc_id and, where ``tampered`` is true, ``forged``: the digest
    of the row with the capitals A-Z of its text lower-cased.
    """
    own = own_columns(docs, **FIELDS)
    forged = F.lit(None).cast("string")
    if tampered is not None:
        forged = F.when(tampered, leaf_digest([*list(FIELDS)[:-1], _lowered("text")]))
    return own.select(
        # Null sorts before every source, as no tree of a given one is named by nothing.
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"),
        F.col("doc_id").alias("rank"),
        leaf_digest(list(FIELDS)).alias("leaf"),
        F.struct("doc_id", forged.alias("forged")).alias("row"),
    )


def verify_documents(docs: DataFrame, every: int = 5, fanout: int = 16) -> DataFrame:
    """The manifest of documents, checked on rows of which every fifth or so is tampered with.

    Where ``every`` divides the crc32 of the decimal doc_id, the text is
    lower-cased before the leaf is made anew; its original siblings then lead to
    ``folded_root``, which is ``root`` only where the text had no capitals.
    """
    lot = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    found = manifest(document_leaves(docs, lot), fanout)
    return found.select(
        "row.doc_id", "leaf", "subroot", "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        fold(F.coalesce("row.forged", "leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
