"""Hard negatives of anchors, found in a multiway hyperplane tree.

1. Vectors become integers, so scores (inner products) are exact.
2. A tree of split points (see gnat) is fitted on a bounded sample, at most
   :data:`SAMPLE` vectors. Every vector then falls in a leaf, and the ranges of
   distances are taken over all vectors, not the sample.
3. An anchor goes to the leaves that its window of scores leaves, and to every
   part of them: a leaf with many vectors, copies of one among them, is dealt in
   parts by row. Each part has a tree of its own over its vectors, in whose
   leaves scores are compared; the parts' best make the result.
4. The first search finds an anchor's positives, best of its own label. The
   second looks for other labels in the window that each positive sets.

The sample also gives every search a score to begin with: as many of its members
as are wanted are at least that good. Nothing is left out, so recall is 1.

Cases: rows with a null label, a null vector, or a null or non-finite component
take no part, nor do rows without vec_id; shorter vectors end in zeros; repeated
rows are rows of their own, but a row with the anchor's vec_id is the anchor, and
of rows that share an anchor's vec_id the one of the least label, then vector, is
it; an anchor without positives or without negatives in the window gives no row,
and so does an empty table. Components beyond 32 bits, or vectors whose squared
length is beyond 2**53, fail. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import gnat
from tidemark.llm.common import own_columns, partitions, prepare, remote, runs
from tidemark.session import materialize

#: Vectors that the split points of the whole come from, and bytes of them.
SAMPLE = 4096
SAMPLE_BYTES = 8 << 20
#: Members of the sample in a leaf.
SPREAD = 64
#: Vectors of one part of a leaf, queries of one block, and bytes of either.
PART = 32_768
BLOCK = 8192
HELD_BYTES = 64 << 20

_NONE = -(2**60)
_ROW = "leaf int, part int, block int, asks int, key long, kind long, code array<int>, place int, low double, high double"
_FOUND = "key long, place int, other long, score long"


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and code (floor of scale times each component) of the rows that take part."""
    own = own_columns(vectors, vec_id="long", label="long", embedding="array<double>")
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return own.where("vec_id is not null and label is not null and embedding is not null").where(usable).select(
        "vec_id", "label", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x).cast("int")).alias("code")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Integer lists as rows of numbers, shorter ones filled up with zeros."""
    flat = column.flatten().to_numpy().astype(np.float64)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(column)), lengths), np.concatenate([np.arange(n) for n in lengths] or [[]]).astype(int)] = flat
    return out


class Index:
    """The whole's tree, the parts of its leaves, and the sample; bounded by the sample's size."""

    def __init__(self, tree: gnat.Tree, width: int, sample: tuple) -> None:
        self.tree, self.width, self.top = tree, width, tree.top
        self.rows, self.keys, self.kinds = sample
        self.parts = np.zeros(tree.leaves, np.int64)

    def vectors(self, column: pa.Array) -> gnat.Vectors:
        return gnat.Vectors(_matrix(column, self.width), self.top)


def _ranges(batches, index: Index):
    """What the rows of a task add to the nodes' ranges (node, i, j) and to the leaves' sizes (-1, leaf)."""
    count = np.zeros(index.tree.leaves, np.int64)
    for batch in batches:
        leaf = index.tree.place(index.vectors(batch.column("code")), learn=True)
        count += np.bincount(leaf, minlength=len(count))
    out = []
    for n, node in enumerate(index.tree.nodes()):
        for i, j in np.argwhere(node.most >= 0).tolist():
            out.append((n, i, j, node.least[i, j], node.most[i, j], 0))
    out += [(-1, leaf, 0, 0.0, 0.0, n) for leaf, n in enumerate(count.tolist()) if n]
    names = ["node", "i", "j", "least", "most", "n"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]
    columns = [pa.array([row[c] for row in out], kind) for c, kind in enumerate(kinds)]
    yield pa.RecordBatch.from_arrays(columns, names)


def build(vectors: DataFrame) -> Index | None:
    """The index of written vectors (vec_id, label, code); None if there are none."""
    square = F.aggregate("code", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n, width, top = vectors.agg(F.count(F.lit(1)), F.max(F.size("code")), F.max(square)).first()
    if not n:
        return None
    if top >= 2**53:
        raise ValueError("the vectors are too long for exact scores")
    size = max(64, min(SAMPLE, SAMPLE_BYTES // (8 * max(width, 1))))
    lot = F.xxhash64(F.lit("sample"), "vec_id")
    share = min(1.0, 2 * size / n)
    rows = (
        vectors.where(F.pmod(lot, F.lit(1 << 40)) < int(share * (1 << 40)))
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "code")).alias("row"))
        .orderBy(lot)
        .limit(size)
        .collect()
    )
    if not rows:  # a few ids hold nearly all rows
        rows = vectors.select("vec_id", F.struct("label", "code").alias("row")).limit(1).collect()
    matrix = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        matrix[i, : len(row.row.code)] = row.row.code
    sample = gnat.Vectors(matrix, top)
    keys, kinds = (np.array(x, np.int64) for x in zip(*((r.vec_id, r.row.label) for r in rows), strict=True))
    index = Index(gnat.Tree(sample, SPREAD), width, (sample, keys, kinds))
    # At most nodes x fanout x fanout rows, whatever the number of vectors.
    learnt = (
        vectors.select("code")
        .mapInArrow(remote(_ranges, index), "node int, i int, j int, least double, most double, n long")
        .groupBy("node", "i", "j")
        .agg(F.min("least"), F.max("most"), F.sum("n"))
        .collect()
    )
    nodes = index.tree.nodes()
    part = max(1024, min(PART, HELD_BYTES // (8 * max(width, 1))))
    for number, i, j, least, most, count in learnt:
        if number < 0:
            index.parts[i] = -(-count // part)
        else:
            nodes[number].least[i, j], nodes[number].most[i, j] = least, most
    return index


def _dealt(batches, index: Index):
    """Vectors with leaf and part."""
    for batch in batches:
        leaf = index.tree.place(index.vectors(batch.column("code")))
        part = batch.column("mark").to_numpy() % np.maximum(index.parts[leaf], 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(leaf), pa.array(part.astype(np.int32)), *(batch.column(n) for n in ("vec_id", "label", "code"))],
            ["leaf", "part", "vec_id", "label", "code"],
        )


def _aimed(batches, index: Index, same: bool, k: int):
    """Queries with every leaf that can hold a result, the window narrowed by the sample."""
    for batch in batches:
        keys, kinds, place = (batch.column(n).to_numpy() for n in ("key", "kind", "place"))
        low, high = (batch.column(n).to_numpy().copy() for n in ("low", "high"))
        queries = index.vectors(batch.column("code"))
        score = queries.rows @ index.rows.rows.T
        fits = (score >= low[:, None]) & (score <= high[:, None])
        fits &= ((kinds[:, None] == index.kinds) == same) & (keys[:, None] != index.keys)
        if score.shape[1] >= k:
            known = np.partition(np.where(fits, score, -np.inf), -k, axis=1)[:, -k]
            low = np.maximum(low, known)
        for leaf, own in index.tree.search(queries, low, high):
            if index.parts[leaf]:
                take = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), leaf, np.int32)), pa.array(np.full(len(own), index.parts[leaf], np.int32)),
                        *(batch.column(n).take(take) for n in ("key", "kind", "code", "place")),
                        pa.array(low[own]), pa.array(high[own]),
                    ],
                    ["leaf", "parts", "key", "kind", "code", "place", "low", "high"],
                )


def _searched(batches, index: Index, same: bool, k: int):
    """The k best of a part's vectors for each query of a block; the queries come first."""
    asked = None
    for (*_, asks), group in runs(batches, ["leaf", "part", "block", "asks"]):
        if asks == 0:
            asked = pa.Table.from_batches(group).combine_chunks().to_batches()[0]
            place = group[0].select(["leaf", "part", "block"]).slice(0, 1)
            continue
        if asked is None or not place.equals(group[0].select(["leaf", "part", "block"]).slice(0, 1)):
            continue
        rows = pa.Table.from_batches(group).combine_chunks().to_batches()[0]
        low = asked.column("low").to_numpy().copy()
        keys = asked.column("key").to_numpy()
        query, row, score = gnat.best(
            index.vectors(rows.column("code")), rows.column("key").to_numpy(), rows.column("kind").to_numpy(),
            index.vectors(asked.column("code")), keys, asked.column("kind").to_numpy(),
            low, asked.column("high").to_numpy(), same, k,
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys[query]), asked.column("place").take(pa.array(query)),
                pa.array(rows.column("key").to_numpy()[row]), pa.array(score.astype(np.int64)),
            ],
            ["key", "place", "other", "score"],
        )


def search(vectors: DataFrame, index: Index, queries: DataFrame, same: bool, k: int) -> DataFrame:
    """key, place, other, score and rank (from 1) of the k best rows of each query.

    ``queries`` has key, kind, code, place (key and place are unique), low and
    high, the least and the greatest score wanted. Rows of the query's own label
    (``same``) or of all others count; rows with its key do not.
    """
    spark = vectors.sparkSession
    queries = materialize(queries.select("key", "kind", "code", "place", "low", "high"), "queries")
    most = max(256, min(BLOCK, HELD_BYTES // (8 * max(index.width, 1))))
    blocks = max(1, -(-queries.count() // most))
    aimed = queries.mapInArrow(
        remote(_aimed, index, same, k),
        "leaf int, parts int, key long, kind long, code array<int>, place int, low double, high double",
    ).select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("key", "place"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("asks"),
        "key", "kind", "code", "place", "low", "high",
    )
    dealt = vectors.mapInArrow(
        remote(_dealt, index), "leaf int, part int, vec_id long, label long, code array<int>"
    ).select(
        "leaf", "part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("asks"),
        F.col("vec_id").alias("key"), F.col("label").alias("kind"), "code",
        F.lit(0).alias("place"), F.lit(0.0).alias("low"), F.lit(0.0).alias("high"),
    )
    keys = ["leaf", "part", "block"]
    found = (
        aimed.union(dealt)
        .repartition(partitions(spark), *keys)
        .sortWithinPartitions(*keys, "asks")
        .mapInArrow(remote(_searched, index, same, k), _FOUND)
    )
    order = Window.partitionBy("key", "place").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, label and code (see :func:`integers`); ``anchors``
    is a condition on it. Negatives are rows of other labels that score from
    ``low`` to ``high`` hundredths of what the positive scores.
    """
    spark = vectors.sparkSession
    prepare(spark)
    own = materialize(
        vectors.select("vec_id", "label", "code", F.monotonically_increasing_id().alias("mark")), "vectors"
    )
    index = build(own)
    if index is None:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    chosen = materialize(
        own.where(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "code")).alias("row"))
        .select(F.col("vec_id").alias("key"), F.col("row.label").alias("kind"), "row.code"),
        "anchors",
    )
    wide = chosen.select("*", F.lit(0).alias("place"), F.lit(float(_NONE)).alias("low"), F.lit(float(-_NONE)).alias("high"))
    near = search(own, index, wide, True, positives).select("key", "rank", "other", "score")
    near = materialize(near, "positives")
    windows = near.select(
        "key", F.col("rank").alias("place"),
        # Whole numbers: the least from low and the greatest up to high hundredths.
        F.expr(f"cast((score * {low} + pmod(-score * {low}, 100L)) div 100 as double)").alias("low"),
        F.expr(f"cast((score * {high} - pmod(score * {high}, 100L)) div 100 as double)").alias("high"),
    ).where("low <= high")
    found = search(own, index, chosen.join(windows, "key"), False, negatives)
    return found.join(
        near.select("key", F.col("rank").alias("place"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score")),
        ["key", "place"],
    ).select(
        F.col("key").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def shifted(vectors: DataFrame) -> DataFrame:
    """The rows with their labels moved on by one (of ten) where 7 divides vec_id."""
    label = F.col("label").cast("long")
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
