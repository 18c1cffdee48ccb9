"""Near-duplicate documents by MinHash, banding and exact confirmation.

1. Every document gets its set of distinct shingle hashes, a digest of the set,
   :data:`BANDS` x :data:`ROWS` universal hash minima, and a key per band.
   Documents with the same set form a class at once; only classes go on.
2. Classes with an equal band key share a bucket. A link at the wanted
   similarity s is missed by all bands with probability (1 - s**4)**25, which is
   2e-6 at 0.8 and less above.
3. In every bucket all members are compared with its central class, the one that
   shares most buckets with others: by their kept minima first (a pair far below
   the threshold goes), then on the full sets. Links become components by
   alternating large-star and small-star; what lies in one component needs no
   further look. Once more the same among the members outside each bucket's
   largest component.
4. What is still outside a bucket's largest component is compared on full sets
   with all members of the bucket: blocks of outside members against slices of
   all, streamed, of which only links come out.

So a large group of near copies costs about one comparison a member, no pairs
within a group are listed, and still no link between components is lost.

Cases: a null or wordless text has no set and is linked with nothing; a text of
fewer words than a shingle has its whole sequence as one; repeated rows and rows
without doc_id belong to the class of their text; an empty table gives no row.
Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, partitions, pieces, prepare, ragged, remote
from tidemark.llm.graph import components
from tidemark.llm.shingles import distinct_shingles, mix
from tidemark.session import materialize

BANDS = 25
ROWS = 4

#: Outside members compared at once with the members that stream by, and how
#: many of those a task sees of one bucket.
BLOCK = 256
SLICE = 8192

#: A pair whose kept minima agree in a smaller share than the threshold less this
#: is not confirmed; over 100 minima that is more than five standard deviations.
MARGIN = 0.21

_SEED = np.random.default_rng(20240229)
_FACTOR = _SEED.integers(0, 1 << 63, BANDS * ROWS, np.uint64) << np.uint64(1) | np.uint64(1)
_SHIFT = _SEED.integers(0, 1 << 63, BANDS * ROWS, np.uint64)

PRINTS = "doc_id long, digest binary, n_shingles long, class binary, minima binary, bands array<long>"


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Least value of each universal hash function over each set; sets are not empty.

    A set's members are folded to 32 bits x; a function is the upper half of
    (factor * x + shift) modulo 2**64.
    """
    out = np.empty((len(sets), BANDS * ROWS), np.uint32)
    for begin, stop in pieces([len(own) for own in sets], 1 << 14):
        folded = np.concatenate(sets[begin:stop]) >> np.uint64(32)
        starts = np.concatenate([[0], np.cumsum([len(own) for own in sets[begin : stop - 1]])]).astype(np.int64)
        value = np.empty_like(folded)
        for j in range(BANDS * ROWS):
            np.multiply(folded, _FACTOR[j], out=value)
            value += _SHIFT[j]
            out[begin:stop, j] = np.minimum.reduceat(value, starts) >> np.uint64(32)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different for equal rows of different bands."""
    rows = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(7)), rows.shape[:2])
    for j in range(ROWS):
        key = mix(key ^ rows[:, :, j])
    return key.view(np.int64)


def _prints(batches, size: int):
    for batch in batches:
        texts = [(text or "").encode() for text in batch.column("text").to_pylist()]
        for begin, stop in pieces([len(text) for text in texts], 1 << 20):
            sets = distinct_shingles(texts[begin:stop], size)
            some = np.array([len(own) > 0 for own in sets], bool)
            full = [own for own in sets if len(own)]
            values = minima(full)
            classes, kept = iter([_class(own) for own in full]), iter(values.astype("<u2"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[begin:stop],
                    batch.column("digest")[begin:stop],
                    pa.array([len(own) for own in sets], pa.int64()),
                    pa.array([next(classes) if has else None for has in some], pa.binary()),
                    pa.array([next(kept).tobytes() if has else None for has in some], pa.binary()),
                    ragged(
                        band_keys(values).ravel(),
                        np.concatenate([[0], np.cumsum(some * BANDS)]),
                        pa.int64(),
                    ),
                ],
                ["doc_id", "digest", "n_shingles", "class", "minima", "bands"],
            )


def _class(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def prints(docs: DataFrame, size: int = 5) -> DataFrame:
    """The sets' digests and minima of all documents (see PRINTS), without a shuffle."""
    prepare(docs.sparkSession)
    own = own_columns(docs, doc_id="long", text="string")
    return own.select("doc_id", text_digest("text").alias("digest"), "text").mapInArrow(
        remote(_prints, size), PRINTS
    )


def text_digest(column: str):
    return F.unhex(F.md5(F.col(column)))


def _likely(batches, least: float):
    for batch in batches:
        a, b = (
            np.frombuffer(b"".join(batch.column(name).to_pylist()), "<u2").reshape(-1, BANDS * ROWS)
            for name in ("minima_a", "minima_b")
        )
        keep = (a == b).mean(axis=1) >= least
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _sets(batches, size: int):
    for batch in batches:
        texts = [(text or "").encode() for text in batch.column("text").to_pylist()]
        sets = distinct_shingles(texts, size)
        yield pa.RecordBatch.from_arrays(
            [batch.column("class"), pa.array([own.astype("<u8").tobytes() for own in sets], pa.binary())],
            ["class", "set"],
        )


def _confirmed(batches, percent: int):
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            a, b = (np.frombuffer(own.as_buffer(), "<u8") for own in (a, b))
            # Both are sorted and without repeats: equal neighbours are common members.
            both = np.sort(np.concatenate([a, b]), kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= percent * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All members of the sets of a column in a row, and each set's size."""
    parts = [np.frombuffer(own.as_buffer(), "<u8") for own in column]
    return np.concatenate(parts), np.array([len(part) for part in parts])


class _Block:
    """Outside members of a bucket, with an index from shingles to them."""

    def __init__(self, rows: pa.RecordBatch) -> None:
        self.classes, self.roots = rows.column("class").to_pylist(), rows.column("root").to_pylist()
        flat, self.sizes = _flat(rows.column("set"))
        order = np.argsort(flat, kind="stable")
        self.owners = np.repeat(np.arange(len(self.sizes)), self.sizes)[order]
        self.words, first = np.unique(flat[order], return_index=True)
        self.ends = np.append(first, len(flat))
        self.done: set[tuple[int, bytes]] = set()

    def links(self, rows: pa.RecordBatch, percent: int):
        """Links between the block and other rows, one for each component met."""
        n = len(self.sizes)
        for begin, stop in pieces([len(own.as_buffer()) for own in rows.column("set")], 1 << 17):
            part = rows.slice(begin, stop - begin)
            flat, sizes = _flat(part.column("set"))
            place = np.minimum(np.searchsorted(self.words, flat), len(self.words) - 1)
            met = np.flatnonzero(self.words[place] == flat)
            row, place = np.repeat(np.arange(len(sizes)), sizes)[met], place[met]
            lengths = self.ends[place + 1] - self.ends[place]
            before = np.cumsum(lengths) - lengths
            owner = self.owners[np.repeat(self.ends[place] - before, lengths) + np.arange(int(lengths.sum()))]
            common = np.bincount(np.repeat(row, lengths) * n + owner, minlength=n * len(sizes)).reshape(-1, n)
            close = 100 * common >= percent * (sizes[:, None] + self.sizes[None] - common)
            classes, roots = part.column("class").to_pylist(), part.column("root").to_pylist()
            for j, i in np.argwhere(close & (common > 0)).tolist():
                if roots[j] != self.roots[i] and (i, roots[j]) not in self.done:
                    self.done.add((i, roots[j]))
                    yield self.classes[i], classes[j]


def _blocked(batches, percent: int):
    """Links of rows sorted by place (bucket, block, slice), the block's own rows first."""
    held, now, block = [], None, None
    for batch in batches:
        places = list(zip(*(batch.column(name).to_pylist() for name in ("bucket", "block", "slice", "streamed")), strict=True))
        cuts = [i for i in range(1, len(places)) if places[i] != places[i - 1]]
        found = []
        for begin, stop in zip([0, *cuts], [*cuts, len(places)], strict=True):
            *place, streamed = places[begin]
            rows = batch.slice(begin, stop - begin)
            if place != now:
                held, now, block = [], place, None
            if not streamed:
                held.append(rows)
                continue
            if not held:
                continue  # by chance no outside member has this block's number
            if block is None:
                block = _Block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
            found += block.links(rows, percent)
        yield pa.RecordBatch.from_arrays(
            [pa.array([pair[i] for pair in found], pa.binary()) for i in (0, 1)], ["a", "b"]
        )


class _Linker:
    """Finds links between classes that share a bucket."""

    def __init__(self, docs: DataFrame, shown: DataFrame, percent: int, size: int) -> None:
        self.percent = percent
        # Of the documents of a class the one with the least (doc_id, digest) stands for it.
        classes = materialize(
            shown.where("class is not null")
            .groupBy("class")
            .agg(
                F.min(F.struct("doc_id", "digest")).alias("first"),
                F.first("minima").alias("minima"),
                F.first("bands").alias("bands"),
            )
            .select("class", "first.doc_id", "first.digest", "minima", "bands"),
            "classes",
        )
        self.minima = classes.select("class", "minima")
        members = classes.select(F.explode("bands").alias("bucket"), "class")
        shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        members = materialize(members.join(shared, "bucket"), "members")
        weights = members.groupBy("class").agg(F.sum("n").alias("weight"))
        self.members = materialize(members.select("bucket", "class").join(weights, "class"), "members")
        # The full sets of classes that share a bucket with others, from one document each.
        asked = classes.select("class", "doc_id", "digest").join(weights, "class", "left_semi")
        own = own_columns(docs, doc_id="long", text="string").withColumn("digest", text_digest("text"))
        self.sets = materialize(
            own.join(asked, own["doc_id"].eqNullSafe(asked["doc_id"]) & (own["digest"] == asked["digest"]))
            .select(asked["class"], own["text"])
            .dropDuplicates(["class"])
            .mapInArrow(remote(_sets, size), "class binary, set binary"),
            "sets",
        )

    def star(self, members: DataFrame) -> DataFrame:
        """Links of members (bucket, class, weight, others: compared with) to their bucket's center."""
        centers = members.where("center").groupBy("bucket").agg(F.max(F.struct("weight", "class")).alias("top"))
        pairs = members.join(centers.select("bucket", F.col("top.class").alias("b")), "bucket").where("class <> b")
        likely = materialize(
            pairs.select(F.least("class", "b").alias("a"), F.greatest("class", "b").alias("b"))
            .distinct()
            .join(self.minima.toDF("a", "minima_a"), "a")
            .join(self.minima.toDF("b", "minima_b"), "b")
            .mapInArrow(remote(_likely, self.percent / 100 - MARGIN), "a binary, b binary"),
            "likely",
        )
        return materialize(
            likely.join(self.sets.toDF("a", "set_a"), "a")
            .join(self.sets.toDF("b", "set_b"), "b")
            .mapInArrow(remote(_confirmed, self.percent), "a binary, b binary"),
            "links",
        )

    def open(self, found: DataFrame) -> DataFrame:
        """Members of buckets with several components; center: outside the largest of them."""
        rooted = self.members.join(found.toDF("class", "root"), "class", "left").withColumn(
            "root", F.coalesce("root", "class")
        )
        main = (
            rooted.groupBy("bucket", "root")
            .agg(F.count("*").alias("n"))
            .groupBy("bucket")
            .agg(F.max(F.struct("n", "root")).alias("main"), F.count("*").alias("roots"), F.sum("n").alias("n"))
            .where("roots > 1")
            .select("bucket", "n", F.col("main.n").alias("inside"), F.col("main.root").alias("main"))
        )
        return materialize(
            rooted.join(main, "bucket").select(
                "bucket", "class", "weight", "root", "n", (F.col("n") - F.col("inside")).alias("outside"),
                (F.col("root") != F.col("main")).alias("center"),
            ),
            "open",
        )

    def blocks(self, open_: DataFrame) -> DataFrame:
        """Links of outside members to all members of their bucket, by blocks and slices."""
        blocks = F.ceil(F.col("outside") / BLOCK).cast("int")
        slices = F.ceil(F.col("n") / SLICE).cast("int")
        lot = F.xxhash64("class")
        columns = ("bucket", "block", "slice", "streamed", "class", "root")
        own = open_.where("center").select(
            "bucket", F.pmod(lot, blocks).cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"),
            F.lit(False).alias("streamed"), "class", "root",
        )
        passing = open_.select(
            "bucket", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
            F.pmod(lot, slices).cast("int").alias("slice"), F.lit(True).alias("streamed"), "class", "root",
        )
        return materialize(
            own.select(*columns)
            .union(passing.select(*columns))
            .join(self.sets, "class")
            .repartition(partitions(open_.sparkSession), "bucket", "block", "slice")
            .sortWithinPartitions("bucket", "block", "slice", "streamed")
            .mapInArrow(remote(_blocked, self.percent), "a binary, b binary"),
            "links",
        )


def link(docs: DataFrame, shown: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """node and root for all classes that have a link; ``shown`` are the written prints."""
    linker = _Linker(docs, shown, percent, size)
    links = linker.star(linker.members.withColumn("center", F.lit(True)))
    links = links.union(linker.star(linker.open(components(links))))
    links = links.union(linker.blocks(linker.open(components(links))))
    return components(links)


def _rooted(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """The prints with their component's root; null for documents without words."""
    shown = materialize(prints(docs, size), "prints")
    found = link(docs, shown.select("doc_id", "digest", "class", "minima", "bands"), percent, size)
    return shown.select("doc_id", "digest", "n_shingles", "class").join(
        found.toDF("class", "root"), "class", "left"
    ).select("doc_id", "digest", "n_shingles", F.coalesce("root", "class").alias("root"))


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per document.

    Documents are linked when 100 * common >= percent * union of their shingles;
    component_id is the least doc_id that links reach, itself included.
    """
    rooted = _rooted(docs, percent, size)
    least = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        F.coalesce(
            F.when(F.col("root").isNull(), F.lit(True)).otherwise(F.col("doc_id") == F.col("least")), F.lit(False)
        ).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """The documents, all columns, of which one per component stays.

    It is the one with the least doc_id, then the least digest of its text, and
    of equal rows one. Documents without words all stay.
    """
    rooted = _rooted(docs, percent, size)
    winners = materialize(
        rooted.where("root is not null")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first"))
        .select("first.doc_id", "first.digest"),
        "winners",
    )
    columns = docs.columns
    whole = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in columns)).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.md5(F.col("text").cast("string"))).alias("digest"),
        F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
    )
    match = whole["doc_id"].eqNullSafe(winners["doc_id"]) & (whole["digest"] == winners["digest"])
    kept = whole.where("worded").join(winners, match, "left_semi").dropDuplicates(["doc_id", "digest"])
    return kept.union(whole.where("not worded")).select("row.*")
