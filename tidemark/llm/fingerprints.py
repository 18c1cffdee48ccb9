"""One-permutation MinHash fingerprints of documents.

Every shingle is hashed once; the top bits choose a bin, and a bin keeps its
least hash. An empty bin takes the value of the first filled one in a probe
sequence of its own (optimal densification), the same sequence for all texts.
Of each bin the low :data:`BITS` bits are kept, packed, as hexadecimal text. Two
bins agree by chance in one of 2**BITS cases; :func:`likeness` corrects for it.

Cases: texts are compared by lower-cased words (A-Z), so equal texts have equal
fingerprints; a text without words (or null) has the empty fingerprint, likeness
1 to another empty one and 0 to all others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, partitions, pieces, prepare, remote
from tidemark.llm.shingles import mix, shingle_hashes

BINS = 512
BITS = 4
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _probes(step: int) -> np.ndarray:
    """Where each bin looks in this step."""
    return (mix(np.arange(BINS, dtype=np.uint64) + np.uint64(step << 32)) % np.uint64(BINS)).astype(np.int64)


def _densify(least: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row; a row has at least one filled bin."""
    filled = least != _EMPTY
    row, bin_ = np.nonzero(~filled)
    out, step = least.copy(), 0
    while len(row):
        step += 1
        # After many steps go on bin by bin, so that the search ends.
        seek = _probes(step)[bin_] if step <= 16 * BINS else (bin_ + step) % BINS
        found = filled[row, seek]
        out[row[found], bin_[found]] = least[row[found], seek[found]]
        row, bin_ = row[~found], bin_[~found]
    return out


def signatures(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Per text the kept bits of each bin, and whether it has any word."""
    hashes, number = shingle_hashes(texts, size)
    least = np.full((len(texts), BINS), _EMPTY)
    row = np.repeat(np.arange(len(texts)), number)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    np.minimum.at(least.ravel(), row * BINS + (hashes >> shift).astype(np.int64), hashes)
    some = number > 0
    least[some] = _densify(least[some])
    # Mixed with the bin's number: copies of one value then agree by chance bin by bin,
    # not all at once.
    own = mix(least ^ mix(np.arange(BINS, dtype=np.uint64)))
    return (own & np.uint64((1 << BITS) - 1)).astype(np.uint8), some


def packed(bits: np.ndarray, some: np.ndarray) -> list[str]:
    """Fingerprint strings: two bins a byte, in hexadecimal; empty without words."""
    pairs = bits[:, 0::2] << BITS | bits[:, 1::2]
    return [row.tobytes().hex() if any_ else "" for row, any_ in zip(pairs, some, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """Estimated share of common shingles of paired signatures, 0 to 1."""
    chance = 1 / (1 << BITS)
    agree = (a == b).mean(axis=1)
    value = np.clip((agree - chance) / (1 - chance), 0, 1)
    return np.where(some_a & some_b, value, (some_a == some_b).astype(float))


def edited(text: str, following: str) -> str:
    """The text whose last third is replaced by as many characters of another's beginning."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


FOLLOWED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _fingerprints(batches, size: int):
    for batch in batches:
        own = [(text or "").encode() for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(packed(*signatures(own, size)), pa.string())],
            ["doc_id", "fingerprint"],
        )


def fingerprint(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id and fingerprint of every document; no shuffle."""
    prepare(docs.sparkSession)
    return own_columns(docs, doc_id="long", text="string").mapInArrow(remote(_fingerprints, size), "doc_id long, fingerprint string")


def _follow(batches, size: int):
    held: tuple | None = None  # the last document whose next one is not known yet
    for batch in batches:
        rows = list(
            zip(
                batch.column("guest").to_pylist(), batch.column("doc_id").to_pylist(),
                [text or "" for text in batch.column("text").to_pylist()], strict=True,
            )
        )
        rows = ([held] if held else []) + rows
        held = None if rows[-1][0] else rows[-1]
        for begin, stop in pieces([len(row[2]) for row in rows], 1 << 20):
            yield from _followed(rows[begin : stop + 1], size)


#: Characters of a text that order documents of one doc_id.
FIRST = 32
_KEY = ("_null", "_down", "_worded", "_first", "_digest", "_mark")


def _ordered(docs: DataFrame) -> DataFrame:
    """Documents with the columns that order them, all ascending.

    Rows alike in everything but the last one, a number of the row, are the same
    document again, so it does not matter that they may change places.
    """
    text = F.col("text")
    return docs.select(
        "doc_id", "text", F.col("doc_id").isNull().alias("_null"),
        F.coalesce(F.bitwise_not("doc_id"), F.lit(0).cast("long")).alias("_down"),
        text.isNotNull().alias("_worded"), F.coalesce(F.substring(text, 1, FIRST), F.lit("")).alias("_first"),
        F.coalesce(F.md5(text), F.lit("")).alias("_digest"), F.monotonically_increasing_id().alias("_mark"),
    )


def _range_of(bounds: list[tuple]):
    """A function from the ordering columns to the number of the last bound that is not after them."""

    def number(*columns):
        import bisect

        import pandas as pd

        keys = zip(*(column.tolist() for column in columns), strict=True)
        return pd.Series([max(0, bisect.bisect_right(bounds, key) - 1) for key in keys], dtype="int32")

    return number


def with_next(docs: DataFrame, size: int = 5, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every document, of its edited text, and likeness to the next.

    The next document is the one with the next smaller doc_id (equal ones by
    the first characters of their texts, then by digest; none without doc_id
    before one with); after the last comes the first.
    Documents are dealt by ranges of that order. The bounds are the first keys of
    the partitions in which Spark lays the order's columns alone, one short row a
    range. Each range also gets the first document of the next one as a guest, so
    a task sees every next document while it holds two texts at most besides its
    batch.
    """
    spark = docs.sparkSession
    prepare(spark)
    number = ranges or partitions(spark)
    placed = _ordered(own_columns(docs, doc_id="long", text="string"))
    heads = (
        placed.select(*_KEY)
        .repartitionByRange(number, *_KEY)
        .groupBy(F.spark_partition_id())
        .agg(F.min(F.struct(*_KEY)).alias("head"))
        .select("head.*")
        .orderBy(*_KEY)
        .collect()
    )
    if not heads:
        return spark.createDataFrame([], FOLLOWED)
    bounds = [tuple(row) for row in heads]
    part = F.pandas_udf(_range_of(bounds), "int")(*_KEY)
    wanted = spark.createDataFrame(
        [(*bounds[(i + 1) % len(bounds)][:5], i) for i in range(len(bounds))],
        "_null boolean, _down long, _worded boolean, _first string, _digest string, part int",
    )
    guests = (
        placed.join(F.broadcast(wanted), list(_KEY[:5]))
        .groupBy("part")
        .agg(F.first("text").alias("text"))
        .select("part", F.lit(True).alias("guest"), F.lit(None).cast("long").alias("doc_id"), "text",
                *(F.lit(None).cast(placed.schema[name].dataType).alias(name) for name in _KEY))
    )
    dealt = placed.select(part.alias("part"), F.lit(False).alias("guest"), "doc_id", "text", *_KEY).unionByName(guests)
    return (
        dealt.repartition(number, "part")
        .sortWithinPartitions("part", "guest", *_KEY)
        .select("guest", "doc_id", "text")
        .mapInArrow(remote(_follow, size), FOLLOWED)
    )


def _followed(rows: list[tuple], size: int):
    """Results of all rows but the last, each against the row after it; guests give none."""
    texts = [text for _, _, text in rows]
    own = [i for i, (guest, _, _) in enumerate(rows[:-1]) if not guest]
    if not own:
        return
    changed = [edited(texts[i], texts[i + 1]).encode() for i in own]
    bits, some = signatures([text.encode() for text in texts], size)
    other, some_other = signatures(changed, size)
    following = [i + 1 for i in own]
    yield pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([rows[i][1] for i in own], pa.int64()),
            "n_chars": pa.array([len(texts[i]) for i in own], pa.int64()),
            "edited_sha256": [hashlib.sha256(text).hexdigest() for text in changed],
            "fingerprint": packed(bits[own], some[own]),
            "edited_fingerprint": packed(other, some_other),
            "near_edited": likeness(bits[own], other, some[own], some_other),
            "near_next": likeness(bits[own], bits[following], some[own], some[following]),
        }
    )
