"""Vectors: hashed word counts for text, digest vectors for episodes.

An embedder turns a text column into an ``array<float>`` column and has a name
that is stored with every index built by it. Any function of a column will do,
so a model can be plugged in as a pandas or Arrow UDF.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: digest vector, word break -------------------------------------
DIGEST_DIM = 128
DIGEST_BYTES = 32
NORM_GUARD = 1e-8
WORD_BREAK = r"[^\p{L}\p{N}_]+"
#: Text and vector bytes that are worked on at once; a longer text goes alone.
PIECE_BYTES = 4 << 20
#: Words whose bucket a worker remembers.
KNOWN_WORDS = 1 << 16
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Embedder:
    """A named way to turn a column into vectors."""

    name: str
    embed: Callable[[Column], Column]


@lru_cache(maxsize=KNOWN_WORDS)
def word_bucket(word: str, dim: int) -> int:
    """The bucket of a word: its MD5's first 32 bits modulo ``dim``."""
    return int(hashlib.md5(word.encode("utf-8")).hexdigest()[:8], 16) % dim


def _vectors(values: np.ndarray, rows: int, dim: int) -> pa.Array:
    offsets = np.arange(0, (rows + 1) * dim, dim, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _pieces(text: pa.Array, dim: int) -> Iterator[pa.Array]:
    """Consecutive slices of bounded bytes, so that memory does not grow with the texts of a batch."""
    sizes = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64) + 8 * dim
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(text):
        before = ends[begin] - sizes[begin]
        stop = max(begin + 1, int(np.searchsorted(ends, before + PIECE_BYTES, side="right")))
        yield text.slice(begin, stop - begin)
        begin = stop


def _count_words(text: pa.Array, dim: int) -> np.ndarray:
    split = pc.split_pattern_regex(pc.utf8_lower(text), WORD_BREAK)
    lengths = split.value_lengths().to_numpy(zero_copy_only=False)
    words = split.flatten().dictionary_encode()
    # Each distinct word of a piece is looked up once; "" gets no bucket.
    buckets = np.array([word_bucket(w, dim) if w else -1 for w in words.dictionary.to_pylist()], np.int64)
    found = buckets[words.indices.to_numpy(zero_copy_only=False)]
    cells = np.repeat(np.arange(len(text), dtype=np.int64) * dim, lengths) + found
    return np.bincount(cells[found >= 0], minlength=len(text) * dim)


def _word_counter(dim: int):
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def count(text: pa.Array) -> pa.Array:
        counts = np.empty(len(text) * dim, np.float32)
        done = 0
        for piece in _pieces(text.fill_null(""), dim):
            counts[done : done + len(piece) * dim] = _count_words(piece, dim)
            done += len(piece) * dim
        return _vectors(counts, len(text), dim)

    return count


def hashed_words(dim: int = 256) -> Embedder:
    """Word counts hashed to ``dim`` buckets.

    Left unnormalised on purpose: the counts are whole numbers, so dot products
    are exact and a cosine does not depend on how the rows were batched.
    """
    return Embedder(f"hashed-words-{dim}", _word_counter(dim))


@cache
def _digest_tiler():
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def tile(digests: pa.Array) -> pa.Array:
        present = np.frombuffer(b"".join(digests.to_pylist()), dtype=np.uint8)
        values = np.tile(
            present.reshape(len(digests), DIGEST_BYTES) / 255.0, (1, DIGEST_DIM // DIGEST_BYTES)
        )
        norms = np.sqrt((values * values).sum(axis=1, keepdims=True)) + NORM_GUARD
        return _vectors((values / norms).astype(np.float32).ravel(), len(digests), DIGEST_DIM)

    return tile


def digest_embedding(key: Column) -> Column:
    """Deterministic vector of a text: its SHA-256 bytes, tiled and normalised.

    Hashing stays in the JVM, so only 32 bytes per row travel to Python; a null
    text is embedded like an empty one.
    """
    return _digest_tiler()(F.unhex(F.sha2(F.coalesce(key, F.lit("")), 256)))


DIGEST_BACKBONE = Embedder("digest/sha256", digest_embedding)
