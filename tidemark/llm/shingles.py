"""Hashes of word shingles, for a whole batch of texts at a time.

Words are the runs of bytes other than white space (0x20, 0x09-0x0D) of the
UTF-8 text with A-Z lower-cased. A text's shingles are its runs of ``size``
words; a shorter text has one, its whole sequence; one without words has none.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = bytes(
    0x20 if byte in (0x20, *range(0x09, 0x0E)) else byte + 32 if 0x41 <= byte <= 0x5A else byte
    for byte in range(256)
)
#: Bytes hashed at a time; the arrays for it are some ten times as large.
BLOCK = 1 << 20


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all 64 bits (a one-to-one map)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base & (1 << 64) - 1, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    up = np.empty(0, np.uint64)
    down = np.empty(0, np.uint64)

    @classmethod
    def of(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < count:
            cls.up = _powers(_BASE, count)
            cls.down = _powers(pow(_BASE, -1, 1 << 64), count)
        return cls.up, cls.down


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of already translated bytes."""
    codes = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], codes != 0x20, [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = turns[::2], turns[1::2]
    up, down = _Powers.of(len(codes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[: len(codes)], dtype=np.uint64)])
    hashes = (sums[stops] - sums[starts]) * down[starts] if len(starts) else np.empty(0, np.uint64)
    return mix(hashes + (stops - starts).astype(np.uint64)), starts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in a row, and the number of words of each text."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    begin = 0
    while begin < len(texts):
        stop, size = begin, 0
        while stop < len(texts) and (stop == begin or size + len(texts[stop]) < BLOCK):
            size += len(texts[stop]) + 1
            stop += 1
        if size <= 2 * BLOCK:
            data = b" ".join(texts[begin:stop]).translate(_TABLE)
            own, starts = _hash_words(data)
            ends = np.cumsum([len(text) + 1 for text in texts[begin:stop]])
            counts[begin:stop] = np.diff(np.concatenate([[0], np.searchsorted(starts, ends)]))
            hashes.append(own)
        else:  # one long text, cut between words
            data, at = texts[begin].translate(_TABLE), 0
            while at < len(data):
                cut = data.find(b" ", at + BLOCK)
                cut = len(data) if cut < 0 else cut
                own, _ = _hash_words(data[at:cut])
                hashes.append(own)
                counts[begin] += len(own)
                at = cut
        begin = stop
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), counts


def shingle_hashes(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in a row, repeats included, and how many each text has."""
    words, counts = word_hashes(texts)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    begins = np.cumsum(counts) - counts
    windows = max(0, len(words) - size + 1)
    sums = np.zeros(windows, np.uint64)
    for j in range(size):
        sums += words[j : j + windows] * factors[j]
    hashes = mix(sums)
    long = counts >= size
    number = np.where(long, counts - size + 1, np.minimum(counts, 1))
    own = np.cumsum(number) - number
    out = np.empty(int(number.sum()), np.uint64)
    full = np.where(long, number, 0)
    starts = np.repeat(begins - (np.cumsum(full) - full), full)
    place = np.repeat(own - (np.cumsum(full) - full), full)
    run = np.arange(int(full.sum()))
    out[place + run] = hashes[starts + run]
    for i in np.flatnonzero(~long & (counts > 0)).tolist():
        part = words[begins[i] : begins[i] + counts[i]]
        total = (part * factors[: len(part)]).sum(dtype=np.uint64)
        out[own[i]] = mix(np.array([total + np.uint64(len(part))]))[0]
    return out, number


def distinct_shingles(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, number = shingle_hashes(texts, size)
    out = []
    for part in np.split(hashes, np.cumsum(number)[:-1]):
        part = np.sort(part)
        out.append(part[np.concatenate([[True], part[1:] != part[:-1]])] if len(part) else part)
    return out
