"""Quality of documents by weak labels: heuristics vote, EM weighs them, a scorer learns.

1. Overlapping heuristics each vote good (1), bad (0) or abstain (2) on every
   document. Equal votes are counted over the whole corpus; the counts are at
   most 3**(number of heuristics) rows.
2. Expectation-maximisation over the counts estimates each heuristic's accuracy
   on good and on bad documents and the share of good ones, with no labels.
3. The posterior of each document's votes labels a sample of at most
   :data:`SAMPLE` documents, on which a linear scorer over hashed features
   (word shapes, pairs of them, repeated words) is trained.
4. The scorer rates every document; below :data:`LEAST` it is rejected.

Cases: a null text or one without words has score 0 and is rejected; heuristics
abstain on texts of under :data:`FEW` words; repeated rows each count; an empty
table gives no row. Other columns are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, prepare, remote

GOOD, BAD, ABSTAIN = 1, 0, 2
FEW = 8
WIDTH = 1 << 14
SAMPLE = 20_000
LEAST = 0.5

_CLASSES = bytes(
    0x41 if 0x41 <= byte <= 0x5A
    else 0x61 if 0x61 <= byte <= 0x7A or byte >= 0x80
    else 0x30 if 0x30 <= byte <= 0x39
    else 0x20 if byte <= 0x20
    else byte
    for byte in range(256)
)
_RUNS = re.compile(rb"([Aa0])\1+")
_NOT_SYMBOL = bytes(range(0x21)) + b"Aa0.,;:'\"()?-"

#: Names of the heuristics, and the measure below and above which each votes.
#: The first number is the bound for a good vote, the second for a bad one; a
#: measure between them abstains.
HEURISTICS = {
    "capitals": (0.30, 0.60),  # letters that are capitals
    "symbols": (0.03, 0.06),  # bytes that are neither letters, digits nor plain punctuation
    "marks": (0.10, 0.30),  # words that end in a doubled mark
    "echoes": (0.10, 0.30),  # words equal to the one before
    "sameness": (0.40, 0.65),  # pairs of neighbours seen before, over all pairs
    "bare": (0.08, 0.25),  # words without letter or digit
    "digits": (0.20, 0.50),  # bytes that are digits
    "lengths": (14.0, 25.0),  # mean bytes of a word
}


def _shapes(text: str) -> list[bytes]:
    """Each word with runs of capitals, small letters and digits cut to one: ``Aa``, ``a%%%``."""
    return _RUNS.sub(rb"\1", text.encode().translate(_CLASSES)).split()


def measures(text: str) -> tuple[list[float], list[bytes]]:
    """The heuristics' measures and the word shapes of a text with words."""
    classes = text.encode().translate(_CLASSES)
    shapes = _RUNS.sub(rb"\1", classes).split()
    words = text.lower().split()
    n = len(words) or 1
    small, capital = classes.count(b"a"), classes.count(b"A")
    size = max(1, len(classes) - classes.count(b" "))
    counted = Counter(shapes)
    doubled = sum(k for s, k in counted.items() if len(s) > 1 and s[-1] == s[-2] and s[-1] not in b"Aa0.")
    bare = sum(k for s, k in counted.items() if not any(c in b"Aa0" for c in s))
    pairs = max(1, n - 1)
    return [
        capital / max(1, small + capital),
        len(classes.translate(None, _NOT_SYMBOL)) / size,
        doubled / n,
        sum(map(eq, words, words[1:])) / pairs,
        1 - len(set(zip(words, words[1:], strict=False))) / pairs,
        bare / n,
        classes.count(b"0") / size,
        size / n,
    ], shapes


def votes(found: list[float], n_words: int) -> list[int]:
    """One vote per heuristic."""
    if n_words < FEW:
        return [ABSTAIN] * len(HEURISTICS)
    return [
        GOOD if value <= good else BAD if value >= bad else ABSTAIN
        for value, (good, bad) in zip(found, HEURISTICS.values(), strict=True)
    ]


def features(found: list[float], shapes: list[bytes]) -> dict[int, float]:
    """Hashed features: shares of shapes and of pairs of shapes, and the measures."""
    out: dict[int, float] = {}
    for mark, items in ((b"1", shapes), (b"2", zip(shapes, shapes[1:], strict=False))):
        counted = Counter(items)
        total = sum(counted.values()) or 1
        for item, k in counted.items():
            name = item if mark == b"1" else item[0] + b" " + item[1]
            place = zlib.crc32(mark + name) % WIDTH
            out[place] = out.get(place, 0.0) + k / total
    for name, value, (_, bad) in zip(HEURISTICS, found, HEURISTICS.values(), strict=True):
        place = zlib.crc32(b"m" + name.encode()) % WIDTH
        out[place] = out.get(place, 0.0) + min(value / bad, 2.0)
    return out


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200):
    """Share of good documents, and per heuristic the odds of its votes given good and given bad.

    ``patterns`` has one row of votes per distinct combination; abstentions say
    nothing. A heuristic looks for one kind of bad text, so it starts out right
    on most good documents and on less than half of the bad ones.
    """
    prior = 0.8
    right = np.repeat([[0.4], [0.95]], patterns.shape[1], axis=1)  # on bad, on good
    cast = patterns != ABSTAIN
    for _ in range(rounds):
        weight = posterior(patterns, prior, right) * counts
        before = right.copy()
        prior = float(np.clip(weight.sum() / max(counts.sum(), 1), 0.01, 0.99))
        for good, own in ((0, counts - weight), (1, weight)):
            hits = ((patterns == good) & cast).T @ own
            # A few made-up votes keep a heuristic from certainty.
            right[good] = (hits + (4, 9.5)[good]) / (cast.T @ own + 10)
        # A bad vote never speaks for a document: it is likelier on bad ones.
        right = np.clip(right, np.stack([1 - right[1] + 1e-3, np.full(right.shape[1], 0.6)]), 0.999)
        if np.abs(right - before).max() < 1e-6:
            break
    return prior, right


def posterior(patterns: np.ndarray, prior: float, right: np.ndarray) -> np.ndarray:
    """The probability that documents with such votes are good."""
    odds = np.full(len(patterns), np.log(prior / (1 - prior)))
    odds += (patterns == GOOD) @ (np.log(right[1]) - np.log(1 - right[0]))
    odds += (patterns == BAD) @ (np.log(1 - right[1]) - np.log(right[0]))
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def train(rows: list[tuple[list[int], list[float]]], wanted: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic scorer (the last is its constant) for soft labels."""
    owner = np.repeat(np.arange(len(rows)), [len(places) for places, _ in rows])
    place = np.array([p for places, _ in rows for p in places], np.int64)
    value = np.array([v for _, values in rows for v in values])
    weights = np.zeros(WIDTH + 1)
    pace = np.full(WIDTH + 1, 1e-8)
    # Both sides weigh the same, however rare bad documents are.
    share = np.clip(wanted.mean(), 0.02, 0.98)
    heavy = wanted / share + (1 - wanted) / (1 - share)
    for _ in range(rounds):
        score = np.bincount(owner, value * weights[place], len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - wanted) * heavy / len(rows)
        slope = np.append(np.bincount(place, value * error[owner], WIDTH), error.sum())
        slope[:-1] += 1e-5 * weights[:-1]
        pace += slope**2
        weights -= 0.5 * slope / np.sqrt(pace)
    return weights


def _counted(batches):
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column("text").to_pylist():
            if text and not text.isspace():
                found, shapes = measures(text)
                counts["".join(map(str, votes(found, len(shapes))))] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["votes", "docs"]
        )


def _sampled(batches):
    for batch in batches:
        rows = []
        for lot, text in zip(batch.column("lot").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if text and not text.isspace():
                found, shapes = measures(text)
                own = features(found, shapes)
                rows.append(
                    {
                        "lot": lot,
                        "votes": "".join(map(str, votes(found, len(shapes)))),
                        "places": list(own), "shares": list(own.values()),
                    }
                )
        yield pa.RecordBatch.from_pylist(
            rows, schema=pa.schema([("lot", pa.int64()), ("votes", pa.string()), ("places", pa.list_(pa.int32())), ("shares", pa.list_(pa.float64()))])
        )


def _patterns(texts: list[str]) -> np.ndarray:
    return np.array([list(map(int, text)) for text in texts], np.int64).reshape(-1, len(HEURISTICS))


class Model:
    """What the votes taught: prior, accuracies, weights."""

    def __init__(self, prior: float, right: np.ndarray, weights: np.ndarray) -> None:
        self.prior, self.right, self.weights = prior, right, weights


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Accuracies from the votes on all documents, weights from a sample of them."""
    spark = docs.sparkSession
    prepare(spark)
    own = own_columns(docs, doc_id="long", text="string")
    counted = (
        own.select("text").mapInArrow(remote(_counted), "votes string, docs long")
        .groupBy("votes").agg(F.sum("docs").alias("docs")).orderBy("votes").collect()
    )
    patterns = _patterns([row["votes"] for row in counted])
    counts = np.array([row["docs"] for row in counted], float)
    prior, right = expectation_maximisation(patterns, counts)
    # A share of about ``sample`` documents by hash, a repeated row once; in the order of
    # the hash the bound always takes the same ones.
    bound = int(2**63 * min(1.0, sample / max(counts.sum(), 1.0))) - 1
    lot = F.xxhash64("doc_id", "text").bitwiseAND(F.lit(2**63 - 1))
    taken = (
        own.withColumn("lot", lot).where(F.col("lot") <= F.lit(bound))
        .groupBy("lot").agg(F.min("text").alias("text"))
        .mapInArrow(remote(_sampled), "lot long, votes string, places array<int>, shares array<double>")
        .orderBy("lot").limit(sample + sample // 10)
        .collect()
    )
    wanted = posterior(_patterns([row["votes"] for row in taken]), prior, right)
    weights = train([(row["places"], row["shares"]) for row in taken], wanted) if taken else np.zeros(WIDTH + 1)
    return Model(prior, right, weights)


def _send(spark, model: Model):
    return spark.sparkContext.broadcast((uuid.uuid4().hex, model.weights.tobytes()))


def _scores(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        if text and not text.isspace():
            own = features(*measures(text))
            score = weights[list(own)] @ np.fromiter(own.values(), float, len(own)) + weights[-1]
            out[i] = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return out


def _rate(batches, sent, least: float):
    weights = np.frombuffer(sent.value[1])
    for batch in batches:
        texts = batch.column("text").to_pylist()
        scores = _scores(texts, weights)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores), pa.array(scores >= least)], ["doc_id", "score", "kept"]
        )


def _keep(batches, sent, least: float):
    weights = np.frombuffer(sent.value[1])
    for batch in batches:
        keep = _scores(batch.column("__text").to_pylist(), weights) >= least
        yield batch.drop_columns(["__text"]).filter(pa.array(keep))


def rate(docs: DataFrame, model: Model | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, score (0 to 1) and kept of every document."""
    sent = _send(docs.sparkSession, model or learn(docs))
    return own_columns(docs, doc_id="long", text="string").mapInArrow(
        remote(_rate, sent, least), "doc_id long, score double, kept boolean"
    )


def drop_poor(docs: DataFrame, model: Model | None = None, least: float = LEAST) -> DataFrame:
    """The documents, all columns, that are not rejected."""
    sent = _send(docs.sparkSession, model or learn(docs))
    whole = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
        F.col("text").cast("string").alias("__text"),
    )
    return whole.mapInArrow(remote(_keep, sent, least), whole.select("row").schema).select("row.*")
