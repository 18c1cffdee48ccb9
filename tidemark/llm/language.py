"""Language of texts by n-gram filters that answer for all languages at once.

Text is lower-cased, characters other than letters become one space, and the
n-grams are windows of :data:`GRAM` bytes of its UTF-8 form. From documents of
known language, the share of each language's documents that hold an n-gram is
counted over the whole corpus; those above :data:`SHARE` make up the language.

They are stored in Bloom filters sliced by bit: one table whose cell i holds bit
i of every language's filter, so that the AND of a few cells gives the bitmask
of all languages with the n-gram. A cell is as many 64-bit words as the languages
need. Per language, hits are counted over the text's
n-grams (a popcount per bit); a filter with a share f of its bits set answers
yes by chance for f**HASHES of the others, so n hits of m mean
(n - m * p) / (1 - p) true ones. The most true hits win.

The table has a power of two of cells, at least :data:`CELLS` and :data:`ROOM` for
each n-gram of the language that has the most, which are counted before it is
filled; so a filter answers by chance for some 0.5 % of the others at most. It
takes 8 bytes a cell for every 64 languages, on the driver and in each worker, and
is filled 64 languages at a time. An n-gram that is in SHARE of a language's documents
counts towards their n-grams, so there are at most (mean number of distinct
n-grams of a document) / SHARE of them per language, however large the corpus.

Cases: a null text or one without a letter is ``und`` with score 0; so is any
text if nothing was learned. Equal counts go to the language that sorts first. A
null lang teaches nothing. Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, pieces, prepare, remote
from tidemark.llm.shingles import mix
from tidemark.session import materialize

GRAM = 4
HASHES = 3
SHARE = 0.02
#: Cells of the table at least, and for each n-gram of the language with the most.
CELLS = 1 << 20
ROOM = 16
UNKNOWN = "und"

#: A language is counted in a bit of a cell; each word of a cell has so many.
WORD = 64

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts in a row, and how many each has (0 without a letter)."""
    plain = [_NOT_LETTERS.sub(" ", text.lower()).strip() for text in texts]
    # Signs such as raised digits pass as parts of words but are no letters.
    data = [f" {text} ".encode() if any(map(str.isalpha, text)) else b"" for text in plain]
    counts = np.array([max(0, len(part) - GRAM + 1) if part else 0 for part in data], np.int64)
    short = [i for i, part in enumerate(data) if part and len(part) < GRAM]
    for i in short:  # a single letter of one byte
        data[i] = data[i].ljust(GRAM)
        counts[i] = 1
    codes = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(codes) - GRAM + 1), np.uint64)
    for j in range(GRAM):
        out = out << np.uint64(8) | codes[j : j + len(out)]
    lengths = np.array([len(part) for part in data], np.int64)
    starts = np.cumsum(lengths) - lengths
    before = np.cumsum(counts) - counts
    return out[np.repeat(starts - before, counts) + np.arange(int(counts.sum()))], counts


def _distinct(texts: list[str]) -> list[np.ndarray]:
    own, counts = grams(texts)
    return [np.unique(part) for part in np.split(own, np.cumsum(counts)[:-1])]


def _counted(batches):
    """How many documents of a batch, by language, hold each n-gram; -1 counts them all."""
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        held: dict[str, list[np.ndarray]] = {}
        for begin, stop in pieces([len(text) for text in texts], 1 << 20):
            for lang, own in zip(langs[begin:stop], _distinct(texts[begin:stop]), strict=True):
                if len(own):
                    held.setdefault(lang, []).append(own)
        for lang, parts in held.items():
            values, number = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * (len(values) + 1), pa.string()),
                    "gram": np.append(values.astype(np.int64), -1),
                    "docs": np.append(number, len(parts)).astype(np.int64),
                }
            )


def cells(values: np.ndarray, number: int = CELLS) -> list[np.ndarray]:
    """The cells of each n-gram, one array per hash function."""
    first = mix(values + np.uint64(0x51ED270B))
    step = mix(first) | np.uint64(1)
    return [((first + step * np.uint64(j)) % np.uint64(number)).astype(np.int64) for j in range(HASHES)]


class Model:
    """The languages, the sliced filters, and each filter's rate of chance answers."""

    def __init__(self, languages: list[str], table: np.ndarray) -> None:
        self.languages, self.table = languages, table
        bits = np.array(
            [np.count_nonzero(table[i // WORD] >> np.uint64(i % WORD) & np.uint64(1)) for i in range(len(languages))]
        )
        self.chance = (bits / table.shape[1]) ** HASHES

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score (share of the text's n-grams it truly has) of each text."""
        own, counts = grams(texts)
        places = cells(own, self.table.shape[1])
        ends = np.concatenate([[0], np.cumsum(counts)])
        best, names = np.zeros(len(texts)), [UNKNOWN] * len(texts)
        for i, (lang, chance) in enumerate(zip(self.languages, self.chance, strict=True)):
            if i % WORD == 0:
                word = self.table[i // WORD]
                mask = word[places[0]]
                for at in places[1:]:
                    mask = mask & word[at]
            hits = np.concatenate([[0], np.cumsum(mask >> np.uint64(i % WORD) & np.uint64(1), dtype=np.int64)])
            number = (hits[ends[1:]] - hits[ends[:-1]]).astype(float)
            with np.errstate(invalid="ignore", divide="ignore"):
                share = np.clip((number / counts - chance) / (1 - chance), 0, 1)
            for j in np.flatnonzero((counts > 0) & ((share > best) | (np.array(names) == UNKNOWN))):
                best[j], names[j] = share[j], lang
        return names, best


def learn(docs: DataFrame, share: float = SHARE) -> tuple[list[str], np.ndarray]:
    """Languages and sliced filters (words, cells) from all documents with text and lang."""
    spark = docs.sparkSession
    prepare(spark)
    counted = materialize(
        own_columns(docs, text="string", lang="string")
        .where("text is not null and lang is not null")
        .mapInArrow(remote(_counted), "lang string, gram long, docs long")
        .groupBy("lang", "gram")
        .agg(F.sum("docs").alias("docs")),
        "grams",
    )
    totals = {row["lang"]: row["docs"] for row in counted.where("gram = -1").orderBy("lang").collect()}
    languages = sorted(totals)
    groups = [languages[begin : begin + WORD] for begin in range(0, len(languages), WORD)]

    def kept(group: list[str]) -> DataFrame:
        least = F.coalesce(*(F.when(F.col("lang") == lang, F.lit(totals[lang] * share)) for lang in group))
        return counted.where((F.col("gram") >= 0) & (F.col("docs") >= least)).select("lang", "gram")

    sizes = [kept(group).groupBy("lang").count().agg(F.max("count")).first()[0] or 0 for group in groups]
    number = max(CELLS, 1 << (ROOM * max([1, *sizes]) - 1).bit_length())
    table = np.zeros((max(1, len(groups)), number), np.uint64)
    for row, group in zip(table, groups, strict=False):
        place = {lang: i for i, lang in enumerate(group)}
        for batch in kept(group).toArrow().to_batches():
            owner = np.array([place[lang] for lang in batch.column("lang").to_pylist()], np.uint64)
            values = batch.column("gram").to_numpy().astype(np.uint64)
            for at in cells(values, number):
                np.bitwise_or.at(row, at, np.uint64(1) << owner)
    return languages, table


_MODELS: dict[str, Model] = {}


def _model(sent) -> Model:
    """This worker's model; one is kept."""
    name, languages, table, shape = sent.value
    if name not in _MODELS:
        _MODELS.clear()
        _MODELS[name] = Model(languages, np.frombuffer(table, np.uint64).reshape(shape))
    return _MODELS[name]


def _predicted(texts: list[str | None], sent) -> tuple[list[str], np.ndarray]:
    names, scores = [], []
    for begin, stop in pieces([len(text or "") for text in texts], 1 << 20):
        own, score = _model(sent).predict([text or "" for text in texts[begin:stop]])
        names += own
        scores.append(score)
    return names, np.concatenate(scores) if scores else np.zeros(0)


def _identify(batches, sent):
    for batch in batches:
        names, scores = _predicted(batch.column("text").to_pylist(), sent)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
            ["doc_id", "held_out", "lang_pred", "score"],
        )


def _keep(batches, sent, least: float):
    for batch in batches:
        names, scores = _predicted(batch.column("__text").to_pylist(), sent)
        keep = [name != UNKNOWN and score >= least for name, score in zip(names, scores, strict=True)]
        yield batch.drop_columns(["__text"]).filter(pa.array(keep, pa.bool_()))


def _sent(spark, languages: list[str], table: np.ndarray):
    import uuid

    return spark.sparkContext.broadcast((uuid.uuid4().hex, languages, table.tobytes(), table.shape))


def held_out(column: str = "doc_id"):
    """Whether a document is left for testing: crc32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of all documents, learned from the rest."""
    own = own_columns(docs, doc_id="long", text="string", lang="string")
    sent = _sent(docs.sparkSession, *learn(own.where(~held_out())))
    return own.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        remote(_identify, sent), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def drop_unidentified(docs: DataFrame, least: float = 0.2) -> DataFrame:
    """The documents, all columns, whose language is known with a score of ``least`` or more.

    Learned from all documents with a lang; without any, nothing can be told
    and every document with a letter stays.
    """
    languages, table = learn(docs)
    whole = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
        F.col("text").cast("string").alias("__text"),
    )
    if not languages:
        return whole.where(F.coalesce(F.col("__text").rlike(r"\p{L}"), F.lit(False))).select("row.*")
    sent = _sent(docs.sparkSession, languages, table)
    kept = whole.mapInArrow(remote(_keep, sent, least), whole.select("row").schema)
    return kept.select("row.*")
