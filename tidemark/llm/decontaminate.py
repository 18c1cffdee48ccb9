"""Documents that hold passages of benchmark items, by one Aho-Corasick automaton.

Words are runs of characters other than 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F after
A-Z are lower-cased. A pattern is a run of :data:`WINDOW` words of an item, or
all words of an item that has fewer. A text is normalised to its words with one
space between and around, scanned once, and every occurrence of every pattern
marks its words as hit. Word numbers lead back to places in the original text.

Patterns are cut in tasks, grouped with their items and dealt by a hash to blocks
of about :data:`BLOCK_BYTES`, which lie in the shared folder; neither patterns nor
items pass through the driver. Each block is one automaton of bounded size (some
45 bytes of memory a byte of patterns), built by the workers that read it. Usual
benchmarks make one block. A worker holds one automaton, so where there are more
it builds them in turn, each once for :data:`PASS_BYTES` of documents.

Cases: a null text has no words; items without words match nothing; items with
equal windows are all named; repeated documents each have a row; a repeated
item_id counts once; a null item_id is not named but its passages are hit. An
empty benchmark leaves every document clean. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, prepare, remote
from tidemark.session import folder_store, list_folder, materialize, scratch_path, shared_folder

WINDOW = 10
BLOCK_BYTES = 8 << 20
PASS_BYTES = 32 << 20
#: Patterns given out together.
BATCH = 8192

_TABLE = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A
    else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80
    else 0x20
    for byte in range(256)
)
_KEEP = np.frombuffer(_TABLE, np.uint8) != 0x20


def words(text: str) -> list[bytes]:
    """The words of a text, as UTF-8."""
    return text.encode().translate(_TABLE).split()


def windows(text: str, size: int = WINDOW) -> set[bytes]:
    """The patterns of an item, with a space at either end."""
    own = words(text)
    if not own:
        return set()
    return {b" %s " % b" ".join(own[i : i + size]) for i in range(max(1, len(own) - size + 1))}


def _patterns(batches, size: int):
    for batch in batches:
        found, named = [], []
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            own = windows(text or "", size)
            found += own
            named += [item] * len(own)
        for begin in range(0, len(found), BATCH):
            part = slice(begin, begin + BATCH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[part], pa.binary()), pa.array(named[part], pa.int64())], ["pattern", "item"]
            )


def _blocks(benchmark: DataFrame, size: int) -> list[tuple[str, list[str]]]:
    """Writes the patterns with their items in blocks; a name and the files of each block."""
    spark = benchmark.sparkSession
    prepare(spark)
    items = own_columns(benchmark, item_id="long", text="string").distinct()
    patterns = materialize(
        items.mapInArrow(remote(_patterns, size), "pattern binary, item long")
        .groupBy("pattern")
        .agg(F.collect_set("item").alias("items")),
        "patterns",
    )
    held = F.length("pattern") + 8 + 8 * F.size("items")
    number = -(-(patterns.agg(F.sum(held)).first()[0] or 0) // BLOCK_BYTES)
    if not number:
        return []
    path = scratch_path(spark, "blocks")
    block = F.pmod(F.xxhash64("pattern"), F.lit(number)).alias("block")
    patterns.select("*", block).repartition(number, "block").write.partitionBy("block").parquet(path)
    folder = shared_folder(spark, path)
    out = []
    for own in list_folder(spark, path):
        name = own.rstrip("/").rsplit("/", 1)[1]
        if name.startswith("block="):
            files = [file.rsplit("/", 1)[1] for file in list_folder(spark, own)]
            out.append((f"{folder}/{name}", sorted(file for file in files if file.endswith(".parquet"))))
    return sorted(out)


_AUTOMATA: dict[str, object] = {}


def _automaton(folder: str, files: list[str]):
    """This worker's automaton of a block; one block is kept."""
    if folder not in _AUTOMATA:
        import ahocorasick

        _AUTOMATA.clear()
        machine = ahocorasick.Automaton()
        store, root = folder_store(folder)
        for name in files:
            with store.open_input_file(f"{root}/{name}") as file:
                block = pq.ParquetFile(file).read(["pattern", "items"])
            for pattern, items in zip(block.column("pattern").to_pylist(), block.column("items").to_pylist(), strict=True):
                # Bytes as characters of one byte: places are byte places.
                machine.add_word(pattern.decode("latin-1"), (len(pattern), tuple(items)))
        machine.make_automaton()
        _AUTOMATA[folder] = machine
    return _AUTOMATA[folder]


def normalised(text: str) -> bytes:
    """The words of a text with one space between and around; empty without words."""
    own = words(text)
    return b" %s " % b" ".join(own) if own else b""


def find(machine, text: bytes) -> tuple[list[tuple[int, int]], set[int]]:
    """Runs of hit words (first, after the last) of a normalised text, merged, and the items found."""
    found, items = [], set()
    for last, (length, named) in machine.iter(text.decode("latin-1")):
        found.append((last - length + 1, last))
        items.update(named)
    if not found:
        return [], items
    # The space before word i is the i-th space; a pattern begins and ends with one.
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
    places = np.searchsorted(spaces, np.array(sorted(found)))
    runs: list[tuple[int, int]] = []
    for first, after in places.tolist():
        if runs and first <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(after, runs[-1][1]))
        else:
            runs.append((first, after))
    return runs, items


def spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where runs of words lie in the original text, in characters."""
    if not runs:
        return []
    codes = np.frombuffer(text.encode(), np.uint8)
    inside = np.concatenate([[False], _KEEP[codes], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    character = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])
    return [(int(character[turns[2 * first]]), int(character[turns[2 * after - 1]])) for first, after in runs]


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, after in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(after, out[-1][1]))
        else:
            out.append((first, after))
    return out


FOUND = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "items array<long>, spans array<struct<start: long, stop: long>>"
)


def _search(texts: list[str], blocks) -> list[tuple[int, list[tuple[int, int]], set[int]]]:
    """Number of words, hit runs and items of each text; one automaton after the other."""
    plain = [normalised(text) for text in texts]
    out = [(max(0, text.count(b" ") - 1), [], set()) for text in plain]
    for folder, files in blocks:
        machine = _automaton(folder, files)
        for i, (number, runs, items) in enumerate(out):
            if number:
                more, named = find(machine, plain[i])
                out[i] = (number, _merged(runs + more) if runs else more, items | named)
    return out


def _searched(batches, column: str, blocks):
    """Batches with their texts and what was found in them, searched some PASS_BYTES at a time."""

    def passed(held):
        texts = [[text or "" for text in batch.column(column).to_pylist()] for batch in held]
        found = iter(_search([text for part in texts for text in part], blocks))
        for batch, part in zip(held, texts, strict=True):
            yield batch, part, [next(found) for _ in part]

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PASS_BYTES:
            yield from passed(held)
            held, size = [], 0
    if held:
        yield from passed(held)


def _scan(batches, blocks):
    for batch, texts, found in _searched(batches, "text", blocks):
        rows = []
        for doc_id, text, (number, runs, items) in zip(
            batch.column("doc_id").to_pylist(), texts, found, strict=True
        ):
            rows.append(
                {
                    "doc_id": doc_id,
                    "n_words": number,
                    "n_hit": sum(after - first for first, after in runs),
                    "n_items": len(items),
                    "items_sha256": hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(),
                    "contaminated": bool(runs),
                    "items": sorted(items),
                    "spans": [{"start": begin, "stop": stop} for begin, stop in spans(text, runs)],
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
        ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("items", pa.list_(pa.int64())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ]
)


def _clean(batches, blocks):
    for batch, _, found in _searched(batches, "__text", blocks):
        keep = pa.array([not runs for _, runs, _ in found], pa.bool_())
        yield batch.drop_columns(["__text"]).filter(keep)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: its words, hit words, items with occurring windows, and places.

    One pass over the documents and no shuffle of them.
    """
    blocks = _blocks(benchmark, size)
    return own_columns(docs, doc_id="long", text="string").mapInArrow(remote(_scan, blocks), FOUND)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents, all columns, that hold no window of any item."""
    blocks = _blocks(benchmark, size)
    whole = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), F.col("text").cast("string").alias("__text"))
    kept = whole.mapInArrow(remote(_clean, blocks), whole.select("row").schema)
    return kept.select("row.*")
