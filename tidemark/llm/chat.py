"""Conversations formatted for training, as bytes assembled column by column.

A turn becomes ``<|im_start|>`` role, a line break, its text, ``<|im_end|>`` and
a line break. Control strings inside roles and texts get a backslash after their
first character (one more if there are some already), which is taken away again
when the output is read: no text can end its turn or begin another.

A batch of turns is formatted at once: the lengths of all segments (opening,
role, break, text, closing) give their places in the output by a running sum,
and each column is copied there with one scatter of its bytes.

The loss mask is a list of byte ranges of the formatted text: the texts of
assistant turns, without their marks.

Cases: a null text or role is empty; rows of a conversation go by turn (nulls
first), then role and text; rows without conv_id are one conversation; repeated
rows are turns of their own. A conversation longer than :data:`PART_BYTES` is
given in several parts, in order, cut between turns; a turn is never cut. An
empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, partitions, prepare, remote

#: The marks of this template, and others that models are known to obey.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROLS = (OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

LEARNED = "assistant"
PART_BYTES = 16 << 20

_TAILS = "|".join(re.escape(text[1:]) for text in sorted(CONTROLS, key=len, reverse=True))
_ESCAPE = rf"([<\[])(\\*)({_TAILS})"
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_TAILS})")
_TURN = re.compile(rf"{re.escape(OPEN)}(.*?){re.escape(CLOSE)}\n", re.DOTALL)

FORMATTED = "conv_id long, part int, turns long, text string, loss array<struct<start: long, stop: long>>"


def escape(texts: pa.Array) -> pa.Array:
    """A string column with its control strings made harmless."""
    return pc.replace_substring_regex(texts, _ESCAPE, r"\1\\\2\3")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings in a row and each one's length."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], np.diff(offsets)


def _scatter(out: np.ndarray, places: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> None:
    """Copy consecutive pieces of ``data`` to their places in ``out``."""
    begins = np.cumsum(lengths) - lengths
    out[np.repeat(places - begins, lengths) + np.arange(len(data))] = data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted turns in one buffer; where each stops, and where its text begins and stops."""
    role, role_size = _bytes(_line(escape(roles)))
    text, text_size = _bytes(escape(texts))
    opening, between, closing = (np.frombuffer(mark.encode(), np.uint8) for mark in (OPEN, "\n", CLOSE + "\n"))
    sizes = len(opening) + role_size + len(between) + text_size + len(closing)
    stops = np.cumsum(sizes)
    at = stops - sizes
    buffer = pa.allocate_buffer(int(stops[-1]) if len(stops) else 0)
    out = np.frombuffer(buffer, np.uint8)
    n = len(sizes)
    _scatter(out, at, np.tile(opening, n), np.full(n, len(opening)))
    at = at + len(opening)
    _scatter(out, at, role, role_size)
    at = at + role_size
    _scatter(out, at, np.tile(between, n), np.full(n, len(between)))
    begins = at + len(between)
    _scatter(out, begins, text, text_size)
    at = begins + text_size
    _scatter(out, at, np.tile(closing, n), np.full(n, len(closing)))
    return buffer, stops, begins, at


def _line(roles: pa.Array) -> pa.Array:
    """A role stands in one line: its backslashes and line breaks are written as two characters."""
    return pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n")


def _unline(role: str) -> str:
    return re.sub(r"\\(.)", lambda found: "\n" if found[1] == "n" else found[1], role)


def turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a formatted text."""
    out, at = [], 0
    for found in _TURN.finditer(text):
        if found.start() != at:
            raise ValueError(f"no turn begins at {at}")
        role, _, content = found[1].partition("\n")
        out.append((unescape(_unline(role)), unescape(content)))
        at = found.end()
    if at != len(text):
        raise ValueError(f"no turn begins at {at}")
    return out


def _format(batches):
    """Rows sorted by conversation to parts; what may go on in the next batch is held back."""
    held, part, going = None, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        conv = rows.column("conv_id").to_pylist()
        if part and (conv[0],) != going:
            part = 0
        last = conv[-1]
        begin = len(conv)
        while begin and conv[begin - 1] == last:
            begin -= 1
        if begin:
            yield from _parts(rows.slice(0, begin), part)
            part = 0
        held = rows.slice(begin).combine_chunks()
        if held.nbytes >= PART_BYTES:
            yield from _parts(held, part)
            held, part, going = held.slice(0, 0), part + 1, (last,)
    if held is not None and len(held):
        yield from _parts(held, part)


def _parts(rows: pa.Table, first: int):
    """One row for each run of equal conv_id; the first run continues with part ``first``."""
    conv = rows.column("conv_id").to_pylist()
    roles, texts = (
        pc.fill_null(rows.column(name).combine_chunks().cast(pa.large_string()), "") for name in ("role", "text")
    )
    buffer, stops, begins, ends = assemble(roles, texts)
    cuts = [i for i in range(1, len(conv)) if conv[i] != conv[i - 1]]
    runs = list(zip([0, *cuts], [*cuts, len(conv)], strict=True))
    from_ = np.array([0 if not i else stops[i - 1] for i, _ in runs], np.int64)
    offsets = np.append(from_, stops[-1])
    formatted = pa.Array.from_buffers(pa.large_string(), len(runs), [None, pa.py_buffer(offsets), buffer])
    learned = pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)
    loss = [
        [
            {"start": int(begins[i] - base), "stop": int(ends[i] - base)}
            for i in range(begin, stop)
            if learned[i]
        ]
        for (begin, stop), base in zip(runs, from_, strict=True)
    ]
    for j, (begin, stop) in enumerate(runs):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([conv[begin]], pa.int64()),
                pa.array([first if not j else 0], pa.int32()),
                pa.array([stop - begin], pa.int64()),
                formatted.slice(j, 1).cast(pa.string()),
                pa.array([loss[j]], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            ],
            ["conv_id", "part", "turns", "text", "loss"],
        )


def format_conversations(rows: DataFrame) -> DataFrame:
    """Formatted conversations with their loss mask: conv_id, part, turns, text, loss.

    Rows meet by conv_id and stream through their task in order; a task holds
    one part of one conversation besides its batch.
    """
    prepare(rows.sparkSession)
    return (
        own_columns(rows, conv_id="long", turn="long", role="string", text="string")
        .repartition(partitions(rows.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(remote(_format), FORMATTED)
    )


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digest(batches):
    """Digests of conversations from their parts in order."""
    now, number, said, learned, chars, size = None, 0, None, None, 0, 0
    rows: list[tuple] = []

    def row() -> tuple:
        return now[0], number, said.hexdigest(), chars, learned.hexdigest(), size

    for batch in batches:
        for conv, text, loss in zip(
            *(batch.column(name).to_pylist() for name in ("conv_id", "text", "loss")), strict=True
        ):
            if now is None or now[0] != conv:
                if now is not None:
                    rows.append(row())
                now, number, said, learned, chars, size = (conv,), 0, hashlib.sha256(), hashlib.sha256(), 0, 0
            size += len(text)
            for role, content in turns(text):
                said.update(f"{role}\n{content}\n".encode())
                number += 1
            data = text.encode()
            for span in loss:
                content = unescape(data[span["start"] : span["stop"]].decode())
                learned.update(content.encode())
                chars += len(content)
        yield _digests(rows)
        rows = []
    if now is not None:
        yield _digests([row()])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from them, as digests."""
    prepare(formatted.sparkSession)
    return (
        formatted.select("conv_id", "part", "text", "loss")
        .repartition(partitions(formatted.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", "part")
        .select("conv_id", "text", "loss")
        .mapInArrow(remote(_digest), DIGESTS)
    )
