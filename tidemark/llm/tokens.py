"""Token ids of texts, by the public tokenizers library and with a bounded memo."""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np

from tidemark.llm.common import pieces

#: Words a worker remembers; beyond it, it forgets all of them and starts anew.
#: This bounds memory and changes no result.
MEMO_WORDS = 800_000

#: A longer text is encoded in parts of about so many characters.
PART_CHARS = 1 << 20

#: Marks a word that begins a text and so has no space before it.
_FIRST = "\ufdd0"

#: White space other than the space itself.
_OTHER_SPACE = re.compile(r"[^\S ]|\u180e")
_CUT = re.compile(r"(?<![\s\u180e]) (?![\s\u180e])")
_SPACE = re.compile(r"[\s\u180e]")


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _safe(text: str) -> bool:
    """Whether every space alone separates two characters that are not white space."""
    if text[0] == " " or text[-1] == " " or "  " in text or _FIRST in text:
        return False
    return not any(
        " " in text[max(found.start() - 1, 0) : found.end() + 1]
        for found in _OTHER_SPACE.finditer(text)
    )


class Encoder:
    """Encodes texts exactly as the tokenizer does, each distinct word once.

    The byte-level rule begins a new piece at every single space between two
    characters that are not white space, so a text may be cut there and its
    parts encoded alone. A part with other spaces (doubled, or beside a line
    break) is encoded whole, and so is one that holds an added token. Strings of
    special tokens in a text are those tokens, as the library has it, or ordinary
    text if ``plain_specials``.
    """

    def __init__(self, path: str, plain_specials: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        added = [
            token.content
            for token in self.tokenizer.get_added_tokens_decoder().values()
            if token.content and not (plain_specials and token.special)
        ]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.reach = max(map(len, added), default=0) + 1
        self.joined = not any(map(_SPACE.search, added))  # words side by side make no added token
        size = self.tokenizer.get_vocab_size()
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.spaced = np.zeros(size, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.spaced[number] = token.startswith("\u0120")  # the mark of a space
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat = np.empty(1 << 16, self.kind)
        self.ends = np.zeros(1 << 16, np.int64)  # ends[i + 1] is where word i stops
        self.used = 0

    def _holds_added(self, text: str) -> bool:
        return self.added is not None and self.added.search(text) is not None

    def _parts(self, text: str):
        """The text cut at spaces where the tokenizer begins a new piece anyway, not near an added token."""
        begin = 0
        while len(text) - begin > PART_CHARS:
            cut = _CUT.search(text, begin + PART_CHARS)
            while cut and self._holds_added(text[max(0, cut.start() - self.reach) : cut.end() + self.reach]):
                cut = _CUT.search(text, cut.end())
            if cut is None:
                break
            yield text[begin : cut.start()]
            begin = cut.start()
        yield text[begin:]

    def _plain(self, text: str) -> np.ndarray:
        return np.array(
            self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind
        )

    def _keep(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        number = len(self.memo)
        while number + len(words) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.ends[number + 1 : number + len(words) + 1] = self.used + ends
        self.memo.update(zip(words, range(number, number + len(words)), strict=True))
        self.used += len(ids)

    def _learn(self, words: set[str]) -> None:
        alone = [word for word in words if word[0] == _FIRST]
        later = [word for word in words if word[0] != _FIRST]
        if not self.joined:
            alone, later = alone + later, []
        if later:
            # Each has one space, in front of it, so tokens that begin with one are word starts.
            ids = self._plain(" " + " ".join(later))
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) == len(later):
                self._keep(later, ids, np.append(starts[1:], len(ids)))
            else:
                alone += later
        for word in alone:
            ids = self._plain(word[1:] if word[0] == _FIRST else " " + word)
            self._keep([word], ids, np.array([len(ids)]))

    def encode_many(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each closed by ``end`` if given, and where each stops."""
        plan, words = [], []  # of each part: its ids, or how many words it has
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            for part in self._parts(text) if text else ():
                later = part[0] == " " and len(part) < len(text)  # a part begins at its space
                if not _safe(part[1:] if later else part) or self._holds_added(part):
                    plan.append((i, self._plain(part)))
                    continue
                cut = part[1:].split(" ") if later else part.split(" ")
                if not later:
                    cut[0] = _FIRST + cut[0]
                words += cut
                plan.append((i, len(cut)))
            if end is not None:
                plan.append((i, np.array([end], self.kind)))
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        at = np.fromiter(map(self.memo.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            unknown = [words[i] for i in missing.tolist()]
            self._learn(set(unknown))
            at[missing] = np.fromiter(map(self.memo.__getitem__, unknown), np.int64, len(unknown))
        lengths = self.ends[at + 1] - self.ends[at]
        stops = np.concatenate([[0], np.cumsum(lengths)])
        own = self.flat[
            np.repeat(self.ends[at] - stops[:-1], lengths) + np.arange(stops[-1])
        ]
        out, word = [], 0
        for i, part in plan:
            if isinstance(part, int):
                part, word = own[stops[word] : stops[word + part]], word + part
            out.append(part)
            counts[i] += len(part)
        return (np.concatenate(out) if out else own), np.cumsum(counts)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain_specials: bool = False) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    key = (path, plain_specials)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, plain_specials)
    return _ENCODERS[key]


def encoded(path: str, texts: list[str], end: int | None = None, plain_specials: bool = False):
    """The ids of each text in turn; few texts are held encoded at a time."""
    coder = encoder(path, plain_specials)
    for begin, stop in pieces([len(text) for text in texts], 1 << 20):
        ids, ends = coder.encode_many(texts[begin:stop], end)
        yield from np.split(ids, ends[:-1])
