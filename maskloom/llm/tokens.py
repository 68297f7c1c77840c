"""Token ids of whole texts by the tokenizers library, for tasks that see the same words again and again.

The vocabularies used here never join text across a space or a line feed: both are white space to
normaliser and pre-tokenizer, composition of characters stops there, and special tokens hold none.
So the ids of a text are those of its pieces between them, one after the other, and the library has
to encode each different piece once. Vocabularies that lower-case, and end a word where Latin letters
meet marks, allow more of this (``fold``), which is tried out on the vocabulary first.
``tests/llm/test_tokens.py`` holds all of it against whole texts.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

from maskloom.llm.bpe import Words

#: Bytes of the pieces one Python worker remembers, from task to task (twice as many at most: those
#: used since they were last full, and those before), and the longest piece it does (characters).
REMEMBERED, LONGEST = 64 << 20, 48
#: What a remembered piece takes besides two bytes a character: two objects and their place.
PLACE = 192
#: Characters split at once.
SLICE = 2 << 20
#: Marks taken off the end of a word, and characters that keep a text from being lower-cased beforehand.
_MARKS = ".,;:!?|)\"-"
_BEYOND = re.compile(r"[^\t\n\r -~\xa1-ɏ]|<\|")
_SAMPLE = "Était-ce don't STOP!!! a|b, (x_y).z 'tis 12,5 \xad½ it's|we'LL Ünder_ _'s ..'re <|endoftext|> Word). x!'"


def _cut(text: str) -> Iterator[str]:
    """The text cut at spaces, so that very long texts are never held as one list of pieces."""
    at = 0
    while len(text) - at > SLICE:
        cut = text.rfind(" ", at, at + SLICE)
        if cut < 0:
            cut = text.find(" ", at + SLICE)
            if cut < 0:
                break
        yield text[at:cut]
        at = cut + 1
    yield text[at:] if at else text


class Encoder:
    """Encodes with one vocabulary file; ids come back as little-endian bytes of ``dtype``."""

    def __init__(self, path: str) -> None:
        self.words = Words(path)
        self.tokenizer = self.words.tokenizer
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code).newbyteorder("<")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        whole = array(self.code, self.tokenizer.encode(_SAMPLE, add_special_tokens=False).ids).tobytes()
        self.fold = False
        if self.ids(_SAMPLE) != whole:
            raise ValueError(f"{path} joins text across white space")
        self.fold, plain = True, _SAMPLE.replace("<|", "<")
        self.known.clear()
        self.fold = self.ids(plain) == array(self.code, self.tokenizer.encode(plain, add_special_tokens=False).ids).tobytes()
        self.known.clear()

    def ids(self, text: str | None) -> bytes:
        return next(self.batch([text]))

    def batch(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text (null: none), in order; texts are worked on together up to ``SLICE`` characters."""
        waiting: list[list[str]] = []
        size = 0
        for text in texts:
            if text and len(text) > SLICE:
                yield from self._together(waiting)
                waiting, size = [], 0
                yield b"".join(next(self._together([self._split(part)])) for part in _cut(text))
                continue
            waiting.append(self._split(text) if text else [])
            size += len(text) if text else 0
            if size > SLICE:
                yield from self._together(waiting)
                waiting, size = [], 0
        yield from self._together(waiting)

    def _split(self, text: str) -> list[str]:
        if self.fold and not _BEYOND.search(text):
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def _together(self, texts: list[list[str]]) -> Iterator[bytes]:
        known, older = self.known, self.older
        found = [list(map(known.get, pieces)) for pieces in texts]
        gaps = [[i for i, ids in enumerate(row) if ids is None] if None in row else [] for row in found]
        missing = {pieces[i] for pieces, at in zip(texts, gaps) for i in at}
        ends, parts = [], set()
        if self.fold:
            for piece in missing.difference(older):
                if piece and not piece[-1].isalnum() and (core := piece.rstrip(_MARKS)) != piece and core.isalpha() and not _BEYOND.search(core):
                    end = piece[len(core) :]
                    ends.append((piece, core, end))
                    parts.update((core, end))
            missing.difference_update([piece for piece, *_ in ends])
            missing |= parts.difference(known)
        fresh = list(missing.difference(older))
        known.update({piece: older[piece] for piece in missing.intersection(older)})
        code = self.code
        known.update(zip(fresh, [array(code, ids).tobytes() for ids in self.words.merge(fresh)]))
        known.update([(piece, known[core] + known[end]) for piece, core, end in ends])
        for pieces, row, at in zip(texts, found, gaps):
            for i in at:
                row[i] = known[pieces[i]]
            yield b"".join(row)
        missing.update([piece for piece, *_ in ends])
        for piece in [piece for piece in missing if len(piece) > LONGEST]:
            del known[piece]
            missing.remove(piece)
        self.held += len(missing) * PLACE + 2 * sum(map(len, missing))
        if self.held > REMEMBERED:
            self.known, self.older, self.held = {}, known, 0


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    return Encoder(path)
