"""Many strings looked for in a text by a positional index of its three-character grams.

The index of a batch of texts is one sorted array of gram hashes (each mixed with its text) and their places. Each
string is looked up by its rarest gram, and what stands around the places found is compared: hashes only choose
where to look. The work grows with the texts and the strings, not with their product.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

GRAM = 3
#: Characters of a text times its strings up to which these are looked for one by one: no index pays there.
PLAIN = 1 << 16
#: Characters indexed at once; longer texts are cut into windows that overlap by the longest string.
WINDOW = 1 << 20
_A, _B, _C = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashed(points: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """A hash of every three points in a row and their owner."""
    a, b, c = (points[i : len(points) - GRAM + 1 + i].astype(np.uint64) for i in range(GRAM))
    mixed = ((a * _A + b) * _B + c) * _C + owners.astype(np.uint64)
    return mixed ^ (mixed >> np.uint64(29))


def windows(text: str, longest: int) -> Iterator[tuple[str, bool, bool]]:
    """(window, whether it is the first, whether it is the last) of a text."""
    step = max(WINDOW, longest + 2)
    at = 0
    while True:
        end = at + step + longest + 2
        yield text[at:end], at == 0, end >= len(text)
        if end >= len(text):
            return
        at += step


def _word(char: str) -> bool:
    return char.isalnum()


def _fits(text: str, at: int, needle: str, alone: bool, first: bool, last: bool) -> bool:
    end = at + len(needle)
    if not text.startswith(needle, at) or (at == 0 and not first) or (end == len(text) and not last):
        return False
    return not alone or not ((at and _word(text[at - 1])) or (end < len(text) and _word(text[end])))


def _short(text: str, needle: str, alone: bool, first: bool, last: bool) -> bool:
    at = text.find(needle)
    while at >= 0:
        if _fits(text, at, needle, alone, first, last):
            return True
        at = text.find(needle, at + 1)
    return False


def _together(texts: list[tuple[str, bool, bool]], needles: list[tuple[int, str, bool]]) -> np.ndarray:
    """Which of (text number, string, only as words of its own) are in their texts."""
    found = np.zeros(len(needles), bool)
    points = [_points(t) for t, _, _ in texts]
    starts = np.cumsum([0] + [len(p) for p in points])
    row = np.concatenate(points) if points else np.zeros(0, np.uint32)
    indexed = [i for i, (_, needle, _) in enumerate(needles) if len(needle) >= GRAM]
    for i in set(range(len(needles))).difference(indexed):
        owner, needle, alone = needles[i]
        text, first, last = texts[owner]
        found[i] = bool(needle) and _short(text, needle, alone, first, last)
    if not indexed or len(row) < GRAM:
        return found
    owners = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    hashes = _hashed(row, owners[: len(row) - GRAM + 1])
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    coded = [_points(needles[i][1]) for i in indexed]
    sizes = np.array([len(c) - GRAM + 1 for c in coded])
    # Grams that run from one string into the next are left out.
    inside = np.concatenate([np.arange(len(c)) <= len(c) - GRAM for c in coded])[: sum(map(len, coded)) - GRAM + 1]
    grams = _hashed(np.concatenate(coded), np.repeat([needles[i][0] for i in indexed], [len(c) for c in coded])[: len(inside)])[inside]
    low, high = np.searchsorted(hashes, grams, "left"), np.searchsorted(hashes, grams, "right")
    owner_of = np.repeat(np.arange(len(indexed)), sizes)
    ranked = np.lexsort((high - low, owner_of))
    rarest = ranked[np.cumsum(sizes) - sizes]
    offsets = rarest - (np.cumsum(sizes) - sizes)
    for i, gram, offset in zip(indexed, rarest.tolist(), offsets.tolist()):
        owner, needle, alone = needles[i]
        text, first, last = texts[owner]
        base = int(starts[owner]) + offset
        found[i] = any(
            place >= base and _fits(text, place - base, needle, alone, first, last) for place in order[low[gram] : high[gram]].tolist()
        )
    return found


def find(texts: Sequence[str | None], needles: Sequence[Sequence[tuple[str, bool]]]) -> list[list[bool]]:
    """For every text which of its own strings it holds; (string, True) counts as words of its own only."""
    out = [[False] * len(some) for some in needles]
    waiting: list[tuple[str, bool, bool]] = []
    asked: list[tuple[int, str, bool]] = []
    places: list[tuple[int, int]] = []
    size = 0

    def look() -> None:
        nonlocal waiting, asked, places, size
        for (i, j), there in zip(places, _together(waiting, asked)):
            out[i][j] = out[i][j] or bool(there)
        waiting, asked, places, size = [], [], [], 0

    for i, (text, some) in enumerate(zip(texts, needles)):
        if not text or not some:
            continue
        if len(text) * len(some) <= PLAIN:
            out[i] = [bool(n) and _short(text, n, alone, True, True) for n, alone in some]
            continue
        for window in windows(text, max(len(n) for n, _ in some)):
            owner = len(waiting)
            waiting.append(window)
            asked += [(owner, n, alone) for n, alone in some]
            places += [(i, j) for j in range(len(some))]
            size += len(window[0])
            if size >= WINDOW:
                look()
    if waiting:
        look()
    return out
