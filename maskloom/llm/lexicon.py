"""A lexicon of words with their token ids: a minimal acyclic transducer in flat arrays, mapped into memory.

Words are UTF-8 paths; ids stand on the arcs as early as they are certain (and at ends that are no leaf), so words
that share an ending share its states and arcs. Built from sorted words in one pass: once a word leaves a prefix,
the states behind it cannot change, and each is merged with an equal one.

File: eight 64-bit counts and positions, then arrays of little-endian numbers: arcs ordered by (state, byte) with
target and output, ends with their output (-1: none), the ids of all outputs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

from maskloom.llm import store

_MAGIC = 0x31584C4D
_SECTIONS = (("arcs", "<u8"), ("targets", "<u4"), ("at", "<u4"), ("sizes", "<u2"), ("end_at", "<i8"), ("end_sizes", "<u2"), ("ids", "<u4"))
#: Words walked at once.
STEP = 16_384


class _State:
    """A state that may still change: arcs as byte -> [target, output]."""

    __slots__ = ("arcs", "end")

    def __init__(self) -> None:
        self.arcs: dict[int, list] = {}
        self.end: tuple[int, ...] | None = None


def _shared(a: Sequence[int], b: Sequence[int]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def build(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The file of (word, ids) entries; a word given twice counts as it came first in order."""
    registry: dict[tuple, int] = {}
    frozen: list[tuple] = []

    def freeze(state: _State) -> int:
        key = (state.end, tuple((byte, target, out) for byte, (target, out) in state.arcs.items()))
        number = registry.get(key)
        if number is None:
            number = registry[key] = len(frozen)
            frozen.append(key)
        return number

    path, last = [_State()], None
    for word, ids in sorted(entries):
        if word == last:
            continue
        same = _shared(word, last) if last is not None else 0
        for depth in range(len(path) - 1, same, -1):
            path[depth - 1].arcs[last[depth - 1]][0] = freeze(path.pop())
        left = tuple(ids)
        for depth in range(same):
            arc = path[depth].arcs[word[depth]]
            keep = _shared(arc[1], left)
            rest, arc[1], left = arc[1][keep:], arc[1][:keep], left[keep:]
            if rest:
                after = path[depth + 1]
                for further in after.arcs.values():
                    further[1] = rest + further[1]
                if after.end is not None:
                    after.end = rest + after.end
        for byte in word[same:]:
            path[-1].arcs[byte] = [None, left]
            left = ()
            path.append(_State())
        path[-1].end = left
        last = word
    for depth in range(len(path) - 1, 0, -1):
        path[depth - 1].arcs[last[depth - 1]][0] = freeze(path.pop())
    root = freeze(path[0])
    return _file(frozen, root)


def _file(states: list[tuple], root: int) -> bytes:
    places: dict[tuple[int, ...], int] = {}
    pool: list[int] = []

    def place(ids: tuple[int, ...]) -> int:
        if ids not in places:
            places[ids] = len(pool)
            pool.extend(ids)
        return places[ids]

    columns: dict[str, list[int]] = {name: [] for name, _ in _SECTIONS}
    for number, (end, arcs) in enumerate(states):
        columns["end_at"].append(-1 if end is None else place(end))
        columns["end_sizes"].append(len(end or ()))
        for byte, target, out in arcs:
            for name, value in (("arcs", number << 8 | byte), ("targets", target), ("at", place(out)), ("sizes", len(out))):
                columns[name].append(value)
    columns["ids"] = pool
    arrays = [np.array(columns[name], kind).tobytes() for name, kind in _SECTIONS]
    head = np.array([_MAGIC, len(states), root, len(columns["arcs"]), len(pool), 0, 0, 0], "<i8")
    return b"".join([head.tobytes(), *(a + bytes(-len(a) % 8) for a in arrays)])


class Lexicon:
    """A lexicon file ready to look words up, many at once."""

    def __init__(self, path: str) -> None:
        data = store.mapped(path)
        head = data[:64].view("<i8")
        if head[0] != _MAGIC:
            raise ValueError(f"{path} holds no lexicon")
        states, self.root, arcs, ids = (int(v) for v in head[1:5])
        counts = {"end_at": states, "end_sizes": states, "ids": ids}
        at = 64
        for name, kind in _SECTIONS:
            size = counts.get(name, arcs) * np.dtype(kind).itemsize
            setattr(self, name, data[at : at + size].view(kind))
            at += size + -size % 8
        self.lost = states

    def look_up(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether each word is there, how many ids it has, the ids of all one after the other)."""
        parts = [self._walk(words[i : i + STEP]) for i in range(0, len(words), STEP)]
        if not parts:
            return np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _walk(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        starts, bytes_ = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(coded), np.uint8)
        order = np.argsort(-sizes, kind="stable")
        starts, falling = starts[order], sizes[order]
        state = np.full(len(words), self.root, np.int64)
        longest = int(falling[0]) if len(falling) else 0
        at, out = np.zeros((len(words), longest + 1), np.int64), np.zeros((len(words), longest + 1), np.int64)
        for k in range(longest):
            live = int(np.searchsorted(-falling, -k, side="left"))
            keys = (state[:live] << 8 | bytes_[starts[:live] + k]).astype(np.uint64)
            arc = np.searchsorted(self.arcs, keys)
            arc[arc == len(self.arcs)] = 0
            there = (self.arcs[arc] == keys) if len(self.arcs) else np.zeros(live, bool)
            if not there.any():
                state[:live] = self.lost
                break
            at[:live, k], out[:live, k] = self.at[arc], np.where(there, self.sizes[arc], 0)
            state[:live] = np.where(there, self.targets[arc], self.lost)
        known = state < self.lost
        known[known] = self.end_at[state[known]] >= 0
        ends = state[known]
        at[known, longest], out[known, longest] = self.end_at[ends], self.end_sizes[ends]
        out[~known] = 0
        back = np.empty(len(words), np.int64)
        back[order] = np.arange(len(words))
        at, out = at[back].ravel(), out[back]
        flat = out.ravel()
        places = np.repeat(at - (np.cumsum(flat) - flat), flat) + np.arange(int(flat.sum()))
        return known[back], out.sum(axis=1), self.ids[places]
