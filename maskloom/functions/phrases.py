"""Phrases of a list found in one pass over a text, in the row.

The list becomes an automaton over words, laid out as sorted arrays: hashes of the words, and edges
(state, word) -> state, looked up by binary search for all words of a batch of texts at once. A word
outside the list ends every search at once, so the work grows with the texts and the phrases met.
The arrays are broadcast, so a list may hold ``MOST`` phrases and ``MOST_CHARACTERS`` at most; larger ones
are for ``detect.detect_dictionary``'s join.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions import spans as S
from maskloom.schemas import SPANS

MOST, MOST_CHARACTERS = 500_000, 32 << 20
_WORD, _ASCII_WORD = regex.compile(r"[\p{L}\p{N}]+"), re.compile("[A-Za-z0-9]+")

_ALNUM = np.zeros(256, np.int8)
_ALNUM[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = 1


def _hashes(words: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for w in words], np.uint64)


@dataclass(frozen=True)
class Automaton:
    """Words by hash, edges by (state, word), and for each state the phrase that ends there (-1: none)."""

    words: np.ndarray
    edges: np.ndarray
    targets: np.ndarray
    ends: np.ndarray
    phrases: list[tuple[str, ...]]
    categories: list[str]


def compile_phrases(listed: list[tuple[str, str]]) -> Automaton:
    """The automaton of (phrase, category) pairs; a phrase of several categories counts as the least."""
    known: dict[tuple[str, ...], str] = {}
    for phrase, category in listed:
        words = tuple(w.lower() for w in _WORD.findall(phrase or ""))
        if words and category is not None:
            known[words] = min(category, known.get(words, category))
    vocabulary = list(dict.fromkeys(w for words in known for w in words))
    hashes = _hashes(vocabulary)
    order = np.argsort(hashes, kind="stable")
    number = dict(zip([vocabulary[i] for i in order], range(len(order))))
    edges: dict[int, int] = {}
    ends, phrases = [-1], sorted(known)
    for place, words in enumerate(phrases):
        state = 0
        for word in words:
            edge = state << 32 | number[word]
            if edge not in edges:
                edges[edge] = len(ends)
                ends.append(-1)
            state = edges[edge]
        ends[state] = place
    keys = np.array(sorted(edges), np.uint64)
    return Automaton(
        hashes[order], keys, np.array([edges[int(k)] for k in keys], np.int64), np.array(ends, np.int64), phrases,
        [known[p] for p in phrases],
    )


def _placed(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts in lower case and in a row, where each starts and ends in its text, and how many a text has."""
    if all(t is None or t.isascii() for t in texts):
        # One search for the words of all texts, which a line feed keeps apart; their places out of the bytes.
        row = "\n".join(t or "" for t in texts)
        edges = np.diff(_ALNUM[np.frombuffer(row.encode(), np.uint8)], prepend=0, append=0)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        first = np.concatenate([[0], np.cumsum([len(t or "") + 1 for t in texts])])
        sizes = np.diff(np.searchsorted(starts, first))
        base = np.repeat(first[:-1], sizes)
        return _ASCII_WORD.findall(row.lower()), starts - base, ends - base, sizes
    found = [list(_WORD.finditer(t)) if t else [] for t in texts]
    flat = list(chain.from_iterable(found))
    starts, ends = (np.array([f(m) for m in flat], np.int64) for f in (regex.Match.start, regex.Match.end))
    return [m.group().lower() for m in flat], starts, ends, np.array([len(some) for some in found], np.int64)


def find_phrases(automaton: Automaton, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
    """(start, end, category) of every phrase in every text, also inside others, in order of place."""
    found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    if not len(automaton.edges):
        return found
    words, starts, ends, sizes = _placed(texts)
    distinct = list(set(words))
    hashes = _hashes(distinct)
    at = np.minimum(np.searchsorted(automaton.words, hashes), len(automaton.words) - 1)
    number = dict(zip(distinct, np.where(automaton.words[at] == hashes, at, -1).tolist()))
    # The words of all texts in one row, with a word that no list has behind each text.
    stops = np.cumsum(sizes)
    row = np.insert(np.array([number[w] for w in words], np.int64), stops, -1)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    start = np.flatnonzero(row >= 0)
    state, depth = np.zeros(len(start), np.int64), 0
    while len(start):
        word = row[start + depth]
        keys = (state << 32 | word).astype(np.uint64)
        edge = np.minimum(np.searchsorted(automaton.edges, keys), len(automaton.edges) - 1)
        on = (word >= 0) & (automaton.edges[edge] == keys)
        start, state, depth = start[on], automaton.targets[edge[on]], depth + 1
        phrase = automaton.ends[state]
        met = np.flatnonzero(phrase >= 0)
        # Places in the row less the texts before are places among the words.
        text = owner[start[met]]
        at = start[met] - text
        spans = zip(text.tolist(), at.tolist(), phrase[met].tolist(), starts[at].tolist(), ends[at + depth - 1].tolist())
        for i, j, k, begin, end in spans:
            # Hashes stand for words until here; now the words themselves are compared.
            if tuple(words[j : j + depth]) == automaton.phrases[k]:
                found[i].append((begin, end, automaton.categories[k]))
    return [sorted(spans) for spans in found]


def listed_phrases(gazetteer: DataFrame) -> list[tuple[str, str]] | None:
    """The rows of a (phrase, category) table, or None where they are more than an automaton may hold."""
    size = gazetteer.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("phrase")), F.lit(0))).first()
    if size[0] > MOST or size[1] > MOST_CHARACTERS:
        return None
    return [tuple(r) for r in gazetteer.select("phrase", "category").collect()]


def phrase_automaton(gazetteer: DataFrame) -> Broadcast[Automaton] | None:
    """The automaton of a (phrase, category) table, broadcast; None if the table is too large."""
    listed = listed_phrases(gazetteer)
    return None if listed is None else gazetteer.sparkSession.sparkContext.broadcast(compile_phrases(listed))


def phrase_spans(gazetteer: DataFrame):
    """A function from a text column to the spans of the phrases of a (phrase, category) table; None if it is too large."""
    automaton = phrase_automaton(gazetteer)
    if automaton is None:
        return None
    kind = pa.struct([
        pa.field("start", pa.int32()), pa.field("end", pa.int32()), pa.field("category", pa.string()),
        pa.field("surface", pa.string()), pa.field("priority", pa.int32()),
    ])

    @F.arrow_udf(SPANS)
    def found(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        hits = find_phrases(automaton.value, values)
        sizes = np.concatenate([[0], np.cumsum([len(h) for h in hits])]).astype(np.int32)
        rows = [
            {"start": a, "end": b, "category": c, "surface": text[a:b], "priority": S.DETECTED}
            for text, some in zip(values, hits) for a, b, c in some
        ]
        return pa.ListArray.from_arrays(pa.array(sizes), pa.array(rows, kind))

    # So the planner leaves the search in a projection of its own and does not copy it where its result is used.
    once = found.asNondeterministic()

    def spans(text: Column) -> Column:
        return F.coalesce(once(text), S.no_spans())

    return spans
