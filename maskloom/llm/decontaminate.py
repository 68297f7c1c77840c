"""Benchmark passages in documents, by Aho-Corasick automata over the items' word windows.

Texts and items are normalised alike: ASCII letters in lower case, every other ASCII sign except
digits becomes a gap, words are what is left. An item's windows are all its runs of ``window`` words
(an item with fewer words, but not none, is one window). One automaton of all windows reads a
normalised text once; a hit's place in it gives the words it covers and, through the words' places,
the characters of the original.

The windows are dealt over blocks of at most ``block_chars`` characters, the proven bound of what
is sent to the tasks at once; texts pass one automaton after the other, each in its own step.

Cases: null or empty texts have no words and no hits; items without words are skipped; an item with
a null id marks words but is not listed; equal items are each listed; repeated rows are each
reported; an empty benchmark finds nothing; other columns are left alone, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.store import lean

#: What each byte of a UTF-8 text becomes; bytes of other scripts stay, they are parts of words.
_BYTES = bytes(
    b if b > 0x7F or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Characters of windows in one automaton: some 100 bytes of memory each in a task.
BLOCK_CHARS = 2_000_000

REPORT = (
    "doc_id long, n_words long, n_hit long, items array<string>, hits array<struct<start: int, end: int>>, "
    "spans array<struct<start: int, end: int>>"
)
_PAIRS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_BYTES).split() if text else []


def windows_of(text: str | None, window: int) -> set[bytes]:
    words = words_of(text)
    return {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} if words else set()


def _blocks(benchmark: DataFrame, window: int, block_chars: int) -> list:
    """Broadcasts of {window: item ids}, each bounded; items come to the driver one by one."""
    spark, out, block, size = benchmark.sparkSession, [], {}, 0
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    for item, text in items.toLocalIterator():
        for found in windows_of(text, window):
            if found not in block:
                if size + len(found) > block_chars and block:
                    out.append(spark.sparkContext.broadcast(block))
                    block, size = {}, 0
                block[found] = ()
                size += len(found)
            if item is not None:
                block[found] += (item,)
    return [*out, spark.sparkContext.broadcast(block)]


_built: dict = {}


def _automaton(block) -> ahocorasick.Automaton:
    """The block's automaton, built once per Python worker."""
    windows = block.value
    if _built.get("of") is not windows:
        made = ahocorasick.Automaton()
        for found, items in windows.items():
            made.add_word(f" {found.decode('latin-1')} ", (found.count(b" ") + 1, items))
        made.make_automaton()
        _built.update(of=windows, made=made)
    return _built["made"]


def _scan(automaton: ahocorasick.Automaton, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, word intervals [start, end) covered by windows (merged), items."""
    words = words_of(text)
    if not words or not len(automaton):
        return len(words), [], set()
    line = b" " + b" ".join(words) + b" "
    found = [(end, *hit) for end, hit in automaton.iter(line.decode("latin-1"))]
    if not found:
        return len(words), [], set()
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    lasts = np.searchsorted(gaps, [f[0] for f in found])
    return len(words), merged((int(b) - n, int(b)) for b, (_, n, _) in zip(lasts, found)), {i for f in found for i in f[2]}


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _spans(text: str | None, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where the words of merged intervals stand in the original text, in characters."""
    if not hits:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in hits]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: its words, words hit, items, and what is hit in words and in characters."""
    blocks = _blocks(benchmark, window, block_chars)
    middle = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("hits", _PAIRS), ("items", pa.list_(pa.string()))])
    report = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
        ("hits", _PAIRS), ("spans", _PAIRS),
    ])

    def step(block, last: bool):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(block)
            for batch in batches:
                rows = []
                for doc_id, text, hits, items in zip(*(c.to_pylist() for c in batch.columns)):
                    n, more, names = _scan(automaton, text)
                    hits = merged([*((h["start"], h["end"]) for h in hits), *more])
                    row = {"doc_id": doc_id, "hits": pairs(hits), "items": sorted({*items, *names})}
                    if last:
                        row |= {"n_words": n, "n_hit": sum(b - a for a, b in hits), "spans": pairs(_spans(text, hits))}
                    else:
                        row["text"] = text
                    rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, report if last else middle)

        return lean(scan)

    def pairs(spans: list[tuple[int, int]]) -> list[dict]:
        return [{"start": a, "end": b} for a, b in spans]

    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.array().cast("array<struct<start: int, end: int>>").alias("hits"), F.array().cast("array<string>").alias("items"),
    )
    for block in blocks[:-1]:
        out = out.mapInArrow(step(block, False), out.schema)
    return out.mapInArrow(step(blocks[-1], True), REPORT)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, all columns as they are."""

    def step(block):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(block)
            for batch in batches:
                texts = batch.column("text").to_pylist()
                yield batch.filter(pa.array([not _scan(automaton, t)[1] for t in texts], pa.bool_()))

        return lean(keep)

    for block in _blocks(benchmark, window, block_chars):
        docs = docs.mapInArrow(step(block), docs.schema)
    return docs
