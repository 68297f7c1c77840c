"""Language of whole texts by prediction by partial matching over bytes.

For each language the bytes of its training texts form a context tree: how often each byte followed
each context of 0 to ``order`` bytes. With the counts frozen, a byte costs -log2 c/(n+d) in the longest known
context where it was seen (c times, among n bytes of d kinds), after an escape of -log2 d/(n+d) in
each longer known one; a byte never seen costs 8 bits at the end. The language with the shortest code for
the whole text is the answer, its score is its share of 2^-length over all languages.

The trees of all languages are merged into tables: per n-gram seen anywhere its full cost in every
language (float32), per context its escapes. A text is one array of bytes that is looked up
order by order, longest first.

Training takes at most ``sample`` labelled documents of each language (the bound; those with the
smallest hash), whole texts. Prediction covers every byte of every text; a text is folded to lower
case for both.

Cases: a null text or one without a letter is ``und`` with score 0; a tie goes to the language
that sorts first; without training rows everything is ``und``; repeated rows are predicted each;
other columns are left alone, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.llm.store import lean

UNKNOWN = "und"
ORDER, SAMPLE = 3, 200
#: Positions looked up at once.
BLOCK = 1 << 17
_LETTER = regex.compile(r"\p{L}")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(2**64 - 1)


class Lookup:
    """Row numbers of sorted distinct keys, by open addressing in arrays."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.rows = np.full(1 << bits, _EMPTY), np.full(1 << bits, -1, np.int32)
        waiting, at = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.keys[at] == _EMPTY
            slots, first = np.unique(at[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.keys[slots], self.rows[slots] = keys[waiting[placed]], waiting[placed]
            rest = np.ones(len(waiting), bool)
            rest[placed] = False
            waiting, at = waiting[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        at = self._slot(keys)
        found, rows = self.keys[at], self.rows[at]
        rows = np.where(found == keys, rows, -1)
        open_ = np.flatnonzero((found != keys) & (found != _EMPTY))
        at = at[open_]
        while len(open_):
            at = (at + 1) & self.mask
            found, wanted = self.keys[at], keys[open_]
            hit = found == wanted
            rows[open_[hit]] = self.rows[at[hit]]
            more = ~hit & (found != _EMPTY)
            open_, at = open_[more], at[more]
        return rows


def folded(text: str) -> bytes:
    return text.lower().encode("utf-8")


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """The keys of all runs of ``length`` bytes, by their last byte's place."""
    if len(data) < length:
        return np.empty(0, np.uint64)
    out = data[: len(data) - length + 1].astype(np.uint64)
    for i in range(1, length):
        out = (out << np.uint64(8)) | data[i : len(data) - length + 1 + i]
    return out


class Trees:
    """The merged context trees of all languages, frozen."""

    def __init__(self, texts: dict[str, list[bytes]], order: int = ORDER) -> None:
        self.languages, self.order = sorted(texts), order
        width = len(self.languages)
        self.grams, self.costs, self.contexts, self.escapes = [], [], [], []
        arrays = {lang: [np.frombuffer(t, np.uint8) for t in texts[lang]] for lang in self.languages}
        for k in range(order + 1):
            counted = {
                lang: np.unique(np.concatenate([grams(t, k + 1) for t in arrays[lang]] or [np.empty(0, np.uint64)]), return_counts=True)
                for lang in self.languages
            }
            keys = np.unique(np.concatenate([g for g, _ in counted.values()] or [np.empty(0, np.uint64)]))
            contexts = np.unique(keys >> np.uint64(8))
            escapes, at = np.zeros((len(contexts), width)), np.searchsorted(contexts, keys >> np.uint64(8))
            if k:
                suffix = keys & np.uint64((1 << 8 * k) - 1)
                shorter = self.costs[-1][self.grams[-1].find(suffix)].astype(np.float64)
            else:
                shorter = np.full((len(keys), width), 8.0)
            direct = np.full((len(keys), width), np.nan)
            for l, (seen, counts) in enumerate(counted.values()):
                owner, kinds = np.unique(seen >> np.uint64(8), return_counts=True)
                place = np.searchsorted(owner, seen >> np.uint64(8))
                total = np.bincount(place, counts, len(owner)) if len(owner) else np.empty(0)
                escapes[np.searchsorted(contexts, owner), l] = -np.log2(kinds / (total + kinds))
                direct[np.searchsorted(keys, seen), l] = -np.log2(counts / (total + kinds)[place]) if len(owner) else 0
            costs = np.where(np.isnan(direct), escapes[at] + shorter, direct)
            self.grams.append(Lookup(keys))
            self.costs.append(costs.astype(np.float32))
            self.contexts.append(Lookup(contexts))
            self.escapes.append(np.vstack([escapes, np.zeros(width)]).astype(np.float32))

    def lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Code length in bits of each of the texts that lie in ``data`` from ``starts`` on, per language."""
        out = np.zeros((len(starts), len(self.languages)))
        ends = np.append(starts[1:], len(data))
        for first in range(0, len(data), BLOCK):
            last = min(first + BLOCK, len(data))
            begin = max(0, first - self.order)
            text = np.searchsorted(starts, np.arange(first, last), "right") - 1 if len(starts) > 1 else np.zeros(last - first, np.int64)
            bits = self._bits(data[begin:last], first - begin, np.arange(first, last) - starts[text])
            inside = np.flatnonzero((ends > first) & (starts < last) & (ends > starts))
            out[inside] += np.add.reduceat(bits, np.maximum(starts[inside], first) - first, dtype=np.float64)
        return out

    def _bits(self, data: np.ndarray, skip: int, before: np.ndarray) -> np.ndarray:
        """Bits of each byte after the first ``skip``; ``before``: how many bytes of its text precede it."""
        n = len(data) - skip
        bits = np.zeros((n, len(self.languages)), np.float32)
        open_ = np.arange(n)
        for k in range(self.order, -1, -1):
            key = np.zeros(len(open_), np.uint64)
            for i in range(k, -1, -1):
                key = (key << np.uint64(8)) | data[np.maximum(open_ + skip - i, 0)]
            enough = before[open_] >= k
            row = np.where(enough, self.grams[k].find(key), -1)
            hit = row >= 0
            bits[open_[hit]] += self.costs[k][row[hit]]
            missed = open_[~hit]
            # Row -1 holds zeros: an unknown context, or one that reaches back before the text, costs nothing.
            escape = np.where(enough[~hit], self.contexts[k].find(key[~hit] >> np.uint64(8)), -1)
            bits[missed] += self.escapes[k][escape]
            open_ = missed
        bits[open_] += 8
        return bits

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        at = [i for i, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        if at:
            parts = [folded(texts[i]) for i in at]
            starts = np.cumsum([0, *map(len, parts)])[:-1]
            lengths = self.lengths(np.frombuffer(b"".join(parts), np.uint8), starts)
            best = lengths.argmin(1)
            shares = 1 / np.exp2(np.minimum(lengths.min(1, keepdims=True) - lengths, 0)).sum(1)
            for i, b, s in zip(at, best, shares):
                names[i], scores[i] = self.languages[b], float(s)
        return names, scores


def training_texts(docs: DataFrame, allowed: Column, sample: int = SAMPLE) -> dict[str, list[bytes]]:
    """At most ``sample`` texts of each language among the allowed rows, by the hash of doc_id."""
    rank = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = docs.where(F.col("lang").isNotNull() & allowed)
    chosen = rows.select("lang", "doc_id").withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= sample)
    ids = [r["doc_id"] for r in chosen.select("doc_id").distinct().collect()]
    texts = rows.where(F.col("doc_id").isin(ids)).select("lang", "doc_id", "text")
    texts = texts.withColumn("_n", F.row_number().over(rank)).where((F.col("_n") <= sample) & F.col("text").isNotNull())
    out: dict[str, list[bytes]] = {}
    for row in texts.orderBy("lang", "doc_id", "text").collect():
        out.setdefault(row["lang"], []).append(folded(row["text"]))
    return out


def train(docs: DataFrame, allowed: Column, sample: int = SAMPLE, order: int = ORDER):
    """The trees of a bounded sample, sent to the tasks (their size is bounded by the sample)."""
    return docs.sparkSession.sparkContext.broadcast(Trees(training_texts(docs, allowed, sample), order))


def identify(docs: DataFrame, trees) -> DataFrame:
    """doc_id, lang_pred, score of every row, from its text alone."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                names, scores = trees.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names), pa.array(scores)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(predict), "doc_id long, lang_pred string, score double"
    )


def drop_unidentified(docs: DataFrame, trees) -> DataFrame:
    """The rows in a known language, all columns as they are."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                names, _ = trees.value.predict(part.column("text").to_pylist())
                yield part.filter(pa.array([n != UNKNOWN for n in names]))

    return docs.mapInArrow(lean(keep), docs.schema)


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)
