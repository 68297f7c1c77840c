"""Token ids of whole texts by a word lexicon and exact merging of the words it lacks, and the texts ids decode to.

Words are what stands between spaces and line feeds: no vocabulary used here joins text across them, so the ids of a
text are those of its words. One pass over all documents counts the words; the most frequent ones (at most ``WORDS``,
which bounds the file and what the driver sees) become a transducer with their ids (``lexicon``), written once to the shared
folder and mapped into memory by every task. Words it lacks are merged by the tokenizers library, so the size of the
lexicon changes no id. Texts of plain letters are lower-cased first and marks at the end of a word looked up apart,
where the vocabulary does the same (tried out on a sample when a vocabulary is opened).

Null and empty texts have no ids and decode to the empty text; texts of any length are cut at spaces while they are
worked on. Rows that repeat are encoded each; an empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm import lexicon, store

#: Words in the lexicon, and the longest one that is (characters).
WORDS, LONGEST = 131_072, 48
#: Characters worked on at once, and different words counted before they are handed on.
SLICE, COUNTED = 4 << 20, 200_000
#: Ids in one batch handed on.
IDS = 1 << 20
_MARKS = ".,;:!?|)\"-"
# Beyond these, case and composition depend on the neighbours; "<|" may begin a special token.
_BEYOND = re.compile(r"[^\t\n\r -~\xa1-ɏ]|<\|")
_SAMPLE = "Était-ce don't STOP!!! a|b, (x_y).z 'tis 12,5 \xad½ it's|we'LL Ünder_ _'s ..'re Word). x!' \tİx ǅ"


# Byte-level vocabularies write a byte as the Latin-1 character where that is visible, the others from 256 on, in order.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_VISIBLE = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class Words:
    """How one vocabulary's texts are cut into words, and the ids the library merges them to."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.fold = self.direct = False
        whole = self.tokenizer.encode(_SAMPLE, add_special_tokens=False).ids
        if self._together() != whole:
            raise ValueError(f"{vocabulary} joins text across white space")
        self.fold = True
        self.fold = self._together() == whole
        self.direct = self.fold
        alone = [w for w in _SAMPLE.lower().split() if w.isalpha() and not _BEYOND.search(w)]
        self.direct = self.fold and list(self.merge(alone)) == [
            e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)
        ]

    def _together(self) -> list[int]:
        return [i for w in self.cut(_SAMPLE) for part in self.parts(w) for i in next(iter(self.merge([part])))]

    def cut(self, text: str) -> list[str]:
        if self.fold and not _BEYOND.search(text):
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def parts(self, word: str) -> tuple[str, ...]:
        """A word, or its letters and the marks after them."""
        if self.fold and word and word[-1] in _MARKS:
            core = word.rstrip(_MARKS)
            if core != word and core.isalpha() and (core.isascii() or not _BEYOND.search(core)):
                return core, word[len(core) :]
        return (word,)

    def merge(self, words: Sequence[str]) -> Iterator[list[int]]:
        """The ids of each word: of plain lower-case letters by the vocabulary's merges alone, others by its whole way."""
        if not self.direct:
            yield from self._whole(words)
            return
        plain = [w.isalpha() and w == w.lower() and (w.isascii() or not _BEYOND.search(w)) for w in words]
        others = self._whole([w for w, alone in zip(words, plain) if not alone])
        tokenize = self.tokenizer.model.tokenize
        for word, alone in zip(words, plain):
            if alone:
                word = word if word.isascii() else word.encode().decode("latin-1").translate(_VISIBLE)
                yield [t.id for t in tokenize(word)]
            else:
                yield next(others)

    def _whole(self, words: Sequence[str]) -> Iterator[list[int]]:
        for start in range(0, len(words), 4096):
            for found in self.tokenizer.encode_batch_fast(words[start : start + 4096], add_special_tokens=False):
                yield found.ids


def slices(text: str) -> Iterator[str]:
    """The text cut at spaces into slices of about ``SLICE`` characters."""
    at = 0
    while len(text) - at > SLICE:
        end = text.rfind(" ", at, at + SLICE)
        if end < 0:
            end = text.find(" ", at + SLICE)
            if end < 0:
                break
        yield text[at:end]
        at = end + 1
    yield text[at:]


@lru_cache(maxsize=2)
def _words(vocabulary: str) -> Words:
    return Words(vocabulary)


@lru_cache(maxsize=2)
def _lexicon(path: str) -> lexicon.Lexicon:
    return lexicon.Lexicon(path)


def word_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """(word, n) over all texts: the words a lexicon may hold."""

    def listed(counts: Counter, words: Words) -> pa.RecordBatch:
        parted: Counter = Counter()
        for word, n in counts.items():
            for part in words.parts(word):
                if part and len(part) <= LONGEST:
                    parted[part] += n
        return pa.RecordBatch.from_pydict({"word": pa.array(parted, pa.string()), "n": pa.array(parted.values(), pa.int64())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = _words(vocabulary), Counter()
        for batch in batches:
            for value in batch.column(0):
                for some in slices(value.as_py() or ""):
                    counts.update(words.cut(some))
                    if len(counts) > COUNTED:
                        yield listed(counts, words)
                        counts = Counter()
        yield listed(counts, words)

    counted = docs.select(F.col(text).alias("text")).mapInArrow(store.lean(count), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: int) -> list[str]:
    """The most frequent words, as many whole classes of like frequency (eighths of a doubling) as make at most ``size``."""
    classed = store.stored(counts.withColumn("class", F.floor(F.log2("n") * 8).cast("int")), "word-counts")
    wanted, total = None, 0
    for row in sorted(classed.groupBy("class").count().collect(), reverse=True):
        total += row["count"]
        if total > size:
            break
        wanted = row["class"]
    if wanted is None:
        return []
    return [r["word"] for r in classed.where(F.col("class") >= wanted).select("word").collect()]


def write_lexicon(docs: DataFrame, vocabulary: str, size: int = WORDS, text: str = "text") -> str:
    """The lexicon file of at most ``size`` of the most frequent words of the texts, in the shared folder; gives its path."""
    chosen = frequent_words(word_counts(docs, vocabulary, text), size)
    coded = [w.encode() for w in chosen]
    path = f"{store.folder(docs.sparkSession, 'lexicon')}.bin"
    store.write_bytes(path, lexicon.build(zip(coded, map(tuple, _words(vocabulary).merge(chosen)))))
    return path


def _gathered(pool: np.ndarray, at: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The runs (at, size) of a pool that are chosen, one after the other."""
    lengths = sizes[chosen]
    return pool[np.repeat(at[chosen] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))]


class Encoder:
    """Encodes texts with a lexicon file and the vocabulary it was made with."""

    def __init__(self, vocabulary: str, path: str) -> None:
        self.words, self.lexicon = _words(vocabulary), _lexicon(path)

    def ids(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(how many ids each text has, all ids one after the other)."""
        cut = [self.words.cut(t) for t in texts]
        # Every different word once; a word with marks is two look-ups that stand side by side.
        distinct = list(set().union(*cut))
        parts = [self.words.parts(w) for w in distinct]
        wanted = list(dict.fromkeys(p for some in parts for p in some))
        at, sizes, pool = self._looked_up(wanted)
        place = {p: i for i, p in enumerate(wanted)}
        first = np.fromiter((place[p[0]] for p in parts), np.int64, len(parts))
        second = np.fromiter((place[p[1]] if len(p) > 1 else -1 for p in parts), np.int64, len(parts))
        pairs = np.stack([first, second], axis=1)
        there = pairs >= 0
        # The ids of every different word side by side, then of every word as it comes.
        pool, by_word = _gathered(pool, at, sizes, pairs[there]), np.where(there, sizes[pairs], 0).sum(axis=1)
        number = {w: i for i, w in enumerate(distinct)}
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        used = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        ends = np.concatenate([[0], np.cumsum(by_word[used])])[np.concatenate([[0], np.cumsum(counts)])]
        return np.diff(ends), _gathered(pool, np.cumsum(by_word) - by_word, by_word, used)

    def _looked_up(self, wanted: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each word are in a pool, how many, and the pool."""
        known, sizes, ids = self.lexicon.look_up(wanted)
        at = np.cumsum(sizes) - sizes
        unseen = np.flatnonzero(~known)
        merged = list(self.words.merge([wanted[i] for i in unseen]))
        more = np.fromiter(map(len, merged), np.int64, len(merged))
        at[unseen], sizes[unseen] = len(ids) + np.cumsum(more) - more, more
        return at, sizes, np.concatenate([ids, np.array([i for some in merged for i in some], np.uint32)])


def _batched(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(rows, slices of their texts) of about ``SLICE`` characters; a long text comes alone."""
    some: list[str] = []
    size = 0
    for value in texts:
        text = value.as_py() or ""
        if len(text) > SLICE:
            if some:
                yield len(some), some
                some, size = [], 0
            yield 1, [text]
            continue
        some.append(text)
        size += len(text)
        if size > SLICE:
            yield len(some), some
            some, size = [], 0
    if some:
        yield len(some), some


def _encoded(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(document ids, offsets, ids) of the texts of a batch, some at a time."""
    at = 0
    for rows, texts in _batched(batch.column(1)):
        if rows == 1 and len(texts[0]) > SLICE:
            ids = np.concatenate([encoder.ids([part])[1] for part in slices(texts[0])])
            counts = np.array([len(ids)])
        else:
            counts, ids = encoder.ids(texts)
        yield batch.column(0).slice(at, rows), np.concatenate([[0], np.cumsum(counts)]), ids.astype(np.int32)
        at += rows


def _chosen(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, str]:
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, ids array<int>"


def _listed(offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))


def encode(docs: DataFrame, vocabulary: str, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, with the lexicon file of ``write_lexicon``."""
    chosen, schema = _chosen(docs, doc_id, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, path)
        for batch in batches:
            for names, offsets, ids in _encoded(encoder, batch):
                yield pa.RecordBatch.from_arrays([names, _listed(offsets, ids)], names=["doc_id", "ids"])

    return chosen.mapInArrow(store.lean(work), schema)


def encode_and_decode(docs: DataFrame, vocabulary: str, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, text): ``decode`` of ``encode`` in one pass, by one Python worker a task."""
    chosen, schema = _chosen(docs, doc_id, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, back = Encoder(vocabulary, path), decoder(vocabulary)
        for batch in batches:
            for names, offsets, ids in _encoded(encoder, batch):
                texts = [back(ids[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([names, _listed(offsets, ids), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return chosen.mapInArrow(store.lean(work), f"{schema}, text string")


@lru_cache(maxsize=2)
def _tokens(vocabulary: str) -> list[str | None]:
    tokenizer = _words(vocabulary).tokenizer
    return [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]


def decoder(vocabulary: str) -> Callable[[np.ndarray], str]:
    """A function from an array of ids to text: as the library's decode with special tokens kept; ids without a token are skipped."""
    words = _words(vocabulary)
    if words.tokenizer.decoder is not None:
        return lambda ids: words.tokenizer.decode(ids[ids >= 0].tolist(), skip_special_tokens=False)
    tokens = _tokens(vocabulary)
    known = np.array([t is not None for t in tokens])

    def joined(ids: np.ndarray) -> str:
        fine = (ids >= 0) & (ids < len(tokens))
        if not fine.all() or not known[ids].all():
            ids = ids[fine]
            ids = ids[known[ids]]
        return " ".join(map(tokens.__getitem__, ids.tolist()))

    return joined


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, text) of (doc_id, ids): the texts that ids decode to (null ids: the empty text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = decoder(vocabulary)
        for batch in batches:
            ids, start = batch.column(1), 0
            sizes = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            flat = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            while start < len(ids):
                end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + IDS, side="right")) - 1)
                texts = [back(flat[sizes[i] : sizes[i + 1]]) for i in range(start, end)]
                yield pa.RecordBatch.from_arrays(
                    [c.slice(start, end - start) for c in (batch.column(0), ids)] + [pa.array(texts, pa.string())],
                    names=["doc_id", "ids", "text"],
                )
                start = end

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(store.lean(work), f"doc_id {kind}, ids array<int>, text string")
