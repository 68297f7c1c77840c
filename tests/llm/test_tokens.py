"""Token ids, token files and packing against the tokenizers library on whole texts."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from edge import TEXTS, documents, empty
from tokenizers import Tokenizer

from maskloom.llm import packing, store, token_files
from maskloom.llm.tokens import Encoder

PATHS = [public_tokenizers.path(n) for n in ("word_bpe_49k.json",)]
TRICKY = [
    *[t for t in TEXTS.values() if t], "á b\x1cc d e", "<|endoftext|> x<|startoftext|>y", "Σας İx don't \t\nit's\n\n", "e\ńx", "it 's", "ᄀ ᅡ",
    "ends. ends, ENDS! 'ends' (ends) ends)). 'tis. x'. don't.", "½. ²! ªb. ﬁ. Ǆ.", "a" * 5000 + ". b",
]


@pytest.mark.parametrize("path", PATHS)
def test_pieces_give_the_ids_of_whole_texts(path):
    words, whole = Encoder(path), Tokenizer.from_file(path)
    assert words.fold
    found = [np.frombuffer(x, words.dtype).tolist() for x in words.batch([*TRICKY, None, "", *TRICKY])]
    wanted = [whole.encode(t, add_special_tokens=False).ids for t in TRICKY]
    assert found == [*wanted, [], [], *wanted]


def test_long_texts_are_cut_at_spaces(monkeypatch):
    monkeypatch.setattr("maskloom.llm.tokens.SLICE", 50)
    monkeypatch.setattr("maskloom.llm.tokens.REMEMBERED", 20)
    words, whole = Encoder(PATHS[0]), Tokenizer.from_file(PATHS[0])
    for text in ("x" * 200 + " y " + "ab cd. " * 40, "nospaces" * 30, TEXTS[8][:5000]):
        assert np.frombuffer(words.ids(text), words.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids


def _ids(docs, end):
    whole = Tokenizer.from_file(PATHS[0])
    return [(r["doc_id"], whole.encode(r["text"] or "", add_special_tokens=False).ids + [end]) for r in docs.collect()]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark):
    docs, folder = documents(spark), store.folder(spark, "test")
    token_files.write_token_files(docs, folder, PATHS[0], 2)
    rows = token_files.read_token_spans(spark, folder).orderBy("start").collect()
    ids = _ids(docs, 2)
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in ids), key=lambda x: (x is not None, x))
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted((str(i), len(x), _crc(x)) for i, x in ids)
    folder = store.folder(spark, "test")
    token_files.write_token_files(empty(spark), folder, PATHS[0], 2)
    assert token_files.read_token_spans(spark, folder).count() == 0


@pytest.mark.parametrize("capacity, grain, windows", [(2048, 512, 192), (64, 16, 8)])
def test_packing_holds_each_id_once(spark, capacity, grain, windows):
    docs = documents(spark, ids=set(range(18)) - {5})
    rows = packing.pack(docs.where("doc_id is not null and doc_id <> 5"), PATHS[0], 1, capacity, grain, windows).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    ids = dict(_ids(docs.where("doc_id is not null and doc_id <> 5"), 1))
    assert set(pieces) == set(ids)
    for doc_id, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[doc_id]), _crc(ids[doc_id][at : at + r["length"]]))
            at += r["length"]
        assert at == len(ids[doc_id])
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    assert packing.pack(empty(spark), PATHS[0]).count() == 0


def test_repeated_and_null_ids_are_packed_each(spark):
    rows = packing.pack(documents(spark, ids={0}), PATHS[0]).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["0", "5", "5", "None"]


def test_differencing_is_near_equal():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 512, 900)
    window = packing.difference(lengths, 110)
    sums = np.bincount(window, lengths, 110)
    assert sums.sum() == lengths.sum() and sums.max() - sums.min() <= 8
    assert np.bincount(packing.fit(lengths, 2048), lengths).max() <= 2048
    assert packing.difference(np.array([8, 7, 6, 5, 4]), 2).tolist().count(0) in (2, 3)
