"""The word transducer against a dictionary, and encoding and decoding against the library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from edge import TEXTS, documents, empty
from test_tokens import TRICKY
from tokenizers import Tokenizer

from maskloom.llm import bpe, lexicon, queries, store

PATH = public_tokenizers.path("word_bpe_49k.json")


def opened(tmp_path, entries):
    path = tmp_path / "words.bin"
    path.write_bytes(lexicon.build(entries))
    return lexicon.Lexicon(str(path))


@pytest.mark.parametrize("letters, longest", [("ab", 9), ("abcé漢", 6), ("x", 40)])
def test_transducer_gives_what_a_dictionary_gives(tmp_path, letters, longest):
    rng = random.Random(longest)
    entries = {}
    for _ in range(3000):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(0, longest)))
        entries[word] = tuple(rng.choices(range(5), k=rng.randint(0, 4)))
    words = opened(tmp_path, [(w.encode(), ids) for w, ids in entries.items()])
    asked = [*entries, "b" * 60, "", "zz", *[w + "q" for w in list(entries)[:50]]]
    rng.shuffle(asked)
    known, sizes, ids = words.look_up(asked)
    at = 0
    for word, there, size in zip(asked, known, sizes):
        assert there == (word in entries)
        assert tuple(ids[at : at + size].tolist()) == (entries[word] if there else ())
        at += size
    assert at == len(ids)


def test_transducer_is_minimal(tmp_path):
    """Words that end alike share their endings: stems times endings need stems plus endings."""
    stems, ends = [f"{a}{b}" for a in "bcdfg" for b in "aeiou"], ["", "s", "ed", "ing", "ings"]
    words = opened(tmp_path, [((s + e).encode(), (7, *map(ord, e))) for s in stems for e in ends])
    # Behind the root: one state after all consonants, one after all vowels, e, i, in, ing, and the end.
    assert words.lost == 8 and len(words.arcs) == 5 + 5 + 3 + 4
    known, sizes, ids = words.look_up(["bas", "guings", "gu", "gui"])
    assert known.tolist() == [True, True, True, False] and ids.tolist() == [7, ord("s"), 7, *map(ord, "ings"), 7]


def test_empty_lexicon(tmp_path):
    known, sizes, ids = opened(tmp_path, []).look_up(["a", ""])
    assert not known.any() and not sizes.any() and not len(ids)


@pytest.mark.parametrize("size", [0, 40, bpe.WORDS])
def test_ids_of_whole_texts_with_any_lexicon(spark, size):
    extra = [(1000 + i, t, None, None, 0, "k", "h", 1, "w") for i, t in enumerate(TRICKY)]
    docs = documents(spark, extra=extra)
    path = bpe.write_lexicon(docs, PATH, size)
    back = bpe.decode(bpe.encode(docs, PATH, path), PATH).collect()
    assert sorted(map(str, bpe.encode_and_decode(docs, PATH, path).collect())) == sorted(map(str, back))
    whole = Tokenizer.from_file(PATH)
    wanted = []
    for r in docs.collect():
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids
        wanted.append((str(r["doc_id"]), ids, whole.decode(ids, skip_special_tokens=False)))
    assert sorted((str(r["doc_id"]), r["ids"], r["text"]) for r in back) == sorted(wanted)


def test_long_texts_are_cut(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 40)
    text = TEXTS[8][:3000] + "x" * 300 + " tail. of, it"
    parts = list(bpe.slices(text))
    assert " ".join(parts) == text and len(parts) > 50
    path = tmp_path / "w.bin"
    path.write_bytes(lexicon.build([(b"the", (1, 2))]))
    got = np.concatenate([bpe.Encoder(PATH, str(path)).ids([p])[1] for p in bpe.slices("and the end")])
    alone = Tokenizer.from_file(PATH)
    ids = lambda t: alone.encode(t, add_special_tokens=False).ids
    assert got.tolist() == [*ids("and"), 1, 2, *ids("end")]


def test_decode_of_strange_ids(spark):
    rows = spark.createDataFrame([(1, [49407, 5, 10**6, -1]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in bpe.decode(rows, PATH).collect()}
    whole = Tokenizer.from_file(PATH)
    assert got == {1: whole.decode([49407, 5, 10**6], skip_special_tokens=False), 2: "", 3: ""}


def test_empty(spark):
    assert bpe.encode(empty(spark), PATH, bpe.write_lexicon(empty(spark), PATH)).count() == 0
    assert store.folder(spark, "x")


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    whole, wanted = Tokenizer.from_file(PATH), {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        wanted[r["doc_id"]] = (len(ids), sha(" ".join(map(str, ids))), sha(whole.decode(ids, skip_special_tokens=False)))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op13_lexicon_bpe(spark, sf).collect()}
    assert got == wanted
