"""Names in one pass over a text: phrases, variants, overlaps of any number, and strings looked up by grams."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from maskloom.functions import grams, phrases
from maskloom.functions import spans as S
from maskloom.functions import variants
from maskloom.operators import detect, entities, redact, restore
from maskloom.plans.catalogue import QUERIES


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id int, text string")


def test_automaton_against_plain_python():
    rng = random.Random(2)
    words = ["Anna", "KELLER", "of", "Zürich", "x", "7", "acme", "AG"]
    listed = [(" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))), rng.choice("PQ")) for _ in range(60)]
    values = [" ".join(rng.choice(words) + rng.choice(["", ",", "-", " \n"]) for _ in range(rng.randint(0, 60))) for _ in range(80)] + [None, "", "..."]
    least = {}
    for phrase, category in listed:
        key = tuple(re.findall(r"\w+", phrase.lower()))
        least[key] = min(category, least.get(key, category))
    expected = []
    for text in values:
        found = list(re.finditer(r"\w+", text or ""))
        expected.append(sorted(
            (found[i].start(), found[i + len(p) - 1].end(), c)
            for p, c in least.items() for i in range(len(found) - len(p) + 1)
            if tuple(m.group().lower() for m in found[i : i + len(p)]) == p
        ))
    assert phrases.find_phrases(phrases.compile_phrases(listed), values) == expected
    assert phrases.find_phrases(phrases.compile_phrases([]), ["a b"]) == [[]]


def test_list_and_join_find_the_same(spark, monkeypatch):
    docs = texts(spark, "Anna Keller of Acme, Keller AG", "acme ag / ANNA", None, "")
    gazetteer = spark.createDataFrame([("Anna Keller", "Person"), ("keller", "Person"), ("Acme", "Organization"), ("Keller AG", "Organization"), ("", "Person"), (None, "Person")], "phrase string, category string")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    by_list, by_join = rows(detect.detect_dictionary(docs, gazetteer)), rows(detect.join_dictionary(docs, gazetteer))
    assert by_list == by_join and len(by_list) == 6
    tagged = rows(redact.pseudonymize(docs, phrases=gazetteer).select("doc_id", "text"))
    monkeypatch.setattr(phrases, "MOST", 2)
    assert rows(detect.detect_dictionary(docs, gazetteer)) == by_join
    assert rows(redact.pseudonymize(docs, phrases=gazetteer).select("doc_id", "text")) == tagged


def test_variants_in_a_row_are_linked_like_those_of_a_table(spark):
    rng = random.Random(9)
    given, names = ["Anna", "Max", "Ben", "M.", "A", "Ms", "Dr.", "Mme", "Anna Lou", ""], ["Keller", "Diaz", "keller", "O'Neil"]
    groups = [[f"{rng.choice(given)} {rng.choice(names)}".strip() for _ in range(rng.randint(1, 25))] for _ in range(60)]
    rows = [(i, j, "Person", s) for i, some in enumerate(groups) for j, s in enumerate(some)]
    df = spark.createDataFrame(rows, "doc_id int, pos int, category string, surface string")
    linked = {(r.doc_id, r.pos): r.entity for r in entities.link_mentions(df).collect()}
    assert {(i, j): e for i, some in enumerate(groups) for j, e in enumerate(variants.link_names(some))} == linked


def test_everything_meets_in_one_text(spark):
    docs = spark.createDataFrame([
        (1, "Anna Keller (a@b.co) of Acme AG met Ms Keller. A. Keller left; B. Keller, Nimbus.", ["nimbus"], ["acme ag"]),
        (2, "Nobody here.", None, None), (3, None, None, None),
    ], "doc_id int, text string, pii_included_terms array<string>, pii_excluded_terms array<string>")
    people = detect.name_phrases(spark.createDataFrame([("Anna Keller",), ("Bea Keller",)], "name string"))
    firms = spark.createDataFrame([("Acme AG", "Organization")], "phrase string, category string")
    model = detect.detect_with(docs, lambda text: [(m.start(), m.end(), "Address") for m in re.finditer("left", text)])
    out = redact.pseudonymize(docs, phrases=people.unionByName(firms), found=model).orderBy("doc_id").collect()
    assert out[0].text == "[Person 1] ([Email 1]) of Acme AG met [Person 1]. [Person 1] [Address 1]; [Person 2], █████."
    assert [o.text for o in out[1:]] == ["Nobody here.", None]
    table = entities.correspondence_table(entities.document_mentions(redact.pseudonymize(docs, phrases=people)))
    assert {(r.placeholder, r.original) for r in table.where("category = 'Person'").collect()} == {("[Person 1]", "Anna Keller"), ("[Person 2]", "B. Keller")}


@pytest.mark.parametrize("count", [16_000])
def test_thousands_of_spans_in_one_text(spark, count):
    """Each step on a text with this many spans, overlapping or not, takes well under two seconds."""
    text = " ".join(f"mail{i}@ex{i % 50}.org" for i in range(count))
    docs = texts(spark, text).cache()
    redact.pseudonymize(docs).collect()
    begun = time.time()
    row = redact.pseudonymize(docs).first()
    assert len(row.spans) == count and row.text.endswith(f"[Email {count}]") and time.time() - begun < 4
    chained = [(3 * i, 3 * i + (2 if i % 100 == 99 else 5), "Person", text[3 * i : 3 * i + (2 if i % 100 == 99 else 5)], 1) for i in range(count)]
    df = spark.createDataFrame([(chained,)], f"spans {S.SPANS}").select(S.reduce_overlaps(F.col("spans")).alias("s")).cache()
    begun = time.time()
    spans = df.first().s
    assert len(spans) == count // 100 and all(text[s.start : s.end] == s.surface for s in spans) and time.time() - begun < 4


def test_running_results_in_blocks(spark):
    values = [random.Random(1).randrange(1000) for _ in range(1000)]
    df = spark.createDataFrame([(values,), ([],), (values[:256],), (values[:257],)], "v array<int>")
    got = [r[0] for r in df.select(S.scanned(F.col("v"), "int", F.greatest)).collect()]
    assert got == [[max(v[: i + 1]) for i in range(len(v))] for v in (values, [], values[:256], values[:257])]


@pytest.mark.parametrize("window", [1 << 20, 12])
def test_grams_find_what_plain_search_finds(monkeypatch, window):
    monkeypatch.setattr(grams, "WINDOW", window)
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    values = [word(rng.randint(0, 90)) for _ in range(60)] + [None, "", "😀abc😀"]
    needles = [[(word(rng.randint(1, 6)), rng.random() < 0.4) for _ in range(rng.randint(0, 40))] for _ in values]
    needles[-1] = [("😀ab", False), ("c😀", False), ("abc", True), ("ab", True), ("😀😀", False)]

    def there(text, needle, alone):
        if not text:
            return False
        if not alone:
            return needle in text
        return bool(re.search(rf"(?<!\w){re.escape(needle)}(?!\w)", text))

    assert grams.find(values, needles) == [[there(t, n, a) for n, a in some] for t, some in zip(values, needles)]


def test_parts_of_names_are_leaks(spark):
    table = spark.createDataFrame([
        ("d", "[Person 1]", "Person", "Ines Otálora"), ("d", "[Org 1]", "Organization", "Lund & Vik AB"), ("d", "[Date 1]", "Date", "5 mars 2024"),
        ("e", "[Person 1]", "Person", "Bo Ek"), ("d", "[Org 2]", "Organization", None),
    ], "doc_id string, placeholder string, category string, original string")
    outputs = spark.createDataFrame([
        ("d", "Otálora's note of mars"), ("d", "Inesita, Lunda"), ("d", "by Lund &amp; Vik AB."), ("e", "Bo and Ek, Ines"),
    ], "doc_id string, text string")
    got = lambda **k: {tuple(r) for r in restore.leak_scan(outputs, table, **k).collect()}
    assert got() == set()
    assert got(fragments=True) == {("d", "[Person 1]", False), ("d", "[Org 1]", True)}
    assert got(fragments=True, listed=1) == got(fragments=True)


def test_reviewed_masks_are_searched_for_and_joined_once(spark):
    """the texts were searched three times, and masks joined with each kind of decision."""
    mask = "doc_id int, start int, end int, category string, surface string, entity string"
    masks = spark.createDataFrame([(1, 0, 2, "Date", "a", "x"), (1, 3, 4, "Date", "b", "y"), (1, 5, 6, "Date", "c", "z"), (1, 7, 8, "Date", "d", "w")], mask)
    said = [(1, 0, 2, "remove", "n"), (1, 0, 2, "merge", "n"), (1, 3, 4, "merge", "n"), (1, 5, 6, "split", None), (1, 9, 9, "add", "m"), (1, 9, 9, "add", "m")]
    decisions = spark.createDataFrame([(d, s, e, "Date", "s", n, a) for d, s, e, a, n in said], mask + ", action string")
    done = entities.apply_review(masks, decisions)
    assert sorted((r.start, r.entity) for r in done.collect()) == [(3, "n"), (5, "z"), (7, "w"), (9, "m")]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(done).count("Join ") == 1
    assert plan(QUERIES["mask_review"](spark, "/root/testdata/sf0.001")).count("ArrowEvalPython") == 0
