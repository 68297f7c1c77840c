"""Spans found, reduced and written over in one call of Python per batch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from maskloom.functions import grams, phrases
from maskloom.functions import spans as S
from maskloom.functions import tagging
from maskloom.operators import entities, redact

TEXTS = [
    "a@b.co on 2024-02-03, +1 (743) 555-3824; 4111 1111 1111 1111, 4111 1111 1111 1112, 5. März 2020", "GB82 WEST 1234 5698 7654 32 x",
    "DE00 0000 0000 0000 0000 00", "", None, "🙂 é a@b.co, A@B.CO 0151 234 567", "1234567890123", "0000000000000",
]


def test_patterns_and_overlaps_are_those_of_the_jvm(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    found = df.select("doc_id", S.pattern_spans(F.col("text")).alias("jvm"), tagging.find_patterns(F.col("text")).alias("here"))
    assert all([tuple(s) for s in r.jvm] == [tuple(s) for s in r.here] for r in found.collect())
    text, some = "abcdefghijkl", [(0, 3, "B", 1), (2, 5, "A", 1), (2, 5, "C", 0), (5, 6, "A", 1), (8, 12, "X", 1), (9, 10, "Y", 1)]
    spans = [(a, b, c, text[a:b], p) for a, b, c, p in some]
    jvm = spark.createDataFrame([(spans,)], f"s {S.SPANS}").select(S.reduce_overlaps(F.col("s"))).first()[0]
    assert tagging.reduce_spans(spans) == [tuple(s) for s in jvm]


def test_names_rules_and_tags_take_one_call_of_python(spark):
    df = spark.createDataFrame(
        [(1, "Ann Lee (a@b.co) and Lee", None, ["and"], ["a@b.co"])],
        "doc_id int, text string, pii_categories array<string>, pii_included_terms array<string>, pii_excluded_terms array<string>",
    )
    names = spark.createDataFrame([("Ann Lee", "Person"), ("Lee", "Person")], "phrase string, category string")
    done = redact.pseudonymize(df, phrases=names)
    assert done.first().text == f"[Person 1] (a@b.co) {S.MASK} [Person 1]"
    assert done._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_a_few_strings_of_a_short_text_need_no_index(monkeypatch):
    """the index of grams cost more than the texts of notes; long texts with many strings still go through it."""
    texts = ["Anna Keller wrote", "nobody", None, "Kellers Wa", ""]
    needles = [[("Anna Keller", False), ("Keller", True), ("ell", True)], [("x", False)], [("y", False)], [("Keller", True), ("Wa", True)], [("a", False)]]
    with monkeypatch.context() as patch:
        patch.setattr(grams, "PLAIN", 0)
        indexed = grams.find(texts, needles)
    monkeypatch.setattr(grams, "_together", lambda *_: pytest.fail("an index was built"))
    assert grams.find(texts, needles) == indexed == [[True, True, False], [False], [False], [False, True], [False]]


def test_words_of_plain_texts_are_placed_at_once():
    """words of ASCII texts come out of one search, at the same places as word by word."""
    listed = phrases.compile_phrases([("Anna Keller", "Person"), ("keller", "Person"), ("Bo 7", "Address")])
    texts = ["Anna KELLER, Bo-7", None, "", "keller", "x_Bo  7 Anna"]
    met = phrases.find_phrases(listed, texts)
    assert met == [[(0, 11, "Person"), (5, 11, "Person"), (13, 17, "Address")], [], [], [(0, 6, "Person")], [(2, 7, "Address")]]
    assert phrases.find_phrases(listed, [*texts, "é"])[:-1] == met
    words, starts, ends, sizes = phrases._placed(texts)
    assert (words[:3], starts[:3].tolist(), ends[:3].tolist(), sizes.tolist()) == (["anna", "keller", "bo"], [0, 5, 13], [4, 11, 15], [4, 0, 0, 1, 4])


def test_the_table_of_tags_needs_no_spans_and_no_text(spark):
    """spans and texts were made, handed on and sorted where only the tags of a row, or their lengths, were asked for."""
    rows = [(i % 5, ["en", "fr", "xx", None][i % 4], t) for i, t in enumerate(TEXTS * 2)] + [(0, "en", "\x02 B@b.co a@b.co \x03 2024-02-03")]
    df = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    mentions, lean = entities.document_mentions(redact.pseudonymize(df, lang="lang")), entities.pattern_mentions(df, "lang")
    ordered = lambda table: sorted(map(tuple, table.collect()), key=str)
    table = entities.correspondence_table(lean)
    assert ordered(table) == ordered(entities.correspondence_table(mentions)) and table.count() > 10
    # A tag that is stored in one row of a document and not in another can be restored.
    lost = F.when((F.col("category") == "Date") | (F.length("surface") < 7), F.when(F.col("category") == "Date", "")).otherwise(F.col("surface"))
    lean, mentions = lean.withColumn("surface", lost), mentions.withColumn("surface", lost)
    left = entities.unrestorable_mentions(lean)
    whole = entities.correspondence_table(mentions.withColumn("surface", F.coalesce("surface", F.lit(""))))
    assert ordered(left) == ordered(entities.unrestorable_tags(whole)) and 0 < left.count() < table.count()
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_patterns_of_a_batch_are_marked_at_once(monkeypatch):
    """every text was scanned on its own; only texts that hold a mark still are."""
    import pyarrow as pa

    texts = [*TEXTS, "DE36000000000000003686 and 4000000000000002"]
    alone = tagging.find_all(pa.array([None if t is None else f"{t}\x02" for t in texts]))
    monkeypatch.setattr(tagging, "_apart", lambda *_: pytest.fail("a text was scanned alone"))
    assert tagging.find_all(pa.array(texts)) == alone and sum(map(len, alone)) > 8
    assert tagging.find_all(pa.array(texts).slice(5), ["Email"]) == [[s for s in some if s[2] == "Email"] for some in alone[5:]]
