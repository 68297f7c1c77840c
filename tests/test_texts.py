"""Detection, overlaps, rules, tags: fixtures and comparison with plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from maskloom.functions import patterns as P
from maskloom.functions import spans as S
from maskloom.operators import detect, entities, ordered, pages, redact, rules


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id int, text string")


@pytest.mark.parametrize("text, found", [
    ("Mail a.b@x.example.com.", ["Email:a.b@x.example.com"]),
    ("4111 1111 1111 1111 4111111111111111 4111111111111112", ["CreditCard:4111 1111 1111 1111", "CreditCard:4111111111111111"]),
    ("DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 DE00370400440532013000", ["IBAN:DE89 3704 0044 0532 0130 00", "IBAN:GB82WEST12345698765432"]),
    ("+1 (743) 555-3824 (743) 555-3824 044 668 18 00", ["PhoneNumber:+1 (743) 555-3824", "PhoneNumber:(743) 555-3824", "PhoneNumber:044 668 18 00"]),
    ("2024-03-05 2024/13/05 5.3.2024 5 mars 2024 5 de marzo de 2024 March 5, 2024", ["Date:2024-03-05", "Date:5.3.2024", "Date:5 mars 2024", "Date:5 de marzo de 2024", "Date:March 5, 2024"]),
    ("éé😀 a@b.co", ["Email:a@b.co"]),
    ("no data at all", []),
])
def test_patterns(spark, text, found):
    rows = detect.detect_patterns(texts(spark, text)).orderBy("start").collect()
    assert [f"{r.category}:{r.surface}" for r in rows] == found
    assert all(text[r.start:r.end] == r.surface for r in rows)


def test_gated_and_portable_patterns_find_the_same(spark):
    rng = random.Random(5)
    bits = ["a.b@c.de", "+41 44 668 18 00", "2024-01-02", "Mar", "March 5, 2024", "4111111111111111", "x", " ", ".", "0123-44", "J", "DE89370400440532013000", "é"]
    many = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    both = texts(spark, *many).select(
        F.regexp_extract_all("text", F.lit(P.pattern()), F.lit(0)).alias("a"),
        F.regexp_extract_all("text", F.lit(P.pattern(portable=True)), F.lit(0)).alias("b"),
    )
    assert both.where("NOT a <=> b").count() == 0


def test_long_rows_of_pieces_are_placed(spark):
    lengths = [i % 7 for i in range(1000)]
    starts = [sum(lengths[:i]) for i in range(1000)]
    df = spark.createDataFrame([(lengths,), ([],), ([3],)], "n array<int>")
    assert [r[0] for r in df.select(S.running_starts(F.col("n"))).collect()] == [starts, [], [0]]


def test_overlaps_against_plain_python(spark):
    rng = random.Random(7)
    groups = []
    for _ in range(60):
        text = "".join(rng.choice("abcdefgh") for _ in range(40))
        spans = []
        for _ in range(rng.randint(1, 8)):
            a = rng.randrange(38)
            b = rng.randint(a + 1, 40)
            spans.append((a, b, rng.choice("XYZ"), text[a:b], rng.randint(0, 2)))
        groups.append((text, spans))
    expected = []
    for text, spans in groups:
        out = []
        for a, b, c, _, p in sorted(spans):
            rank = (p, a - b, a, c)
            if out and a < out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], b), min(out[-1][2], rank))
            else:
                out.append((a, b, rank))
        expected.append([(a, b, r[3], text[a:b], r[0]) for a, b, r in out])
    df = spark.createDataFrame(groups, f"text string, spans {S.SPANS}").select(S.reduce_overlaps(F.col("spans")))
    assert [[tuple(s) for s in r[0]] for r in df.collect()] == expected


def test_rules_decide_what_goes(spark):
    df = spark.createDataFrame([(
        1, "Project Nimbus of nimbus@x.com, call +1 (743) 555-3824 or a@b.co; NIMBUS2 SÖHNE", ["Email"], ["nimbus", "söhne"], ["A@b.co", "nimbus"],
    )], "doc_id int, text string, pii_categories array<string>, pii_included_terms array<string>, pii_excluded_terms array<string>")
    m = S.MASK
    assert redact.redact(df).first().text == f"Project {m} of {m}, call +1 (743) 555-3824 or a@b.co; NIMBUS2 {m}"
    tagged = redact.pseudonymize(df).first().text
    assert tagged == f"Project {m} of {m}, call +1 (743) 555-3824 or a@b.co; NIMBUS2 {m}"


def test_chosen_categories_are_found_or_refused(spark):
    df = texts(spark, "Ines Otálora, mail@x.com", None, "Ines")
    with pytest.raises(ValueError, match="Person"):
        redact.redact(df, ["Person", "Email"])
    ruled = df.withColumn("pii_categories", F.array(F.lit("Person")))
    with pytest.raises(Exception, match="no pattern finds"):
        redact.redact(ruled).collect()
    people = spark.createDataFrame([("Ines Otálora", "Person"), ("Ines", "Person")], "phrase string, category string")
    found = detect.detect_dictionary(df, people)
    got = lambda out: [r.text for r in out.orderBy("doc_id").collect()]
    assert got(redact.redact(df, found=found)) == [f"{S.MASK}, {S.MASK}", None, S.MASK]
    assert got(redact.redact(df, ["Person"], found)) == [f"{S.MASK}, mail@x.com", None, S.MASK]
    assert got(redact.redact(ruled, found=found)) == [f"{S.MASK}, mail@x.com", None, S.MASK]
    assert got(redact.pseudonymize(df, found=found)) == ["[Person 1], [Email 1]", None, "[Person 1]"]


def test_masks_do_not_tell_lengths(spark):
    out = [r.text for r in redact.redact(texts(spark, "a@b.co", "a.very.long.name@mail.example.com", None)).orderBy("doc_id").collect()]
    assert out == [S.MASK, S.MASK, None]


def test_tags_are_numbered_by_first_appearance(spark):
    text = "b@x.co a@x.co B@X.co 2024-01-02 a@x.co"
    df = texts(spark, text).withColumn("lang", F.lit("fr"))
    row = redact.pseudonymize(df, lang="lang").first()
    assert row.text == "[Courriel 1] [Courriel 2] [Courriel 1] [Date 1] [Courriel 2]"
    table = entities.correspondence_table(entities.document_mentions(redact.pseudonymize(df, lang="lang")))
    assert {(r.placeholder, r.original) for r in table.collect()} == {("[Courriel 1]", "b@x.co"), ("[Courriel 2]", "a@x.co"), ("[Date 1]", "2024-01-02")}


def test_model_spans_cover_whole_texts(spark):
    model = lambda text: [(m.start(), m.end(), "Person") for m in re.finditer("Anna", text)]
    long = "é " * 50_000 + "Anna"
    rows = detect.detect_with(texts(spark, "Anna and Anna", None, long), model).orderBy("doc_id", "start").collect()
    assert [(r.doc_id, r.start, r.surface) for r in rows] == [(0, 0, "Anna"), (0, 9, "Anna"), (2, 100_000, "Anna")]


def test_dictionary_against_plain_python(spark):
    rng = random.Random(3)
    words = ["Anna", "Keller", "acme", "AG", "of", "Zürich", "x-1"]
    docs = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(50)]
    phrases = ["Anna Keller", "keller", "Acme AG", "Zürich", "AG of Zürich", "absent"]
    gazetteer = spark.createDataFrame([(p, "Person") for p in phrases], "phrase string, category string")
    found = {(r.doc_id, r.start, r.end, r.surface) for r in detect.detect_dictionary(texts(spark, *docs), gazetteer).collect()}
    expected = set()
    for i, d in enumerate(docs):
        for p in phrases:
            for m in re.finditer(rf"(?i)(?<!\w)(?={p}(?!\w))", d):
                expected.add((i, m.start(), m.start() + len(p), d[m.start():m.start() + len(p)]))
    # "x-1" is two words, so nothing but real words may touch a phrase here.
    assert found == expected


def test_names_share_a_tag(spark):
    forms = ["Keller", "Anna Keller", "Ms Keller", "Bob Keller", "Keller", "A. Keller", "Dr. B. Keller", "C. Keller", "Mr Smith", "M. Keller"]
    people = ["anna keller", "anna keller", "anna keller", "bob keller", "bob keller", "anna keller", "bob keller", "c keller", "smith", "bob keller"]
    df = spark.createDataFrame([(1, i, "Person", s) for i, s in enumerate(forms)], "doc_id int, pos int, category string, surface string")
    for width in (1, 2, 1000):
        linked = entities.link_mentions(df, width)
        assert [r.entity for r in linked.orderBy("pos").collect()] == people
        assert [r.entity for r in entities.assign_tags(linked, width).orderBy("number").collect()] == ["anna keller", "bob keller", "c keller", "smith"]


def test_name_pipeline(spark):
    docs = texts(spark, "Anna Keller met Bob Marsh. Ms Keller and A. Keller left; Marsh stayed.", "Nobody.")
    people = spark.createDataFrame([("Anna Keller",), ("Bob Marsh",)], "name string")
    out = entities.pseudonymize_names(docs, detect.name_phrases(people)).orderBy("doc_id").collect()
    assert [r.text for r in out] == ["[Person 1] met [Person 2]. [Person 1] and [Person 1] left; [Person 2] stayed.", "Nobody."]


def test_numbering_of_a_group_that_holds_most_rows(spark):
    rows = [("hot", i * 3) for i in range(500)] + [(f"k{i}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, o bigint")
    for width in (1, 7, 100_000):
        got = ordered.numbered(df, ["k"], "o", "n", width).where("k = 'hot'").orderBy("o").collect()
        assert [r.n for r in got] == list(range(1, 501))
        back = ordered.as_of(df, ["k"], "o", F.when(F.col("o") % 30 == 15, F.col("o")), "v", width)
        for r in back.where("k = 'hot'").collect():
            before = [o for o in range(15, r.o, 30)]
            assert r.v == (before[-1] if before else 15)


def test_pages_come_apart_and_together(spark):
    text = "## Page 1\n\n[Person 1] sold the flat to [Org 1].\n\n## Page 2\n\nRené\n"
    split = pages.split_pages(texts(spark, text, "no heading"))
    assert [(r.doc_id, r.page_no, r.text) for r in split.orderBy("doc_id", "page_no").collect()] == [
        (0, 1, "[Person 1] sold the flat to [Org 1]."), (0, 2, "René"), (1, 1, "no heading"),
    ]
    assert pages.assemble_pages(split.where("doc_id = 0")).first().text == text
    cover = "Cover, a@b.co\n\n## Page 1\n\none\n\n\n## Page 2\n\n\n\nlast\n"
    split_cover = pages.split_pages(texts(spark, cover))
    assert [(r.page_no, r.text) for r in split_cover.orderBy("page_no").collect()] == [(0, "Cover, a@b.co"), (1, "one\n"), (2, "\n\nlast")]
    assert pages.assemble_pages(split_cover).first().text == cover
    volumes = pages.assemble_pages(split.where("doc_id = 0"), volume=1).orderBy("volume").collect()
    assert "\n".join(r.text for r in volumes) == text


def test_preview_does_page_one_only(spark):
    split = spark.createDataFrame([(1, 1, "a@b.co, 2024-01-02, a@b.co"), (1, 2, "c@d.co")], "doc_id int, page_no int, text string")
    row = pages.first_page_preview(split, mode="pseudonymize").first()
    assert row.text == "[Email 1], [Date 1], [Email 1]" and (row.total_pages, row.redacted_pages) == (2, 1)
    assert [tuple(d) for d in row.detected_pii] == [("Date", 1), ("Email", 2)] and row.tags == ["[Date 1]", "[Email 1]"]


RULES = "request_id string, pii_categories array<string>, pii_included_terms array<string>, pii_excluded_terms array<string>, retention string, mode string"


@pytest.mark.parametrize("row, expected", [
    (([], None, None), "error"), ((["   "], None, None), "error"), (([None], None, None), "error"),
    ((None, ["Project Nimbus", "  "], ["  ", ""]), (None, ["Project Nimbus"], None)),
    (([" Email "], [" x "], None), ([" Email "], [" x "], None)),
])
def test_clean_rules(spark, row, expected):
    out = rules.clean_rules(spark.createDataFrame([("r", *row, "studio", "redact")], RULES)).first()
    if expected == "error":
        assert out.error == "invalid_request"
    else:
        assert out.error is None and (out.pii_categories, out.pii_included_terms, out.pii_excluded_terms) == expected


@pytest.mark.parametrize("row, broken", [
    ((["SocialSecurity"], None, None, None, None), ["categories_unknown"]),
    ((["Email"] * 9, None, None, None, None), ["categories_count"]),
    (([], None, None, None, None), ["categories_count"]),
    ((None, ["x"] * 501, None, None, None), ["included_count"]),
    ((None, None, ["x" * 501], None, None), ["excluded_length"]),
    ((None, ["x" * 500] * 500, None, "studio", "redact"), []),
    ((None, None, None, "forever", "blur"), ["mode_unknown", "retention_unknown"]),
])
def test_validate_rules(spark, row, broken):
    assert rules.validate_rules(spark.createDataFrame([("r", *row)], RULES)).first().violations == broken


def test_rules_by_language_do_not_gather_texts(spark):
    """The rules come from a table beyond the planner's limit for a broadcast, but are few: texts are joined where they lie."""
    from maskloom.plans import texts
    from maskloom.plans.common import Tables

    t = Tables(spark, "/root/testdata/sf0.1")
    docs = t.documents.select("text", F.col("lang").alias("request_id"))
    for sql in (texts._RULES_SPARK, texts._SPAN_RULES.replace("{array}", "array")):
        joined = texts.rules.attach_rules(docs, texts._rules(t, sql))
        assert "SortMergeJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in texts.rules.attach_rules(docs, t.sql(sql))._jdf.queryExecution().executedPlan().toString()
