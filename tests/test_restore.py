"""Putting originals back: row fixtures of tables, texts and Word parts."""

import random

import pytest
from pyspark.sql import functions as F

from maskloom.operators import restore, runs
from maskloom.sources import correspondence

# A lease: quotes in a cell, a formula guard, an accent, an ampersand, an original that was not kept.
LEASE = (
    "﻿placeholder,label,category,original\n"
    "[Person 1],[Tenant],Person,Ines Otálora\n"
    '[Person 2],,Person,"van Dijk ""Bo"", Bram"\n'
    "[Address 1],,Address,Quay 7 & 9\n"
    "[Org 1],,Organization,'@home Ltd\n"
    "[Card 1],,CreditCard,\n"
)


def parse(spark, csv, doc="d"):
    return correspondence.parse_correspondence(spark.createDataFrame([(doc, csv)], "doc_id string, value string"))


def run(spark, text, csv=LEASE):
    texts = spark.createDataFrame([("d", text)], "doc_id string, text string")
    row = restore.restore_text(texts, parse(spark, csv)).first()
    return row.text, row.replacements, row.tags_restored, row.unresolved_tags, row.ambiguous_tags


def table(*rows):
    return "placeholder,label,category,original\n" + "\n".join(rows)


def test_table_undoes_quotes_bom_and_guard(spark):
    rows = {r.placeholder: (r.label, r.original) for r in parse(spark, LEASE).collect()}
    assert rows == {
        "[Person 1]": ("[Tenant]", "Ines Otálora"), "[Person 2]": ("", 'van Dijk "Bo", Bram'), "[Address 1]": ("", "Quay 7 & 9"),
        "[Org 1]": ("", "@home Ltd"), "[Card 1]": ("", ""),
    }


@pytest.mark.parametrize("cell, original", [
    ("'n Beeck", "'n Beeck"), ('"first\r\nsecond"', "first\r\nsecond"), ('"left"right', "leftright"), ('12" disc', '12" disc'),
    ("end\r\n\r\n,,,", "end"),
])
def test_table_cells(spark, cell, original):
    assert [r.original for r in parse(spark, table(f"[Org 3],,Organization,{cell}")).collect()] == [original]


@pytest.mark.parametrize("csv, message", [
    ("first,last\nInes,Otálora\n", "lacks the column"), ("", "lacks the column"), ("just a line", "lacks the column"),
    (table("[Org 2],,Organization,x", '[Person 1],,Person,"Ines\n'), "record 3 never ends"),
    (table('[Person 1],,Person,"so ""called Ines\n'), "record 2 never ends"),
])
def test_table_refused_without_quoting_it(spark, csv, message):
    with pytest.raises(Exception) as error:
        parse(spark, csv).collect()
    assert message in str(error.value) and "Ines" not in str(error.value)


@pytest.mark.parametrize("text, expected", [
    ("Keys of [Address 1] go from [Org 1] to [Tenant], later to [Person 2]; [Person 1] pays.",
     ('Keys of Quay 7 & 9 go from @home Ltd to Ines Otálora, later to van Dijk "Bo", Bram; Ines Otálora pays.', 5, 5, [], [])),
    ("[Org 12] is not [Org 1]", ("[Org 12] is not @home Ltd", 1, 1, ["[Org 12]"], [])),
    (r"from \[Org 1\]", ("from @home Ltd", 1, 1, [], [])),
    (r"\[Org 1] or [Org 1\]?", ("@home Ltd or @home Ltd?", 2, 1, [], [])),
    ("paid by [Card 1]", ("paid by [Card 1]", 0, 0, ["[Card 1]"], [])),
    ("clause [7] of [the lease]", ("clause [7] of [the lease]", 0, 0, [], [])),
    ("plain", ("plain", 0, 0, [], [])),
])
def test_text(spark, text, expected):
    assert run(spark, text) == expected


@pytest.mark.parametrize("rows, text, expected", [
    # Characters that a replacement pattern would read.
    (["[Org 4],,Organization,\\1 & $0"], "to [Org 4]", ("to \\1 & $0", 1, 1, [], [])),
    # One rename for two originals says nothing; for one original it does.
    (["[Person 1],[Guarantor],Person,Lea Brandt", "[Person 2],[Guarantor],Person,Tom Ruiz"],
     "[Person 2] or [Person 1], whoever is [Guarantor]",
     ("Tom Ruiz or Lea Brandt, whoever is [Guarantor]", 2, 2, [], ["[Guarantor]"])),
    (["[Person 1],[Guarantor],Person,Lea Brandt", "[Person 2],[Guarantor],Person,Lea Brandt"], "[Guarantor]", ("Lea Brandt", 1, 1, [], [])),
    # An original that looks like a tag is put in as it is, and not looked up.
    (["[Address 2],,Address,[Flat 3] Quay"], "at [Address 2]", ("at [Flat 3] Quay", 1, 1, [], [])),
    (["[Address 2],,Address,[Flat 3] Quay"], "at [Flat 3] Quay", ("at [Flat 3] Quay", 0, 0, [], [])),
    (["[Person 5],[Agent],Person,"], "ask [Agent]", ("ask [Agent]", 0, 0, ["[Agent]"], [])),
    # Tags with brackets inside, found by their length; the longest wins where two start together.
    (["[Person 1],[a [b] c],Person,X", "[Org 1],[b],Organization,Y"], r"[a [b] c] \[a [b] c\] [b] [a [b] d]", ("X X Y [a Y d]", 4, 2, [], [])),
    (["[Person 1],a [x],Person,X", "[],,Person,Y"], "a [x] []", ("a [x] []", 0, 0, [], [])),
])
def test_text_with_table(spark, rows, text, expected):
    assert run(spark, text, table(*rows)) == expected


def test_many_texts_share_one_table(spark):
    texts = spark.range(200).select(F.col("id").alias("text_id"), F.lit("d").alias("doc_id"), F.lit("<[Org 1]>").alias("text"))
    done = restore.restore_text(texts, parse(spark, LEASE), ["text_id"])
    assert done.select("text").distinct().collect()[0].text == "<@home Ltd>" and done.count() == 200


def test_few_rows_of_a_table_restore_without_a_join_by_tag(spark):
    """every candidate of a text was a row joined and grouped; the join stays for long tables, with the same rows."""
    rows = ["[Person 1],[Guarantor],Person,Lea Brandt", "[Person 2],[Guarantor],Person,Tom Ruiz", "[Org 1],[a [b] c],Organization,[Flat 3] Quay",
            "[Date 1],,Date,", "[x\\\\y],,Person,Z", "[Ärzte 1],,Person,É"]
    values = [
        "[Guarantor] \\[Person 1] [Person 1\\] [a [b] c] \\[a [b] c\\] [a [b]] [Flat 3]", "[Date 1] [Date 2\n] [Ärzte 1] [Ünf 12] [É 12345] [x\\\\y] [[Org 1]]", "", None, "[", "none",
        "[Person 1][Person 2]🙂[Org 1]", "\\[Guarantor\\]",
    ]
    texts = spark.createDataFrame([(i, "d" if i else "e", v) for v in values for i in (0, 1)], "n int, doc_id string, text string")
    texts = texts.withColumn("k", F.monotonically_increasing_id()).localCheckpoint()
    longer = parse(spark, table(*rows)).localCheckpoint()
    here = restore.restore_text(texts, longer, ["k"])
    assert here._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    both = restore.restore_text(texts, longer, ["k"], few=2)
    old = restore._restored_by_tag(texts, longer, ["k"], "doc_id")
    assert sorted(map(repr, here.collect())) == sorted(map(repr, both.collect())) == sorted(map(repr, old.collect()))


def test_restoring_twice_changes_nothing_more(spark):
    texts = spark.createDataFrame([("d", "[Person 8] wrote [Tenant] about [Person 2].")], "doc_id string, text string")
    once = restore.restore_text(texts, parse(spark, LEASE)).select("doc_id", "text")
    assert restore.restore_text(once, parse(spark, LEASE)).first().text == once.first().text


def test_csv_round_trip(spark, tmp_path):
    first = parse(spark, LEASE).withColumn("doc_id", F.lit(1))
    correspondence.write_correspondence(first, str(tmp_path / "t"), by="doc_id")
    again = correspondence.read_correspondence(spark, str(tmp_path / "t" / "doc_id=1" / "*.csv"))
    names = ["placeholder", "label", "category", "original"]
    assert sorted(map(tuple, again.select(*names).collect())) == sorted(map(tuple, first.select(*names).collect()))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        correspondence.write_correspondence(first, str(tmp_path / "t"))


# A tag cut over four runs, one in the middle of a run, escapes in a run that changes.
BODY = (
    "<w:p><w:r><w:t>[Tenant]</w:t></w:r><w:t> rents [Addr</w:t><w:t>ess</w:t><w:t> </w:t><w:t>1] from [Org 1] &amp; heirs</w:t>"
    '<w:t xml:space="preserve">, card [Card 7].</w:t></w:p>'
)
PARTS = [
    ("f", "word/document.xml", BODY), ("f", "word/header1.xml", "<w:t>[Address 1], ground floor</w:t>"), ("f", "word/footer1.xml", "<w:t>2 of 2</w:t>"),
    ("f", "word/styles.xml", "<w:t>[Org 1]</w:t>"), ("g", "x", ""),
]


def word(spark):
    parts = spark.createDataFrame(PARTS, "file_id string, part string, xml string")
    return parts, parse(spark, LEASE, "f").withColumnRenamed("doc_id", "file_id")


def test_tag_cut_over_runs(spark, monkeypatch):
    parts, tags = word(spark)
    expected = [
        ("Ines Otálora", True), (" rents Quay 7 & 9", True), ("", True), ("", True), (" from @home Ltd & heirs", True), (", card [Card 7].", False),
    ]
    for stretch in (1024, 3):
        monkeypatch.setattr(runs, "_STRETCH", stretch)
        done = runs.restore_runs(runs.extract_runs(parts), tags)
        body = done.where("part = 'word/document.xml'").orderBy("run_no").collect()
        assert [(r.text, r.changed) for r in body] == expected


def test_parts_keep_what_is_not_changed(spark):
    parts, tags = word(spark)
    done = {r.part: r.xml for r in runs.rebuild_part_xml(parts, runs.restore_runs(runs.extract_runs(parts), tags)).collect()}
    assert done["word/footer1.xml"] == PARTS[2][2] and done["word/styles.xml"] == PARTS[3][2]
    body = done["word/document.xml"]
    assert body.startswith('<w:p><w:r><w:t xml:space="preserve">Ines Otálora</w:t></w:r>') and body.endswith(", card [Card 7].</w:t></w:p>")
    assert " from @home Ltd &amp; heirs" in body and "Quay 7 &amp; 9, ground floor" in done["word/header1.xml"]


def test_report_counts_and_never_names(spark):
    parts, tags = word(spark)
    rows = {r.file_id: r for r in runs.restore_report(parts, tags).collect()}
    assert rows["f"][1:] == ("restored", 4, 3, ["[Card 7]"], []) and rows["g"].status == "invalid_request"
    assert "Ines" not in str(rows)


def test_entities_are_read_once(spark):
    df = spark.createDataFrame([("&amp;gt; &#98;&#x1F680; &apos;&quot;&gt;&lt; &copy; & x",)], "t string")
    assert df.select(runs.decode_xml(F.col("t"))).first()[0] == "&gt; b🚀 '\">< &copy; & x"


def test_leaks_are_found(spark):
    outputs = spark.createDataFrame([("d", "[Person 1] is INES"), ("d", "signed Ines Otálora."), ("e", "Ines Otálora")], "doc_id string, text string")
    assert [tuple(r) for r in restore.leak_scan(outputs, parse(spark, LEASE)).collect()] == [("d", "[Person 1]")]
    found = restore.leak_scan_words(outputs, parse(spark, LEASE).where("original <> ''"))
    assert {tuple(r) for r in found.collect()} == {("d", "ines otálora"), ("e", "ines otálora")}


def test_leaks_of_many_originals_are_found_like_those_of_few(spark):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abé") for _ in range(n))
    tags = spark.createDataFrame([("d", f"[P {i}]", "", "", word(rng.randint(1, 7))) for i in range(40)], "doc_id string, placeholder string, label string, category string, original string")
    outputs = spark.createDataFrame([("d", word(30)), ("d", word(12)), ("e", word(50)), ("d", None), ("d", "")], "doc_id string, text string")
    texts, originals = [r.text for r in outputs.where("doc_id = 'd'").collect()], tags.collect()
    expected = {("d", r.placeholder) for r in originals if any(r.original in x for x in texts if x)}
    for listed in (1_000, 5):
        assert {tuple(r) for r in restore.leak_scan(outputs, tags, listed=listed).collect()} == expected
