"""Queries over texts: detection, redaction, pages, routing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions import files
from maskloom.functions.spans import MASK
from maskloom.operators import detect, pages, redact, rules
from maskloom.plans.common import NOTES, Tables, checked, hits_sql, query, rewritten_sql
from maskloom.session import checkpoint_dir
from maskloom.sources import documents as D
from maskloom.sources import outputs

DOCS = "SELECT doc_id, text FROM documents"
NOTES_CHECK = checked(NOTES)
MASKED = f"CASE WHEN category IS NOT NULL THEN '{MASK}' END"


def _documents(t: Tables, *columns: str) -> DataFrame:
    return t.texts("documents", "doc_id", "text", *columns)


@query(f"""WITH {hits_sql(DOCS)}
SELECT doc_id, first AS start, first + length(hit) AS "end", category, sha256(hit) AS surface
FROM spans WHERE category IS NOT NULL""")
def pattern_spans(t: Tables) -> DataFrame:
    """Where the categories with a written form are in the documents; surfaces hashed."""
    found = detect.detect_patterns(_documents(t))
    return found.select("doc_id", "start", "end", "category", F.sha2("surface", 256).alias("surface"))


@query(f"""WITH {hits_sql(NOTES_CHECK)}
SELECT category, count(*) AS masks, count(DISTINCT doc_id) AS documents, count(DISTINCT hit) AS surfaces
FROM spans WHERE category IS NOT NULL GROUP BY category""")
def note_patterns(t: Tables) -> DataFrame:
    """The same on notes rich in cards and account numbers, right and wrong."""
    found = detect.detect_patterns(t.notes())
    return found.groupBy("category").agg(
        F.count(F.lit(1)).alias("masks"), F.countDistinct("doc_id").alias("documents"),
        F.countDistinct("surface").alias("surfaces"),
    )


@query(f"WITH {hits_sql(DOCS)}, {rewritten_sql(DOCS, MASKED)} SELECT doc_id, text FROM rewritten")
def redact_documents(t: Tables) -> DataFrame:
    return redact.redact(_documents(t))


_TURNS = "SELECT conv_id, turn, text FROM conversations"


@query(f"WITH {hits_sql(_TURNS, 'conv_id, turn')}, {rewritten_sql(_TURNS, MASKED, 'conv_id, turn')} SELECT conv_id, turn, text FROM rewritten")
def redact_conversations(t: Tables) -> DataFrame:
    return redact.redact(t.texts("conversations", "conv_id", "turn", "text"))


_PAGES = "SELECT page_id, html AS text FROM pages"


@query(f"WITH {hits_sql(_PAGES, 'page_id')}, {rewritten_sql(_PAGES, MASKED, 'page_id')} SELECT page_id, text FROM rewritten")
def redact_pages(t: Tables) -> DataFrame:
    return redact.redact(t.texts("pages", "page_id", "html").withColumnRenamed("html", "text"))


@query(f"""WITH {hits_sql(DOCS)}
SELECT category, count(*) AS masks, count(DISTINCT doc_id) AS documents FROM spans WHERE category IS NOT NULL GROUP BY category""")
def pii_summary(t: Tables) -> DataFrame:
    return redact.pii_summary(detect.detect_patterns(_documents(t)))


@query(f"""WITH {hits_sql(DOCS)}
SELECT source, lang, category, count(*) AS masks, CAST(grouping(source, lang, category) AS BIGINT) AS level
FROM spans JOIN documents USING (doc_id) WHERE category IS NOT NULL GROUP BY ROLLUP (source, lang, category)""")
def pii_rollup(t: Tables) -> DataFrame:
    return redact.pii_rollup(detect.detect_patterns(_documents(t)), t.documents)


# Rules by language: which categories, and terms to always or never remove.
_RULES = """SELECT lang AS request_id,
  CASE WHEN lang IN ('en', 'de') THEN {array}('Email', 'PhoneNumber') WHEN lang = 'fr' THEN {array}('CreditCard') END AS pii_categories,
  CASE WHEN lang = 'en' THEN {array}('the', 'of') WHEN lang = 'de' THEN {array}('die', 'der') WHEN lang = 'fr' THEN {array}('de la', 'un') ELSE {array}('el') END AS pii_included_terms,
  CASE WHEN lang = 'es' THEN {array}('EL', '4465758382889437') ELSE {array}('THE') END AS pii_excluded_terms
FROM (SELECT DISTINCT lang FROM {documents}) AS langs"""
_RULES_SPARK = _RULES.replace("{array}", "array")
_RULES_CHECK = checked(_RULES).replace("{array}", "list_value")


def _rules(t: Tables, sql: str) -> DataFrame:
    """Rules by language, written once: the planner then knows that they are few and leaves the texts where they lie.

    Joined as they are, they count as large as the documents they come from, and all texts of a language meet in one task.
    """
    rules, place = t.sql(sql), f"{checkpoint_dir(t.spark)}/rules-{uuid.uuid4().hex}"
    rules.write.parquet(place)
    return t.spark.read.schema(rules.schema).parquet(place)


@query(f"""WITH {hits_sql(DOCS)}, rules AS ({_RULES_CHECK})
SELECT doc_id, first AS start, category FROM spans JOIN documents USING (doc_id) JOIN rules ON lang = request_id
WHERE category IS NOT NULL AND (pii_categories IS NULL OR list_contains(pii_categories, category))""")
def category_filter(t: Tables) -> DataFrame:
    """Spans of the categories the rules of their language choose."""
    spans = detect.detect_patterns(_documents(t, "lang"), keys=["doc_id", "lang"]).withColumnRenamed("lang", "request_id")
    return rules.filter_categories(spans, _rules(t, _RULES_SPARK)).select("doc_id", "start", "category")


@query(f"""WITH {hits_sql(DOCS)}, rules AS ({_RULES_CHECK})
SELECT doc_id, first AS start, category FROM spans JOIN documents USING (doc_id) JOIN rules ON lang = request_id
WHERE category IS NOT NULL AND NOT EXISTS (SELECT 1 FROM (SELECT unnest(pii_excluded_terms) AS term) AS terms WHERE lower(term) = lower(hit))""")
def excluded_spans(t: Tables) -> DataFrame:
    """Spans left when those that are an excluded term of their language are taken out."""
    spans = detect.detect_patterns(_documents(t, "lang"), keys=["doc_id", "lang"]).withColumnRenamed("lang", "request_id")
    return rules.exclude_terms(spans, _rules(t, _RULES_SPARK)).select("doc_id", "start", "category")


# The check walks words: a word is what stands between other characters, so a term of one or two
# words is found by comparing neighbours instead of by a pattern. The corpus writes terms in plain
# single-blank form; the separators must be exactly one blank for a two-word term.
@query(f"""WITH rules AS ({_RULES_CHECK}),
words AS (SELECT doc_id, lang, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) AS word,
    generate_subscripts(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), 1) AS i,
    unnest(string_split_regex(text, '[\\p{{L}}\\p{{N}}_]+')[2:]) AS after FROM documents),
paired AS (SELECT *, lower(word) AS w, lower(lead(word) OVER (PARTITION BY doc_id ORDER BY i)) AS next FROM words),
terms AS (SELECT request_id, unnest(pii_included_terms) AS term FROM rules)
SELECT lang, term, count(*) AS hits, count(DISTINCT doc_id) AS documents FROM paired JOIN terms ON lang = request_id
WHERE (strpos(term, ' ') = 0 AND w = term)
   OR (strpos(term, ' ') > 0 AND after = ' ' AND w = split_part(term, ' ', 1) AND next = split_part(term, ' ', 2))
GROUP BY lang, term""")
def include_terms(t: Tables) -> DataFrame:
    """How often each always-redact term stands in the documents of its language."""
    docs = rules.attach_rules(_documents(t, "lang").withColumnRenamed("lang", "request_id"), _rules(t, _RULES_SPARK))
    found = detect.detect_terms(docs, keys=["doc_id", "request_id"])
    return found.groupBy(F.col("request_id").alias("lang"), F.lower("surface").alias("term")).agg(
        F.count(F.lit(1)).alias("hits"), F.countDistinct("doc_id").alias("documents")
    )


# Single-word terms: words in order, masked or not, and the matches of the chosen categories, all put together again.
_SPAN_RULES = """SELECT lang AS request_id, CASE WHEN lang = 'en' THEN {array}('Email', 'PhoneNumber') END AS pii_categories,
  {array}(CASE lang WHEN 'en' THEN 'the' WHEN 'fr' THEN 'un' WHEN 'de' THEN 'die' ELSE 'el' END) AS pii_included_terms,
  {array}('4465758382889437', 'THE') AS pii_excluded_terms FROM (SELECT DISTINCT lang FROM {documents}) AS langs"""
_SPAN_RULES_CHECK = checked(_SPAN_RULES).replace("{array}", "list_value")


@query(f"""WITH {hits_sql(DOCS)}, rules AS ({_SPAN_RULES_CHECK}),
words AS (SELECT doc_id, lang, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) AS word,
    unnest(string_split_regex(text, '[\\p{{L}}\\p{{N}}_]+')[:-2]) AS gap,
    generate_subscripts(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), 1) AS i FROM documents),
placed_words AS (SELECT *, sum(length(gap) + length(word)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM words),
marks AS (
  SELECT doc_id, CAST(stop - length(word) AS BIGINT) AS a, CAST(stop AS BIGINT) AS b, 0 AS rank, 'Custom' AS category
  FROM placed_words JOIN rules ON lang = request_id WHERE lower(word) = pii_included_terms[1]
  UNION ALL
  SELECT doc_id, first, first + length(hit), 1, category FROM spans JOIN documents USING (doc_id) JOIN rules ON lang = request_id
  WHERE category IS NOT NULL AND (pii_categories IS NULL OR list_contains(pii_categories, category))
    AND NOT list_contains(list_transform(pii_excluded_terms, lambda x: lower(x)), lower(hit))),
reach AS (SELECT *, max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM marks),
grouped AS (SELECT *, sum(CASE WHEN before > a THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY a, b) AS g FROM reach)
SELECT doc_id, min(a) AS start, max(b) AS "end", arg_min(category, rank * 1000000000000 - (b - a) * 1000000 + a) AS category
FROM grouped GROUP BY doc_id, g""")
def include_exclude_terms(t: Tables) -> DataFrame:
    """What is removed under rules by language: included terms beat excluded ones, which beat detection."""
    lists = _rules(t, _SPAN_RULES.replace("{array}", "array"))
    docs = rules.attach_rules(_documents(t, "lang").withColumnRenamed("lang", "request_id"), lists)
    return redact.with_spans(docs).select("doc_id", F.explode("spans").alias("s")).select(
        "doc_id", "s.start", "s.end", "s.category"
    )


@query(f"""WITH {hits_sql(DOCS)},
marks AS (
  SELECT doc_id, first AS a, first + length(hit) AS b, 1 AS rank, category FROM spans WHERE category IS NOT NULL
  UNION ALL SELECT doc_id, greatest(first - 3, 0), first + length(hit) - 2, 2, 'Wide' FROM spans WHERE category IS NOT NULL),
reach AS (SELECT *, max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM marks),
grouped AS (SELECT *, sum(CASE WHEN before > a THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY a, b) AS g FROM reach)
SELECT doc_id, min(a) AS start, max(b) AS "end", arg_min(category, rank * 1000000000000 - (b - a) * 1000000 + a) AS category,
  CAST(min(rank) AS BIGINT) AS priority
FROM grouped GROUP BY doc_id, g""")
def resolve_spans(t: Tables) -> DataFrame:
    """Detected spans and wider, weaker ones over them reduced to one per overlap."""
    found = detect.detect_patterns(_documents(t)).select("doc_id", "start", "end", "category", "surface", "priority")
    wide = found.select(
        "doc_id", F.greatest(F.col("start") - 3, F.lit(0)).alias("start"), (F.col("end") - 2).alias("end"),
        F.lit("Wide").alias("category"), "surface", F.lit(2).alias("priority"),
    )
    return detect.resolve_spans(found.unionByName(wide)).drop("surface")


def _marker_model(text: str) -> list[tuple[int, int, str]]:
    """A stand-in for a trained model: quoted tokens after "token =" as organization secrets."""
    import re

    return [(m.start(1), m.end(1), "Organization") for m in re.finditer(r'token = "([0-9a-f]+)"', text)]


@query("""WITH hits AS (SELECT doc_id, unnest(regexp_extract_all(text, 'token = "[0-9a-f]+"')) AS hit FROM documents)
SELECT doc_id, category, count(*) AS spans, CAST(sum(length(hit) - 10) AS BIGINT) AS characters
FROM (SELECT doc_id, hit, 'Organization' AS category FROM hits) AS found GROUP BY doc_id, category""")
def model_spans(t: Tables) -> DataFrame:
    """Spans from a model called on batches of whole texts."""
    found = detect.detect_with(_documents(t), _marker_model)
    return found.groupBy("doc_id", "category").agg(
        F.count(F.lit(1)).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("characters")
    )


# Documents as pages: one page per paragraph line of the document.
@query("""SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS page_no, unnest(string_split(text, chr(10))) AS text FROM documents""")
def page_split(t: Tables) -> DataFrame:
    """Documents written as pages (a line each) with headings, taken apart again."""
    return pages.split_pages(_paged(t)).select("doc_id", "page_no", "text")


def _paged(t: Tables) -> DataFrame:
    lines = F.transform(
        F.split("text", "\n", -1), lambda line, i: F.concat(F.lit("## Page "), i + 1, F.lit("\n\n"), line, F.lit("\n"))
    )
    return _documents(t).select("doc_id", F.array_join(lines, "\n").alias("text"))


@query("""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
SELECT doc_id, CAST(0 AS BIGINT) AS volume, string_agg('## Page ' || n || chr(10) || chr(10) || line || chr(10), chr(10) ORDER BY n) AS text
FROM lines GROUP BY doc_id""")
def page_assemble(t: Tables) -> DataFrame:
    """Pages put together under their headings."""
    lines = _documents(t).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "text"))
    return pages.assemble_pages(lines.select("doc_id", (F.col("i") + 1).alias("page_no"), "text"))


_FIRST = "SELECT doc_id, string_split(text, chr(10))[1] AS text, len(string_split(text, chr(10))) AS total FROM documents"


@query(f"""WITH {hits_sql(_FIRST)}, {rewritten_sql(_FIRST, MASKED)},
masks AS (SELECT doc_id, category, count(*) AS masks FROM spans WHERE category IS NOT NULL GROUP BY doc_id, category),
listed AS (SELECT doc_id, string_agg(category || ':' || masks, ',' ORDER BY category) AS detected FROM masks GROUP BY doc_id)
SELECT doc_id, text, total AS total_pages, CAST(1 AS BIGINT) AS redacted_pages, coalesce(detected, '') AS detected
FROM rewritten LEFT JOIN listed USING (doc_id)""")
def first_page_preview(t: Tables) -> DataFrame:
    """The first page of each document redacted, with what was found on it."""
    done = pages.first_page_preview(pages.split_pages(_paged(t)))
    listed = F.transform("detected_pii", lambda d: F.concat(d["category"], F.lit(":"), d["masks"]))
    return done.select("doc_id", "text", "total_pages", "redacted_pages", F.array_join(listed, ",").alias("detected"))


@query("""SELECT doc_id, octet_length(encode(text)) <= 4096 AS inline, CASE WHEN octet_length(encode(text)) <= 4096 THEN text END AS document_text,
  CAST(octet_length(encode(text)) AS BIGINT) AS document_text_bytes,
  CASE WHEN octet_length(encode(text)) > 4096 THEN '/out/' || doc_id || '-redacted.md' END AS document_text_path
FROM documents""")
def text_routing(t: Tables) -> DataFrame:
    """Texts inline or by reference, by their size in bytes."""
    docs = _documents(t).withColumn("_path", F.concat(F.lit("/out/"), "doc_id", F.lit("-redacted.md")))
    return outputs.route_document_text(docs, max_inline=4096, where="_path").drop("_path", "document_text_note")


@query("""SELECT page_id, octet_length(encode(html)) <= 2048 AS inline,
  CASE WHEN octet_length(encode(html)) <= 2048 THEN md5(base64(encode(html))) END AS content_md5,
  CASE WHEN octet_length(encode(html)) <= 2048 THEN 'application/pdf' END AS content_type,
  CAST(octet_length(encode(html)) AS BIGINT) AS bytes, '/pages/' || page_id AS download_url
FROM pages""")
def payload_routing(t: Tables) -> DataFrame:
    """Outputs as base64 or by reference, by size."""
    raw = t.texts("pages", "page_id", "html").select(
        "page_id", F.encode("html", "UTF-8").alias("bytes"), F.concat(F.lit("/pages/"), "page_id").alias("_at")
    ).withColumnRenamed("bytes", "content")
    routed = outputs.route_payload(raw, "content", max_inline=2048, where="_at")
    return routed.withColumn("content_md5", F.md5("content_base64")).drop("content_base64", "_at")


# Files named after the documents, of every kind.
FILES = """SELECT doc_id, '/in/' || source || '/scan' || CAST(doc_id AS STRING) || CASE doc_id % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PNG'
    WHEN 2 THEN '.jpeg' WHEN 3 THEN '.docx' WHEN 4 THEN '' ELSE '.v2.Pdf' END AS path,
  CASE WHEN doc_id % 11 = 0 THEN 0 ELSE n_chars * 9000 END AS size FROM {documents}"""


@query(f"""WITH f AS ({checked(FILES)}), n AS (SELECT *, regexp_extract(path, '[^/]*$') AS name FROM f),
e AS (SELECT *, CASE WHEN contains(name, '.') THEN '.' || list_last(string_split(name, '.')) ELSE '' END AS ext FROM n),
s AS (SELECT *, path[:length(path) - length(ext)] AS stem FROM e)
SELECT doc_id, stem || '-redacted.pdf' AS redacted_path, stem || '-correspondence.csv' AS correspondence_path,
  stem || '-redacted.md' AS document_text_path, stem || '-restored' || ext AS restored_path FROM s""")
def output_paths(t: Tables) -> DataFrame:
    return D.with_output_paths(t.sql(FILES)).drop("path", "size")


@query(f"""WITH f AS ({checked(FILES)})
SELECT doc_id, CASE WHEN lower(path) LIKE '%.pdf' THEN 'application/pdf' WHEN lower(path) LIKE '%.png' THEN 'image/png'
  WHEN lower(path) LIKE '%.jpg' OR lower(path) LIKE '%.jpeg' THEN 'image/jpeg' END AS content_type FROM f""")
def supported_types(t: Tables) -> DataFrame:
    return t.sql(FILES).select("doc_id", files.supported_type(F.col("path")).alias("content_type"))


_CHECKED = f"""f AS ({checked(FILES)}), k AS (SELECT *, regexp_extract(path, '[^/]*$') AS filename,
  CASE WHEN lower(path) LIKE '%.pdf' THEN 50 WHEN regexp_matches(lower(path), '\\.(png|jpe?g)$') THEN 10 END AS mb FROM f)"""


@query(f"""WITH {_CHECKED}
SELECT doc_id, mb IS NOT NULL AND size BETWEEN 1 AND mb * 1048576 AS ok,
  CASE WHEN mb IS NULL OR size = 0 THEN 'invalid_request' WHEN size > mb * 1048576 THEN 'payload_too_large' END AS code,
  CASE WHEN mb IS NULL THEN 'no type is known for file ' || filename WHEN size = 0 THEN 'file ' || filename || ' holds no bytes'
    WHEN size > mb * 1048576 THEN 'file ' || filename || ' has ' || format('{{:.1f}}', size / 1048576.0) || ' MB of ' || mb || ' allowed in '
      || CASE mb WHEN 50 THEN 'a PDF' ELSE 'an image' END END AS message,
  size <= 5242880 AS preview_ok
FROM k""")
def file_limits(t: Tables) -> DataFrame:
    """Each file against its type and size limits, and the preview's."""
    df = t.sql(FILES).withColumn("filename", files.basename(F.col("path"))).withColumn(
        "content_type", files.supported_type(F.col("path"))
    )
    return D.check_limits(df).withColumn("preview_ok", files.preview_check(F.col("size"))["ok"]).select(
        "doc_id", "ok", "code", "message", "preview_ok"
    )




@query("""WITH raw AS (SELECT doc_id, text, base64(encode(text)) AS b FROM documents)
SELECT doc_id, CASE WHEN doc_id % 5 = 4 OR (doc_id % 5 = 3 AND b IS NOT NULL) OR (doc_id % 5 = 2 AND regexp_matches(b, '[AI]')) THEN 'invalid_request' END AS code,
  CASE WHEN doc_id % 5 = 4 THEN 'file f' || doc_id || '.pdf: base64 without content'
       WHEN (doc_id % 5 = 3 AND b IS NOT NULL) OR (doc_id % 5 = 2 AND regexp_matches(b, '[AI]')) THEN 'file f' || doc_id || '.pdf: base64 that does not decode' END AS message,
  CASE WHEN doc_id % 5 IN (0, 1) OR (doc_id % 5 = 2 AND NOT regexp_matches(b, '[AI]')) THEN md5(text) END AS md5
FROM raw""")
def base64_check(t: Tables) -> DataFrame:
    """Inline base64 refused or decoded."""
    docs = _documents(t).select("doc_id", files.base64_line(F.encode("text", "UTF-8")).alias("b"))
    kind = F.col("doc_id") % 5
    sent = (
        F.when(kind == 4, " ").when(kind == 3, F.concat("b", F.lit("A")))
        .when(kind == 2, F.translate("b", "AI", "-_"))
        .when(kind == 1, F.concat(F.substring("b", 1, 10), F.lit("\n"), F.substr("b", F.lit(11)))).otherwise(F.col("b"))
    )
    ready = docs.select("doc_id", sent.alias("base64"), F.concat(F.lit("f"), "doc_id", F.lit(".pdf")).alias("filename"))
    return D.decode_base64_documents(ready).select("doc_id", "code", "message", F.md5("bytes").alias("md5"))
