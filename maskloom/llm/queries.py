"""The registered queries of this subpackage and the SQL that checks them where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.llm import (
    bpe, chat, decontaminate, fingerprints, jaccard_join, language, licenses, packing, quality, repair, secrets, store, token_files,
    whitening,
)
from maskloom.session import tune

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    table = tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = store.folder(tune(spark), "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents", "doc_id", "text"), folder, TOKENIZER, end_id=2)
    return token_files.read_token_spans(spark, folder)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER, end_id=1)


def _fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    trees = language.train(docs, _fold() != 1)
    return language.identify(docs, trees).select(
        "doc_id", F.coalesce(_fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents", "doc_id", "text"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(secrets.BASE))
    return found.select("doc_id", *map(count, secrets.BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    found = quality.assess(docs, _table(spark, sf_dir, "labels"), F.col("source"), path)
    return found.select("doc_id", "host", "path", "p_quality", "p_toxic", "keep")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text")
    )
    conversations = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.windows(conversations))


def _licenses(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", F.size("hits").cast("long").alias("n_hits"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["license"]))), ",").alias("licenses"),
        F.round(F.coalesce(F.array_max(F.transform("hits", lambda h: h["dice"])), F.lit(0.0)), 9).alias("best_dice"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _licenses(licenses.find_licenses(_table(spark, sf_dir, "documents", "doc_id", "text")))


def op10_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _licenses(licenses.find_notices(_table(spark, sf_dir, "documents", "doc_id", "text")))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.repair_all(conversations, repair.damaged(conversations))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode_and_decode(docs, TOKENIZER, bpe.write_lexicon(docs, TOKENIZER)).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files, op2_decontaminate, op3_pack, op4_language, op5_secrets, op6_fingerprints, op7_quality, op8_jaccard_join,
        op9_chat, op10_licenses, op11_repair, op12_whitening, op13_lexicon_bpe,
    )
}
#: Further queries of an operator that has one already.
MORE = {f.__name__: f for f in (op10_notices,)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM item, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS t(i) WHERE len(w) > 0
), place AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM doc, (SELECT DISTINCT k FROM win) AS ks, unnest(generate_series(1, len(w) - k + 1)) AS t(i) WHERE len(w) >= k
), hit AS (
  SELECT p.doc_id, p.k, p.i, win.item_id FROM place AS p JOIN win ON win.k = p.k AND win.s = p.s
), words AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM hit, unnest(generate_series(0, k - 1)) AS t(j) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM hit GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(doc.w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP8 = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM doc, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS t(i) WHERE len(w) > 0
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingle AS a JOIN shingle AS b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT x, y FROM common JOIN size AS p ON p.doc_id = x JOIN size AS q ON q.doc_id = y WHERE 100 * common.n >= 80 * (p.n + q.n - common.n)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM doc UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y
)
SELECT doc.doc_id, coalesce(size.n, 0) AS n_shingles, first.c AS component_id
FROM doc LEFT JOIN size USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY x) AS first USING (doc_id)
"""

_OP9 = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss
  FROM said GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256 FROM whole
"""


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _op10_sql() -> str:
    rows = ", ".join(f"({_sql_text(name)}, {_sql_text(text)}, {i})" for i, (name, text) in enumerate(licenses.TEMPLATES))
    clean = "string_split(trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    return f"""
WITH template AS (
  SELECT name, no, list_distinct([w[j] || ' ' || w[j + 1] for j in generate_series(1, len(w) - 1)]) AS grams
  FROM (SELECT name, no, {clean.format('text')} AS w FROM (VALUES {rows}) AS v(name, text, no))
), line AS (
  SELECT doc_id, i, CASE WHEN w = [''] THEN [] ELSE w END AS w
  FROM (SELECT doc_id, i, {clean.format("string_split(coalesce(text, ''), chr(10))[i]")} AS w
        FROM documents, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS t(i))
), near AS (
  SELECT a.doc_id, a.i, k, flatten(list(b.w ORDER BY b.i)) AS w
  FROM line AS a, unnest(generate_series(1, {licenses.SPANNING})) AS t(k), line AS b
  WHERE b.doc_id = a.doc_id AND b.i BETWEEN a.i AND a.i + k - 1 AND len(a.w) BETWEEN 1 AND 30
  GROUP BY a.doc_id, a.i, k
  HAVING count(*) = k AND len(arg_max(b.w, b.i)) > 0 AND sum(len(b.w)) <= 30
), grams AS (
  SELECT doc_id, i, k, CASE WHEN len(w) = 1 THEN w ELSE [w[j] || ' ' || w[j + 1] for j in generate_series(1, len(w) - 1)] END AS g FROM near
), hit AS (
  SELECT doc_id, name, 2.0 * len(list_intersect(list_distinct(g), grams)) / (len(g) + len(grams)) AS dice FROM grams, template
  WHERE 2.0 * len(list_intersect(list_distinct(g), grams)) / (len(g) + len(grams)) >= {licenses.THRESHOLD}
)
SELECT d.doc_id, count(name) AS n_hits, coalesce(string_agg(DISTINCT name, ',' ORDER BY name), '') AS licenses,
  CAST(round(coalesce(max(dice), 0.0), 9) AS DOUBLE) AS best_dice
FROM documents AS d LEFT JOIN hit ON hit.doc_id = d.doc_id GROUP BY d.doc_id
"""


ORACLES = {"op2_decontaminate": _OP2, "op8_jaccard_join": _OP8, "op10_licenses": _op10_sql()}
