"""Queries over entities: names, tags, the table of originals, and back again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.labels import LABELS
from maskloom.operators import detect, entities, redact, restore, runs
from maskloom.plans.common import KEY_SQL, MENTIONS, ORACLES, NOTES, Tables, checked, given, hits_sql, query, rewritten_sql, surname
from maskloom.session import checkpoint_dir, kept
from maskloom.sources import correspondence
from maskloom.sources.documents import spread
from maskloom.streaming import texts as streamed

DOCS = "SELECT doc_id, lang, text FROM documents"
NOTES_CHECK = checked(NOTES)
MENTIONS_CHECK = checked(MENTIONS)

LABEL_SQL = "CASE category || '|' || lang " + " ".join(
    f"WHEN '{c}|{lang}' THEN '{word}'" for c, by_lang in LABELS.items() for lang, word in by_lang.items()
) + " END"

# Spans with their entity's key and number: ranked by the first place of the entity in its document.
TAGS = f"""
keyed AS (SELECT s.*, {KEY_SQL} AS key FROM spans AS s),
firsts AS (SELECT *, CASE WHEN category IS NOT NULL THEN min(first) OVER (PARTITION BY doc_id, category, key) END AS seen FROM keyed),
ranked AS (SELECT *, CASE WHEN category IS NOT NULL THEN dense_rank() OVER (PARTITION BY doc_id, category ORDER BY seen) END AS number FROM firsts),
tagged AS (SELECT *, CASE WHEN category IS NOT NULL THEN '[' || {LABEL_SQL} || ' ' || number || ']' END AS tag FROM ranked)"""

# The table of originals out of ``tagged``: the longest form of each, the first of these.
_TABLE = """grouped AS (SELECT doc_id, tag AS placeholder, any_value(category) AS category,
    arg_max(hit, length(hit) * 1000000 - first) AS original FROM tagged WHERE tag IS NOT NULL GROUP BY doc_id, tag)"""


def _tagged_docs(t: Tables) -> DataFrame:
    return redact.pseudonymize(t.texts("documents", "doc_id", "text", "lang"), lang="lang")


def _tagged_notes(t: Tables) -> DataFrame:
    return redact.pseudonymize(t.notes(), lang="lang")


def _stored_notes(t: Tables) -> DataFrame:
    """Tagged notes as someone would have stored them, for queries that read them several times."""
    return kept(_tagged_notes(t))


def _table_of(tagged: DataFrame) -> DataFrame:
    return entities.correspondence_table(entities.document_mentions(tagged))


def _note_mentions(t: Tables) -> DataFrame:
    return entities.pattern_mentions(t.notes(), "lang")


def _note_table(t: Tables) -> DataFrame:
    return entities.correspondence_table(_note_mentions(t))


# ---- Names --------------------------------------------------------------------------------------

PEOPLE = f"SELECT DISTINCT {given('c_custkey')} || ' ' || {surname('c_custkey')} AS name FROM {{customer}}"


@query(f"""WITH notes AS ({NOTES_CHECK}),
phrases AS (SELECT name AS phrase, 'Person' AS category FROM ({checked(PEOPLE)}) UNION ALL SELECT n_name, 'Address' FROM nation),
met AS (SELECT doc_id, category, phrase, text, regexp_extract(lower(text), lower(phrase) || '[^a-z0-9]') AS found
  FROM notes JOIN phrases ON contains(lower(text), lower(phrase)))
SELECT doc_id, strpos(lower(text), found) - 1 AS start, strpos(lower(text), found) - 1 + length(phrase) AS "end", category,
  substr(text, strpos(lower(text), found), length(phrase)) AS surface
FROM met WHERE found <> ''""")
def dictionary_spans(t: Tables) -> DataFrame:
    """People and places of a list found in the notes."""
    people = t.sql(PEOPLE).select(F.col("name").alias("phrase"), F.lit("Person").alias("category"))
    places = t.nation.select(F.col("n_name").alias("phrase"), F.lit("Address").alias("category"))
    return detect.detect_dictionary(t.notes(), people.unionByName(places)).drop("priority")


@query(f"""WITH m AS ({MENTIONS_CHECK}),
p AS (SELECT doc_id, pos, surface, lower(list_last(string_split(surface, ' '))) AS surname,
    CASE WHEN surface LIKE '_. %' THEN lower(surface[1]) END AS initial,
    CASE WHEN surface LIKE '% %' AND surface NOT LIKE 'Ms %' AND surface NOT LIKE '_. %' THEN lower(surface) END AS full_name FROM m),
j AS (SELECT p.doc_id, p.pos, any_value(p.surname) AS surname, any_value(p.initial) AS initial, any_value(p.full_name) AS own,
    arg_max(f.full_name, f.pos) FILTER (f.pos < p.pos) AS before, arg_min(f.full_name, f.pos) FILTER (f.pos > p.pos) AS later,
    arg_max(f.full_name, f.pos) FILTER (f.pos < p.pos AND f.full_name[1] = p.initial) AS before_i,
    arg_min(f.full_name, f.pos) FILTER (f.pos > p.pos AND f.full_name[1] = p.initial) AS later_i
  FROM p LEFT JOIN p AS f ON f.doc_id = p.doc_id AND f.surname = p.surname AND f.full_name IS NOT NULL GROUP BY p.doc_id, p.pos)
SELECT doc_id, pos, CASE WHEN own IS NOT NULL THEN own WHEN initial IS NULL THEN coalesce(before, later, surname)
  WHEN initial = 'm' THEN coalesce(before_i, later_i, before, later, 'm ' || surname)
  ELSE coalesce(before_i, later_i, initial || ' ' || surname) END AS entity FROM j""")
def link_mentions(t: Tables) -> DataFrame:
    """Which person each mention of an order stands for."""
    return entities.link_mentions(t.sql(MENTIONS)).select("doc_id", "pos", "entity")


@query(f"""WITH notes AS ({NOTES_CHECK})
SELECT o.o_orderkey AS doc_id, replace(replace(text, {given('c_custkey')} || ' ' || {surname('c_custkey')}, '[Person 1]'),
  split_part('Mr,Ms,Dr', ',', CAST(o_orderkey % 3 AS INT) + 1) || ' ' || {surname('c_custkey')}, '[Person 1]') AS text
FROM notes JOIN orders AS o ON doc_id = o.o_orderkey JOIN customer ON o_custkey = c_custkey""")
def name_pseudonyms(t: Tables) -> DataFrame:
    """Notes with people as tags: found by list, variants linked, numbered, written in."""
    notes = t.notes().select("doc_id", "text")
    return entities.pseudonymize_names(notes, detect.name_phrases(t.sql(PEOPLE)))


# ---- Everything at once ---------------------------------------------------------------------------

# The notes with a place, a firm and rules of their own: categories left out, terms always or never to go.
FULL_NOTES = f"""SELECT n.doc_id, n.lang, n.text || ' Filed under ' || c_mktsegment || ' Trading by desk ' || CAST(n.doc_id % 9 AS STRING) || '.' AS text,
  c_mktsegment || ' Trading' AS firm, 'NATION_' || CAST(c_nationkey AS STRING) AS place,
  {given('c_custkey')} || ' ' || {surname('c_custkey')} AS full_name,
  split_part('Mr,Ms,Dr', ',', CAST(n.doc_id % 3 AS INT) + 1) || ' ' || {surname('c_custkey')} AS titled
FROM ({NOTES}) AS n, {{orders}}, {{customer}} WHERE n.doc_id = o_orderkey AND o_custkey = c_custkey"""
FULL_CHECK = checked(FULL_NOTES)


def _lists(t: Tables) -> DataFrame:
    """Names, places and firms as one list of phrases."""
    named = lambda df, column, category: df.select(F.col(column).alias("phrase"), F.lit(category).alias("category"))
    firms = t.sql("SELECT DISTINCT c_mktsegment || ' Trading' AS phrase, 'Organization' AS category FROM {customer}")
    return detect.name_phrases(t.sql(PEOPLE)).unionByName(named(t.nation, "n_name", "Address")).unionByName(firms)


def _full_notes(t: Tables) -> DataFrame:
    return spread(t.sql(FULL_NOTES).select("doc_id", "lang", "text", "place"), "doc_id")


def _ruled_notes(t: Tables) -> DataFrame:
    every = F.array(*[F.lit(c) for c in LABELS if c != "Organization"])
    return _full_notes(t).select(
        "doc_id", "lang", "text", F.when(F.col("doc_id") % 11 == 0, every).alias("pii_categories"),
        F.when(F.col("doc_id") % 7 == 0, F.array(F.lit("filed under"))).alias("pii_included_terms"),
        F.when(F.col("doc_id") % 5 == 0, F.array("place")).alias("pii_excluded_terms"),
    )


def _all_sql(person: str, place: str, firm: str, ruled: bool = True) -> str:
    """The names of ``rewritten`` full notes replaced, by the rules where there are any."""
    address = f"CASE WHEN doc_id % 5 = 0 THEN place ELSE {place} END" if ruled else place
    company = f"CASE WHEN doc_id % 11 = 0 THEN firm ELSE {firm} END" if ruled else firm
    text = f"replace(replace(replace(replace(text, full_name, {person}), titled, {person}), place || ' wrote', {address} || ' wrote'), firm, {company})"
    return f"CASE WHEN doc_id % 7 = 0 THEN replace({text}, 'Filed under', '█████') ELSE {text} END" if ruled else text


def _label_sql(category: str) -> str:
    return "'[' || " + LABEL_SQL.replace("category || '|' || lang", f"'{category}|' || lang") + " || ' 1]'"


_FULL_TAGGED = f"""{hits_sql(FULL_CHECK, 'doc_id, lang')}, {TAGS}, {rewritten_sql(FULL_CHECK, 'tag', 'doc_id, lang', 'tagged')}"""
_NAME_TAGS = (_label_sql("Person"), _label_sql("Address"), _label_sql("Organization"))
_MASKS = "CASE WHEN category IS NOT NULL THEN '█████' END"


@query(f"""WITH {hits_sql(FULL_CHECK, 'doc_id, lang')}, {rewritten_sql(FULL_CHECK, _MASKS, 'doc_id, lang')}
SELECT doc_id, {_all_sql("'█████'", "'█████'", "'█████'")} AS text FROM rewritten""")
def redact_all(t: Tables) -> DataFrame:
    """All eight categories out of the notes: patterns, lists of names and each note's own rules."""
    return redact.redact(_ruled_notes(t), phrases=_lists(t)).select("doc_id", "text")


@query(f"WITH {_FULL_TAGGED} SELECT doc_id, {_all_sql(*_NAME_TAGS)} AS text FROM rewritten")
def pseudonymize_all(t: Tables) -> DataFrame:
    """All eight categories as tags, variants of a name under one, by each note's own rules."""
    return redact.pseudonymize(_ruled_notes(t), lang="lang", phrases=_lists(t)).select("doc_id", "text")


def _stored_full(t: Tables) -> DataFrame:
    return kept(redact.pseudonymize(_full_notes(t), lang="lang", phrases=_lists(t)).select("doc_id", "lang", "text", "spans"))


@query(f"SELECT doc_id, replace(text, titled, full_name) AS text FROM ({FULL_CHECK}) AS notes")
def names_round_trip(t: Tables) -> DataFrame:
    """Notes tagged with names and restored: a person comes back by the fullest form of the name."""
    tagged = _stored_full(t)
    return restore.restore_text(tagged.select("doc_id", "text"), kept(_table_of(tagged))).select("doc_id", "text")


@query(f"""WITH {_FULL_TAGGED}, {_TABLE},
names AS (SELECT doc_id, unnest([{_NAME_TAGS[0]}, {_NAME_TAGS[1]}, {_NAME_TAGS[2]}]) AS placeholder FROM rewritten)
SELECT doc_id, placeholder, true AS whole FROM grouped WHERE doc_id % 10 = 0 UNION ALL SELECT doc_id, placeholder, true FROM names WHERE doc_id % 10 = 0
UNION ALL SELECT doc_id, {_NAME_TAGS[0]}, false FROM rewritten WHERE doc_id % 10 = 1
UNION ALL SELECT doc_id, {_NAME_TAGS[2]}, false FROM rewritten WHERE doc_id % 10 = 2""")
def names_leak_scan(t: Tables) -> DataFrame:
    """Outputs with originals, or with a part of one: a surname, a word of a firm; all others are clean."""
    tagged, notes = _stored_full(t), t.sql(FULL_NOTES)
    turn = F.col("doc_id") % 10
    left = notes.where(turn == 0).select("doc_id", "text")
    parts = notes.where(turn.isin(1, 2)).select("doc_id", F.when(turn == 1, F.substring_index("full_name", " ", -1)).otherwise(
        F.substring_index("firm", " ", 1)
    ).alias("_part"))
    written = tagged.where(turn != 0).join(parts, "doc_id", "left").select(
        "doc_id", F.concat("text", F.coalesce(F.concat(F.lit(" ("), "_part", F.lit(")")), F.lit(""))).alias("text")
    )
    return restore.leak_scan(left.unionByName(written), kept(_table_of(tagged)), fragments=True)


# ---- Tags ---------------------------------------------------------------------------------------


@query(f"""WITH {hits_sql(NOTES_CHECK, 'doc_id, lang')}, {TAGS}
SELECT doc_id, category, sha256(key) AS entity, min(first) AS first_pos, any_value(number) AS number
FROM ranked WHERE category IS NOT NULL GROUP BY doc_id, category, key""")
def assign_tags(t: Tables) -> DataFrame:
    """Entities of each note, numbered per category in order of first mention."""
    return _entities(t).select("doc_id", "category", F.sha2("entity", 256).alias("entity"), "first_pos", "number")


def _entities(t: Tables) -> DataFrame:
    masks = entities.export_masks(detect.detect_patterns(t.notes()))
    return entities.assign_tags(masks.withColumn("pos", F.col("start")))


@query(f"""WITH {hits_sql(NOTES_CHECK, 'doc_id, lang')}, {TAGS}
SELECT doc_id, lang, category, number, tag FROM tagged WHERE category IS NOT NULL GROUP BY ALL""")
def localised_tags(t: Tables) -> DataFrame:
    """Tags in the language of each note."""
    notes = t.notes()
    return entities.localise_labels(_entities(t), notes).select("doc_id", "lang", "category", "number", "tag")


@query(f"WITH {hits_sql(DOCS, 'doc_id, lang')}, {TAGS}, {rewritten_sql(DOCS, 'tag', 'doc_id, lang', 'tagged')} SELECT doc_id, text FROM rewritten")
def pseudonymize_documents(t: Tables) -> DataFrame:
    return _tagged_docs(t).select("doc_id", "text")


@query(f"WITH {hits_sql(NOTES_CHECK, 'doc_id, lang')}, {TAGS}, {rewritten_sql(NOTES_CHECK, 'tag', 'doc_id, lang', 'tagged')} SELECT doc_id, text FROM rewritten")
def pseudonymize_notes(t: Tables) -> DataFrame:
    return _tagged_notes(t).select("doc_id", "text")


# Notes of five orders as the turns of one conversation.
TURNS = f"SELECT CAST(floor(doc_id / 5) AS BIGINT) AS conv_id, doc_id % 5 AS turn, 'en' AS lang, text FROM ({NOTES}) AS notes"
TURNS_CHECK = checked(TURNS)


@query(f"""WITH {hits_sql(TURNS_CHECK, 'conv_id, turn, lang')},
keyed AS (SELECT s.*, conv_id AS doc_id, {KEY_SQL} AS key FROM spans AS s),
firsts AS (SELECT *, min(turn * 1000000 + first) OVER (PARTITION BY conv_id, category, key) AS seen FROM keyed),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id, category ORDER BY seen) AS number FROM firsts),
tagged AS (SELECT *, CASE WHEN category IS NOT NULL THEN '[' || {LABEL_SQL} || ' ' || number || ']' END AS tag FROM ranked),
{rewritten_sql(TURNS_CHECK, 'tag', 'conv_id, turn, lang', 'tagged')} SELECT conv_id, turn, text FROM rewritten""")
def pseudonymize_turns(t: Tables) -> DataFrame:
    """Conversations with one numbering over all their turns."""
    return streamed.pseudonymize_turns(spread(t.sql(TURNS).select("conv_id", "turn", "text"), "conv_id", "turn"))


# ---- The table of originals ---------------------------------------------------------------------



@query(f"""WITH {hits_sql(NOTES_CHECK, 'doc_id, lang')}, {TAGS}, {_TABLE}
SELECT doc_id, placeholder, '' AS label, category, sha256(original) AS original FROM grouped""")
def correspondence_table(t: Tables) -> DataFrame:
    """One row per tag of the notes; originals hashed."""
    return _note_table(t).withColumn("original", F.sha2("original", 256))


RENAMES = """SELECT o_orderkey AS doc_id, '[Card 1]' AS placeholder, '[Buyer]' AS label FROM {orders} WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, '[Phone 1]', '[Buyer]' FROM {orders} WHERE o_orderkey % 4 = 0
UNION ALL SELECT o_orderkey, '[Email 1]', '[Buyer]' FROM {orders} WHERE o_orderkey % 8 = 0"""


def _renamed(t: Tables, tagged: DataFrame | None = None) -> DataFrame:
    return entities.apply_renames(_note_table(t) if tagged is None else _table_of(tagged), t.sql(RENAMES))


@query(f"""WITH {hits_sql(NOTES_CHECK, 'doc_id, lang')}, {TAGS}, {_TABLE}, renames AS ({checked(RENAMES)})
SELECT doc_id, placeholder, coalesce(label, '') AS label, category, sha256(original) AS original
FROM grouped LEFT JOIN renames USING (doc_id, placeholder)""")
def renamed_correspondence(t: Tables) -> DataFrame:
    """The table with a user's renames."""
    return _renamed(t).withColumn("original", F.sha2("original", 256))


@query(f"""WITH {hits_sql(NOTES_CHECK, 'doc_id, lang')}, {TAGS}, {_TABLE}, renames AS ({checked(RENAMES)}),
named AS (SELECT doc_id, original, placeholder AS tag FROM grouped UNION ALL
  SELECT doc_id, original, label FROM grouped JOIN renames USING (doc_id, placeholder))
SELECT doc_id, tag, CASE WHEN count(DISTINCT original) = 1 THEN sha256(min(original)) END AS original,
  CASE WHEN count(DISTINCT original) = 1 THEN 'known' ELSE 'ambiguous' END AS state FROM named GROUP BY doc_id, tag""")
def prepare_lookup(t: Tables) -> DataFrame:
    """What each tag or rename stands for."""
    return restore.prepare_lookup(_renamed(t)).withColumn("original", F.sha2("original", 256))


@query(f"""WITH {hits_sql(NOTES_CHECK, 'doc_id, lang')}, {TAGS}
SELECT DISTINCT doc_id, tag AS placeholder, '' AS label, category FROM tagged WHERE category IN ('Date', 'IBAN')""")
def unrestorable_tags(t: Tables) -> DataFrame:
    """Tags whose originals were not stored (here: dates and account numbers)."""
    lost = F.when(F.col("category").isin("Date", "IBAN"), F.when(F.col("category") == "Date", "")).otherwise(F.col("surface"))
    return entities.unrestorable_mentions(_note_mentions(t).withColumn("surface", lost))


_STRINGS = """SELECT event_id, CASE event_id % 7 WHEN 0 THEN '[' || event_type || ' 1]' WHEN 1 THEN '[]' WHEN 2 THEN '[x' WHEN 3 THEN event_type || ']' WHEN 4 THEN '[é]' WHEN 5 THEN '' ELSE '[[' END AS value FROM {events}"""


@query(f"SELECT event_id, regexp_full_match(value, '\\[.+\\]') AS is_tag FROM ({checked(_STRINGS)}) AS s")
def tag_strings(t: Tables) -> DataFrame:
    """Which strings are written like a tag."""
    return t.sql(_STRINGS).select("event_id", restore.is_tag(F.col("value")).alias("is_tag"))


_SETS = """SELECT o_orderkey, o_orderkey % 5 AS a, o_custkey % 4 AS b, o_orderkey % 3 AS c FROM {orders}"""


@query(f"""WITH s AS ({checked(_SETS)}), u AS (SELECT o_orderkey, '[P ' || a || ']' AS tag FROM s UNION SELECT o_orderkey, '[P ' || b || ']' FROM s UNION SELECT o_orderkey, '[Q ' || c || ']' FROM s)
SELECT o_orderkey, string_agg(tag, ',' ORDER BY tag) AS tags FROM u GROUP BY o_orderkey""")
def tag_sets(t: Tables) -> DataFrame:
    """Tag lists of several parts as one."""
    tag = lambda name, column: F.concat(F.lit(f"[{name} "), column, F.lit("]"))
    joined = restore.combine_tag_sets(F.array(tag("P", "a"), tag("P", "b")), F.array(tag("Q", "c"), tag("P", "a")))
    return t.sql(_SETS).select("o_orderkey", joined.alias("tags"))


# ---- Restore ------------------------------------------------------------------------------------

# What someone wrote from a tagged note: tags plain and Markdown-escaped, renames, strangers.
REPLY = (
    "'[Buyer] asked: ' || {text} || ' See \\[Email 1\\], [Phone 1\\] and \\[Email 10\\] [Unknown 3], [the annex], [1]. '"
    " || CASE WHEN doc_id % 2 = 0 THEN '[Buyer] again, [Datum 77].' ELSE '' END"
)


def _restored(t: Tables) -> DataFrame:
    tagged = _stored_notes(t)
    reply = F.expr(REPLY.replace("{text}", "text").replace("\\", "\\\\"))
    return restore.restore_text(tagged.select("doc_id", reply.alias("text")), kept(_renamed(t, tagged)))


_REPLIES = f"""{hits_sql(NOTES_CHECK, 'doc_id, lang')}, {TAGS}, {_TABLE}, renames AS ({checked(RENAMES)}),
{rewritten_sql(NOTES_CHECK, 'tag', 'doc_id, lang', 'tagged')},
replies AS (SELECT doc_id, {REPLY.replace('{text}', 'text')} AS text FROM rewritten),
named AS (SELECT doc_id, original, placeholder AS tag FROM grouped UNION ALL
  SELECT doc_id, original, label FROM grouped JOIN renames USING (doc_id, placeholder)),
states AS (SELECT doc_id, tag, min(original) AS original, count(DISTINCT original) AS originals FROM named GROUP BY doc_id, tag),
lists AS (SELECT doc_id, list(struct_pack(tag := tag, original := original) ORDER BY tag) FILTER (originals = 1) AS known,
  list(tag) FILTER (originals > 1) AS several FROM states GROUP BY doc_id)"""


@query(f"""WITH {_REPLIES}
SELECT doc_id, list_reduce(known, lambda acc, k: struct_pack(tag := '', original :=
    replace(replace(replace(replace(acc.original, '\\' || k.tag[:-2] || '\\]', k.original), '\\' || k.tag, k.original),
      k.tag[:-2] || '\\]', k.original), k.tag, k.original)), struct_pack(tag := '', original := text)).original AS text
FROM replies JOIN lists USING (doc_id)""")
def restore_replies(t: Tables) -> DataFrame:
    """Replies written from tagged notes with the originals back."""
    return _restored(t).select("doc_id", "text")


@query(f"""WITH {_REPLIES},
bare AS (SELECT doc_id, replace(text, '\\', '') AS text, text AS written FROM replies),
counted AS (SELECT s.doc_id, CAST(sum((length(b.text) - length(replace(b.text, s.tag, ''))) // length(s.tag)) AS BIGINT) AS replacements,
    CAST(count_if(contains(b.text, s.tag)) AS BIGINT) AS tags_restored
  FROM states AS s JOIN bare AS b ON b.doc_id = s.doc_id WHERE originals = 1 GROUP BY s.doc_id)
SELECT doc_id, replacements, tags_restored FROM counted""")
def restore_counts(t: Tables) -> DataFrame:
    """How much was put back in each reply; numbers only."""
    return _restored(t).select("doc_id", "replacements", "tags_restored")


@query(f"""WITH {_REPLIES},
shaped AS (SELECT doc_id, unnest(regexp_extract_all(replace(text, '\\', ''), '\\[\\p{{L}}[\\p{{L}}. -]* [0-9]{{1,4}}\\]')) AS tag FROM replies
  UNION ALL SELECT doc_id, '[Buyer]' FROM replies JOIN states USING (doc_id) WHERE tag = '[Buyer]'),
left_over AS (SELECT DISTINCT doc_id, tag, coalesce(originals, 0) AS originals FROM shaped LEFT JOIN states USING (doc_id, tag) WHERE coalesce(originals, 0) <> 1)
SELECT doc_id, coalesce(string_agg(tag, ',' ORDER BY tag) FILTER (originals = 0), '') AS unresolved_tags,
  coalesce(string_agg(tag, ',' ORDER BY tag) FILTER (originals > 1), '') AS ambiguous_tags FROM left_over GROUP BY doc_id""")
def reported_tags(t: Tables) -> DataFrame:
    """Tags of each reply the table cannot put back: unknown, or standing for several originals."""
    return _restored(t).select("doc_id", "unresolved_tags", "ambiguous_tags")


@query(f"""WITH {hits_sql(DOCS, 'doc_id, lang')}, {TAGS},
mixed AS (SELECT DISTINCT doc_id FROM tagged WHERE tag IS NOT NULL GROUP BY doc_id, tag HAVING count(DISTINCT hit) > 1)
SELECT doc_id, doc_id NOT IN (SELECT doc_id FROM mixed) AS same FROM documents""")
def round_trip(t: Tables) -> DataFrame:
    """Documents tagged and restored: the same again where each tag has one spelling."""
    docs = t.texts("documents", "doc_id", "text", "lang")
    tagged = kept(redact.pseudonymize(docs, lang="lang"))
    return restore.round_trip_check(docs, restore.restore_text(tagged.select("doc_id", "text"), kept(_table_of(tagged))))


@query(f"""WITH {hits_sql(NOTES_CHECK, 'doc_id, lang')}, {TAGS}, {_TABLE}
SELECT doc_id, placeholder FROM grouped WHERE doc_id % 10 = 0""")
def leak_scan(t: Tables) -> DataFrame:
    """Outputs checked for originals; one in ten was left as it was, and only these are found."""
    notes, tagged = t.notes().select("doc_id", "text"), _stored_notes(t)
    outputs = tagged.select("doc_id", "text").where("doc_id % 10 <> 0").unionByName(notes.where("doc_id % 10 = 0"))
    return restore.leak_scan(outputs, kept(_table_of(tagged)))


@query(f"""WITH notes AS ({NOTES_CHECK}), people AS ({checked(PEOPLE)})
SELECT doc_id, lower(name) AS phrase FROM notes JOIN people ON contains(text, name) WHERE doc_id % 10 = 0""")
def corpus_leak_scan(t: Tables) -> DataFrame:
    """Names of anyone at all in whole outputs of the name tagger, where one in ten was left as it was."""
    notes, people = t.notes().select("doc_id", "text"), t.sql(PEOPLE)
    tagged = entities.pseudonymize_names(notes, detect.name_phrases(people))
    outputs = tagged.where("doc_id % 10 <> 0").unionByName(notes.where("doc_id % 10 = 0"))
    return restore.leak_scan_words(outputs, people.withColumnRenamed("name", "original"))


# ---- Review -------------------------------------------------------------------------------------


@query(f"""WITH {hits_sql(NOTES_CHECK, 'doc_id, lang')}, keyed AS (SELECT s.*, {KEY_SQL} AS key FROM spans AS s WHERE category IS NOT NULL),
reviewed AS (
  SELECT doc_id, first, category, CASE WHEN doc_id % 6 = 0 AND category IN ('Email', 'PhoneNumber') THEN 'one' ELSE key END AS key
  FROM keyed WHERE NOT (doc_id % 4 = 0 AND category = 'Date')
  UNION ALL SELECT o_orderkey, 0, 'Organization', 'order' FROM orders WHERE o_orderkey % 5 = 0),
entity AS (SELECT doc_id, category, key, min(first) AS first_pos FROM reviewed GROUP BY doc_id, category, key)
SELECT doc_id, category, sha256(key) AS entity, first_pos, row_number() OVER (PARTITION BY doc_id, category ORDER BY first_pos) AS number FROM entity""")
def mask_review(t: Tables) -> DataFrame:
    """Masks after a review that dropped, added and merged some, numbered anew."""
    # Kept, as a person would have them: masks and decisions both start from them, and texts are searched once.
    masks = kept(entities.export_masks(detect.detect_patterns(t.notes())))
    action = (
        F.when((F.col("doc_id") % 4 == 0) & (F.col("category") == "Date"), "remove")
        .when((F.col("doc_id") % 6 == 0) & F.col("category").isin("Email", "PhoneNumber"), "merge")
    )
    changed = masks.withColumn("action", action).where("action IS NOT NULL").withColumn("entity", F.lit("one"))
    added = t.sql(
        "SELECT o_orderkey AS doc_id, 0 AS start, 5 AS end, 'Organization' AS category, 'Order' AS surface, 'order' AS entity, "
        "'add' AS action FROM {orders} WHERE o_orderkey % 5 = 0"
    )
    reviewed = entities.apply_review(masks, changed.unionByName(added))
    tags = entities.assign_tags(reviewed.withColumn("pos", F.col("start")))
    return tags.select("doc_id", "category", F.sha2("entity", 256).alias("entity"), "first_pos", "number")


# ---- Tables as CSV, Word parts --------------------------------------------------------------------

# A table per customer: a quoted cell with a comma and quotes, one with a line end, a guarded minus, an apostrophe
# that guards nothing, an empty record, columns in two orders, with and without the mark at the start.
_CELLS = [
    ("[Address 1]", "", "Address", "'Lot \"' || CAST(c_custkey % 50 AS STRING) || '\", NATION_' || CAST(c_nationkey AS STRING)", '"'),
    ("[Org 1]", "[Club]", "Organization", "chr(39) || '90s ' || c_mktsegment || ' Club'", ""),
    ("[Account 1]", "", "IBAN", "'-' || CAST(c_custkey AS STRING) || '/' || c_mktsegment", "guard"),
    ("[Person 1]", "[Member]", "Person", f"{given('c_custkey')} || chr(10) || {surname('c_custkey')}", '"'),
]


def _csv_line(placeholder: str, label: str, category: str, original: str, kind: str, turned: bool) -> str:
    cell = f"'\"' || replace({original}, '\"', '\"\"') || '\"'" if kind == '"' else f"chr(39) || {original}" if kind == "guard" else original
    return f"{cell} || ',{category},{label},{placeholder}'" if turned else f"'{placeholder},{label},{category},' || {cell}"


def _csv(turned: bool) -> str:
    header = "'ORIGINAL,Category, label ,placeholder'" if turned else "'placeholder,label,category,original'"
    lines = [header, *[_csv_line(*cell, turned) for cell in _CELLS]]
    return " || chr(13) || chr(10) || ".join([*lines[:3], "',,,'", *lines[3:]])


CSVS = f"""SELECT c_custkey AS doc_id, CASE WHEN c_nationkey % 2 = 0 THEN '\ufeff' ELSE '' END
  || CASE WHEN c_custkey % 2 = 0 THEN {_csv(True)} ELSE {_csv(False)} END AS value FROM {{customer}}"""


@query(" UNION ALL ".join(
    f"SELECT c_custkey AS doc_id, '{p}' AS placeholder, '{label}' AS label, '{c}' AS category, {original} AS original FROM {{customer}}"
    for p, label, c, original, _ in _CELLS
))
def parse_tables(t: Tables) -> DataFrame:
    """Correspondence tables read from their CSV texts."""
    return correspondence.parse_correspondence(t.sql(CSVS))


@query(f"SELECT *, 'refused' AS again FROM ({ORACLES['parse_tables']}) AS q")
def table_files(t: Tables) -> DataFrame:
    """A file per table, written, read back, and refused when written again."""
    folder = f"{checkpoint_dir(t.spark)}/tables-{uuid.uuid4().hex}"
    table = correspondence.parse_correspondence(spread(t.sql(CSVS), "doc_id"))
    correspondence.write_tables(table, folder, "doc_id")
    try:
        correspondence.write_tables(table, folder, "doc_id")
        again = "written over"
    except Exception as error:  # noqa: BLE001
        again = "refused" if "not written over" in str(error) else str(error)
    back = correspondence.read_tables(t.spark, folder)
    number = F.regexp_extract("file", r"([0-9]+)\.csv$", 1).cast("bigint")
    return back.select(number.alias("doc_id"), "placeholder", "label", "category", "original", F.lit(again).alias("again"))


# A Word file per customer. The tag of the person is cut in two after one to ten characters, an account may follow
# that the table has or lacks, a header stands in every second file, and one file in seven has no main part.
_CUT = "1 + c_custkey % 10"
_LAST = """CASE c_custkey % 3 WHEN 0 THEN '[Client] &amp; [Account 1] &#62; 5' WHEN 1 THEN '[Account 12] &lt;' ELSE 'no account' END"""
_BODY = [
    (' xml:space="preserve"', "'Customer ' || CAST(c_custkey AS STRING) || ' is '"),
    ("", f"substring('[Person 1]', 1, CAST({_CUT} AS INT))"),
    ("", f"substring('[Person 1]', CAST({_CUT} AS INT) + 1) || ' at [Org 1], nation ' || CAST(c_nationkey AS STRING)"),
    ("", _LAST),
]
_XML = "'<w:body><w:p>' || " + " || ".join(f"'<w:r><w:t{attrs}>' || {text} || '</w:t></w:r>'" for attrs, text in _BODY) + " || '</w:p></w:body>'"
_HEADER, _FOOTER = "'[Org 1] / ' || c_mktsegment", "'Sheet ' || CAST(c_custkey % 10 AS STRING)"
_PARTS = [
    ("word/document.xml", _XML, "c_custkey % 7 <> 0"),
    ("word/header1.xml", f"'<w:hdr><w:t>' || {_HEADER} || '</w:t></w:hdr>'", "c_custkey % 2 = 0"),
    ("word/footer1.xml", f"'<w:ftr><w:t>' || {_FOOTER} || '</w:t></w:ftr>'", "true"),
    ("word/media/image1.png", "'binary ' || c_mktsegment", "true"),
]
# Each file's parts side by side in its row, opened afterwards: the table is read once and joined with nothing.
PARTS = "SELECT CAST(c_custkey AS STRING) AS file_id, inline(filter(array(" + ", ".join(
    f"CASE WHEN {there} THEN struct('{part}' AS part, {xml} AS xml) END" for part, xml, there in _PARTS
) + "), p -> p IS NOT NULL)) FROM {customer}"
PART_TABLE = f"""SELECT CAST(c_custkey AS STRING) AS file_id, '[Person 1]' AS placeholder, '[Client]' AS label, 'Person' AS category,
  {given('c_custkey')} || ' ' || {surname('c_custkey')} AS original FROM {{customer}}
UNION ALL SELECT CAST(c_custkey AS STRING), '[Org 1]', '', 'Organization', c_mktsegment || ' & Sons' FROM {{customer}}
UNION ALL SELECT CAST(c_custkey AS STRING), '[Account 1]', '', 'IBAN', 'A<' || CAST(c_nationkey AS STRING) FROM {{customer}}"""

# What the checks start from: the runs of each part as a reader sees them, and the same with the originals back.
_SEEN = [text.replace("&amp;", "&").replace("&lt;", "<").replace("&#62;", ">") for _, text in _BODY]
_NAME = f"{given('c_custkey')} || ' ' || {surname('c_custkey')}"


def _back(text: str) -> str:
    for tag, original in (("[Org 1]", "c_mktsegment || ' & Sons'"), ("[Client]", _NAME), ("[Account 1]", "'A<' || CAST(c_nationkey AS STRING)")):
        text = f"replace({text}, '{tag}', {original})"
    return text


_DONE = [_SEEN[0], f"{_NAME}", _back(_SEEN[2].replace(f"substring('[Person 1]', CAST({_CUT} AS INT) + 1)", "''")), _back(_SEEN[3])]


def _runs_sql(body: list[str], header: str) -> str:
    rows = [("word/document.xml", i, attrs, text, _PARTS[0][2]) for i, ((attrs, _), text) in enumerate(zip(_BODY, body))]
    rows += [("word/header1.xml", 0, "", header, _PARTS[1][2]), ("word/footer1.xml", 0, "", _FOOTER, "true")]
    return " UNION ALL ".join(
        f"SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS file_id, '{part}' AS part, CAST({i} AS BIGINT) AS run_no, '{attrs}' AS attrs, {text} AS text FROM customer WHERE {there}"
        for part, i, attrs, text, there in rows
    )


_BEFORE, _AFTER = _runs_sql(_SEEN, _HEADER), _runs_sql(_DONE, _back(_HEADER))


@query(f"SELECT file_id, part, run_no, attrs, text FROM ({_BEFORE}) AS runs")
def extract_runs(t: Tables) -> DataFrame:
    """Text runs of the parts a reader sees."""
    return runs.extract_runs(t.sql(PARTS))


@query(f"""SELECT a.file_id, a.part, a.run_no, a.text, a.text <> b.text AS changed
FROM ({_AFTER}) AS a JOIN ({_BEFORE}) AS b USING (file_id, part, run_no)""")
def restore_runs(t: Tables) -> DataFrame:
    """Runs with the originals back, also where a tag was cut over several."""
    done = runs.restore_runs(runs.extract_runs(t.sql(PARTS)), t.sql(PART_TABLE))
    return done.drop("attrs")


_ENCODED = "replace(replace(replace(a.text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(f"""WITH raw AS ({_runs_sql([text for _, text in _BODY], _HEADER)}),
written AS (SELECT a.c_custkey, a.file_id, a.part, a.run_no, CASE WHEN a.text = b.text THEN '<w:t' || a.attrs || '>' || raw.text
    ELSE '<w:t xml:space="preserve">' || {_ENCODED} END || '</w:t>' AS node
  FROM ({_AFTER}) AS a JOIN ({_BEFORE}) AS b USING (file_id, part, run_no) JOIN raw USING (file_id, part, run_no)),
parts AS (SELECT file_id, part, CASE part WHEN 'word/document.xml' THEN '<w:body><w:p>' || string_agg('<w:r>' || node || '</w:r>', '' ORDER BY run_no) || '</w:p></w:body>'
    WHEN 'word/header1.xml' THEN '<w:hdr>' || any_value(node) || '</w:hdr>' ELSE '<w:ftr>' || any_value(node) || '</w:ftr>' END AS xml
  FROM written GROUP BY file_id, part)
SELECT * FROM parts UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'word/media/image1.png', 'binary ' || c_mktsegment FROM customer""")
def rebuild_parts(t: Tables) -> DataFrame:
    """Parts with the restored runs written in."""
    parts = t.sql(PARTS)
    return runs.rebuild_part_xml(parts, runs.restore_runs(runs.extract_runs(parts), t.sql(PART_TABLE)))


@query(f"""WITH texts AS (SELECT file_id, part, string_agg(text, '' ORDER BY run_no) AS text FROM ({_BEFORE}) AS runs GROUP BY file_id, part),
known AS (SELECT unnest(['[Person 1]', '[Client]', '[Org 1]', '[Account 1]']) AS tag),
met AS (SELECT file_id, tag, CAST(sum((length(text) - length(replace(text, tag, ''))) // length(tag)) AS BIGINT) AS n FROM texts, known GROUP BY file_id, tag),
counts AS (SELECT file_id, CAST(sum(n) AS BIGINT) AS replacements, count(*) FILTER (n > 0) AS tags_restored FROM met GROUP BY file_id),
shaped AS (SELECT DISTINCT file_id, unnest(regexp_extract_all(text, '\\[[^\\[\\]]+\\]')) AS tag FROM texts),
strange AS (SELECT file_id, string_agg(tag, ',' ORDER BY tag) AS tags FROM shaped WHERE tag NOT IN (SELECT tag FROM known) GROUP BY file_id),
files AS (SELECT CAST(c_custkey AS VARCHAR) AS file_id, c_custkey % 7 <> 0 AS ok FROM customer)
SELECT file_id, CASE WHEN ok THEN 'restored' ELSE 'invalid_request' END AS status, CASE WHEN ok THEN replacements END AS replacements,
  CASE WHEN ok THEN tags_restored END AS tags_restored, CASE WHEN ok THEN coalesce(tags, '') END AS unresolved_tags, CASE WHEN ok THEN '' END AS ambiguous_tags
FROM files LEFT JOIN counts USING (file_id) LEFT JOIN strange USING (file_id)""")
def restore_report(t: Tables) -> DataFrame:
    """Counts per Word file; files without a main part are refused."""
    return runs.restore_report(t.sql(PARTS), t.sql(PART_TABLE))


_ANSWERS = """SELECT c_custkey, '/w/answer' || CAST(c_custkey AS STRING) || CASE c_custkey % 5 WHEN 0 THEN '.md' WHEN 1 THEN '.DOCX' WHEN 2 THEN '.pdf' WHEN 3 THEN '.txt' ELSE '' END AS file_path,
  '/w/table' || CAST(c_nationkey AS STRING) || '.csv' AS correspondence_path,
  CASE WHEN c_custkey % 4 = 0 THEN '/w/answer' || CAST(c_custkey AS STRING) || '.md' END AS output_path FROM {customer}"""


@query(f"""WITH a AS ({checked(_ANSWERS)}), tables AS (SELECT '/w/table' || n_nationkey || '.csv' AS path FROM nation WHERE n_nationkey % 3 <> 0),
e AS (SELECT *, CASE c_custkey % 5 WHEN 0 THEN '.md' WHEN 1 THEN '.DOCX' WHEN 2 THEN '.pdf' WHEN 3 THEN '.txt' ELSE '' END AS ext FROM a),
o AS (SELECT *, coalesce(output_path, replace(file_path, ext, '') || '-restored' || ext) AS out FROM e WHERE ext <> ''
  UNION ALL SELECT *, coalesce(output_path, file_path || '-restored') FROM e WHERE ext = ''),
p AS (SELECT *, CASE WHEN lower(ext) NOT IN ('.md', '.txt', '.docx') THEN 'unsupported_type' WHEN out = file_path THEN 'output_is_input'
  WHEN correspondence_path NOT IN (SELECT path FROM tables) THEN 'empty_table' END AS problem FROM o)
SELECT c_custkey, out AS restored_path, problem, CASE WHEN problem IS NOT NULL THEN 'invalid_request' END AS code FROM p""")
def check_restorable(t: Tables) -> DataFrame:
    """Requests to restore: refused or not, and where the result goes."""
    tables = t.nation.where("n_nationkey % 3 <> 0").select(
        F.concat(F.lit("/w/table"), "n_nationkey", F.lit(".csv")).alias("correspondence_path")
    )
    return restore.check_restorable(t.sql(_ANSWERS), tables).select("c_custkey", "restored_path", "problem", "code")
